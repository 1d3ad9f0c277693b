"""The Jaccard join against all pairs, in small regions and in ones over the limit."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from dayfold.llm import jaccard
from dayfold.llm.common import components, merged


def shingles(text: str | None) -> set[tuple[str, ...]]:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_components(texts: dict[int, str | None]) -> dict[int, int]:
    sets = {i: shingles(t) for i, t in texts.items()}
    low = {i: i for i in texts}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            if low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                changed = True
    return low


def corpus(seed: int = 3) -> dict[int, str | None]:
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 4)))
    texts: dict[int, str | None] = {1: None, 2: "", 3: " \t\n", 4: "one", 5: "ONE", 6: "two words", 7: "two  words\n"}
    common = [word() for _ in range(30)]
    for family in range(6):
        base = [word() for _ in range(r.randint(8, 120))]
        for _ in range(12):
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 12))):
                copy[r.randrange(len(copy))] = word()
            texts[len(texts) + 1] = " ".join(copy + (common if family % 2 else []))
    for _ in range(20):
        texts[len(texts) + 1] = " ".join([word() for _ in range(r.randint(1, 60))] + common)
    texts[len(texts) + 1] = texts[20]
    return texts


@pytest.mark.parametrize("limit", [1000, 2])
def test_equals_all_pairs(spark, monkeypatch, limit):
    monkeypatch.setattr(jaccard, "REGION_SETS", limit)
    texts = corpus()
    docs = spark.createDataFrame([(i, t, 5, "x") for i, t in texts.items()], "doc_id bigint, text string, region int, class string")
    rows = jaccard.near_documents(docs.repartition(5)).collect()
    assert len(rows) == len(texts)
    assert {r.doc_id: r.component_id for r in rows} == plain_components(texts)
    assert {r.doc_id: r.n_shingles for r in rows} == {i: len(shingles(t)) for i, t in texts.items()}


def test_far_copies_of_a_large_region_do_not_meet(spark, monkeypatch):
    """Sets that share most of one base, but not enough with any other: their pairs are not compared one by one."""
    r, met, whole = random.Random(8), [], jaccard._overlap_links
    monkeypatch.setattr(jaccard, "REGION_SETS", 20)
    monkeypatch.setattr(jaccard, "_overlap_links", lambda pairs, *a: met.append(pairs.count()) or whole(pairs, *a))
    base = [f"w{i}" for i in range(104)]
    texts = {}
    for i in range(1, 101):
        copy = list(base)
        for at in r.sample(range(7, 97, 6), 4 if i % 5 else 1):
            copy[at] = f"x{i}-{at}"
        texts[i] = " ".join(copy)
    # two that are near each other, but not near the base
    texts[101] = texts[4].replace("w101", "y")
    found = jaccard.near_documents(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()
    assert {x.doc_id: x.component_id for x in found} == plain_components(texts)
    assert len({x.component_id for x in found}) == 81 and len(met) == 1 and met[0] < len(texts)


def test_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (None, None)], "doc_id bigint, text string")
    rows = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jaccard.near_documents(docs).collect())
    assert rows == [(0, 0, 0), (0, 2, 7), (7, 2, 7), (7, 2, 7)]


def test_region_links_keep_every_group():
    r = np.random.RandomState(5)
    for _ in range(30):
        base = r.choice(400, 60, replace=False)
        sets = [np.unique(np.where(r.rand(60) < r.choice([0.02, 0.06, 0.1]), r.randint(400, 900, 60), base)) for _ in range(r.randint(2, 60))]
        offsets = np.r_[0, np.cumsum([len(s) for s in sets])]
        a, b = jaccard.region_links(offsets, np.concatenate(sets), 75, pivots=3)
        pairs = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))]
        want = merged(np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int), len(sets))
        assert np.array_equal(merged(a, b, len(sets)), want)


@pytest.mark.parametrize("native", [True, False])
def test_components(spark, native):
    r = random.Random(2)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5)]
    want = merged(np.array([a for a, _ in links]), np.array([b for _, b in links]), 1100)
    got = {x.id: x.component_id for x in components(spark.createDataFrame(links, "a bigint, b bigint"), native).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {i: int(want[i]) for i in linked}
    assert components(spark.createDataFrame([], "a bigint, b bigint"), native).count() == 0
