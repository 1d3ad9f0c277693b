"""Phrase counts and collocations against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

from conftest import rows_of

from dayfold.llm import phrases

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(docs, longest):
    counts = {}
    for lang, text in docs:
        of_lang = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOW)):
            words = [w for w in re.split("[ \t]", piece) if w]
            of_lang.update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    return counts


def plain(docs, longest=3, least=10, percent=50, top=2000):
    found = []
    for lang, counts in plain_counts(docs, longest).items():
        total = sum(f for p, f in counts.items() if len(p) == 1)
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for phrase, a in candidates.items():
            size = len(phrase)
            around = [f for p, f in candidates.items() if len(p) > size and any(p[i : i + size] == phrase for i in range(len(p)))]
            if any(100 * f >= percent * a for f in around):
                continue
            cuts = [(1_000_000 * a * a // (counts[phrase[:k]] * counts[phrase[k:]]), k) for k in range(1, size)]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(phrase).encode(), counts[phrase[:k]], counts[phrase[k:]]))
        for rank, (score, a, text, left, right) in enumerate(sorted(rows)[:top], 1):
            found.append((lang, rank, text.decode(), -a, left, right, total, -score))
    return found


def corpus(seed=5, size=400):
    """Words of very different frequency, some phrases planted, and one text that a third of the rows repeat."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["Ähre", "naïve", "C3PO"]
    texts = []
    for i in range(size):
        words = [vocabulary[min(int(rng.expovariate(0.2)), len(vocabulary) - 1)] for _ in range(rng.randint(0, 60))]
        if i % 5 == 0:
            words[len(words) // 2 : len(words) // 2] = ["New", "york", "city"] if i % 10 else ["new", "YORK", "times"]
        texts.append("".join(w + rng.choice([" ", " ", " ", "\t", ". ", ", ", "\n"]) for w in words))
    rows = [(rng.choice(["en", "de", None]), t) for t in texts]
    return rows + [("en", "the same text again and again")] * (size // 2)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n int, phrase string").repartition(7)


def test_equal_to_plain_counting(spark):
    rows = corpus()
    assert rows_of(phrases.collocations(frame(spark, rows))) == sorted(plain(rows))


def test_any_number_of_shards_length_and_top(spark):
    rows = corpus(seed=6, size=150)
    for shards, longest, top in ((1, 2, 5), (4, 4, 2000)):
        found = phrases.collocations(frame(spark, rows), longest=longest, least=4, top=top, shards=shards)
        assert rows_of(found) == sorted(plain(rows, longest=longest, least=4, top=top))


def test_a_full_table_of_active_phrases_changes_nothing(spark):
    rows = corpus(seed=7, size=120)
    found = phrases.collocations(frame(spark, rows), least=3, slots=64)
    assert rows_of(found) == sorted(plain(rows, least=3))


def test_phrases_that_become_frequent_late(spark):
    # the words reach the threshold only with the last texts, so that their phrases need a second cycle
    rows = [("en", f"rare pair {i}") for i in range(6)]
    found = {r.phrase: r.f for r in phrases.phrase_counts(frame(spark, rows), least=6, shards=3).where("n = 2").collect()}
    assert found == {"rare pair": 6}


def test_late_phrases_that_share_a_slot_with_early_ones(spark):
    # the pairs of the late words fall on slots that the early pairs have filled, but their own cycle begins later
    rng = random.Random(1)
    rows = [("en", " ".join(f"w{rng.randint(0, 39)}" for _ in range(300))) for _ in range(240)]
    rows += [("en", f"p{i} q{i} r{i}. {i} {j}") for i in range(40) for j in range(12)]
    assert rows_of(phrases.collocations(frame(spark, rows), slots=2048)) == sorted(plain(rows))


def test_odd_texts(spark):
    rows = [(None, None), ("en", ""), ("en", " .,;\t"), ("und", "a b"), (None, "A B"), ("de", "x" * 50_000), ("de", "a b a b")]
    rows += [("fr", "é à " * 30_000)]
    assert rows_of(phrases.collocations(frame(spark, rows), least=2)) == sorted(plain(rows, least=2))
    assert rows_of(phrases.collocations(frame(spark, []))) == []
