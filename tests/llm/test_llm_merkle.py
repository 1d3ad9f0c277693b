"""The Merkle manifest against trees built in plain Python."""

from __future__ import annotations

import hashlib

from conftest import rows_of
from pyspark.sql import functions as F

from dayfold.llm import merkle

NAMES = ("doc_id", "source", "lang", "n_chars", "text")
DDL = "doc_id bigint, source string, lang string, n_chars bigint, text string, key string, tree string, parent int"


def digest(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain(rows, claimed):
    """Expected rows of ``audit``; ``claimed`` gives a row as it is claimed to be."""
    parts = {}
    for row in rows:
        parts.setdefault(row[2], []).append(row)
    trees, found = {}, []
    for part, members in parts.items():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[part] = tree([leaf(r) for r in members])
    order = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    top = tree([trees[p][-1][0] for p in order])
    for place, part in enumerate(order):
        for i, row in enumerate(parts[part]):
            folded, seen = leaf(claimed(row)), []
            for levels, at in ((trees[part], i), (top, place)):
                for level in levels[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else ""
                    folded = digest(other, folded) if at % 2 else digest(folded, other)
                    seen.append(other)
                    at //= 2
            found.append((row[0], trees[part][0][i], trees[part][-1][0], top[-1][0], digest(*seen), folded, folded == top[-1][0]))
    return found


def one_more(row):
    return (*row[:3], row[3] + 1 if row[3] is not None and row[0] is not None and row[0] % 3 == 0 else row[3], row[4])


def audited(spark, rows):
    docs = spark.createDataFrame([(*r, "k", "t", 1) for r in rows], DDL)
    changed = F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    claimed = [changed if n == "n_chars" else F.col(n) for n in NAMES]
    return merkle.audit(merkle.build(docs, "doc_id", "lang", [F.col(n) for n in NAMES], claimed))


def ordered(rows):
    return sorted(rows, key=str)


def test_trees_of_many_sizes(spark):
    # from a lone leaf to more than 256 leaves, so that two passes build a tree; a third of the rows in one part
    sizes = {"": 1, "Ä": 2, "a": 3, "b": 256, "c": 257, "z": 700}
    rows = [(i * 7 % 1009, f"s{i % 3}", lang, i, f"text {i}") for lang, size in sizes.items() for i in range(size)]
    assert ordered(rows_of(audited(spark, rows))) == ordered(plain(rows, one_more))


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (None, None, None, None, None),
        (None, None, None, None, None),
        (3, "s", None, 5, ""),
        (3, "s", None, 5, "tied"),
        (6, None, "en", None, "x" * 100_000),
        (6, None, "en", None, "x" * 100_000),
        (9, "s", "en", 9, "ünï"),
    ]
    found = rows_of(audited(spark, rows))
    assert ordered(found) == ordered(plain(rows, one_more))
    assert [r[0] for r in found if not r[6]] == [3, 3, 9]


def test_one_part_and_empty(spark):
    assert rows_of(audited(spark, [(1, "s", "en", 4, "only")])) == plain([(1, "s", "en", 4, "only")], one_more)
    assert rows_of(audited(spark, [])) == []


def test_no_python_in_the_climb(spark):
    docs = spark.createDataFrame([(i, "s", "en", i, "t") for i in range(600)], ", ".join(DDL.split(", ")[:5]))
    made = merkle.build(docs, "doc_id", "lang", [F.col(n) for n in NAMES])
    plan = merkle.proofs(made)._jdf.queryExecution().toString()
    assert "UnionLoop" in plan and "Python" not in plan and "Arrow" not in plan
    # nodes above the leaves: three of the part, then the part itself
    assert made.nodes.count() == 4
