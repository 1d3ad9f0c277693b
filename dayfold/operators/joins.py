"""The left join on several keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Keys that the sketch of the right side keeps counts of; it cannot miss one that is 3.5 in this many rows.
TRACKED = 10_000


def left_join_on(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    hot_right: bool | None = None,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """Left outer join on pairs of (left column, right column).

    Every left row stays, once per match and once with NULLs where nothing matches. No side is
    marked for broadcast but a list of at most 1,000 keys: Spark picks it from the sizes it knows, and
    sort-merge otherwise. The two sides may share column names.

    Spark splits a hot key on the left of such a join, but not on the right. So a small job counts
    the keys of the right side in a sketch of fixed size. Those that hold ``hot_rows`` rows or more
    are joined apart: matches and misses are found by two joins, an inner one, which splits on both
    sides, and an anti join against the distinct right keys. ``hot_right`` says so beforehand:
    ``True`` joins all keys that way, ``False`` none. Both read no more than the sides, once or twice.
    """
    # names of our own while the sides meet, and the given ones again afterwards
    ours, theirs = _numbered(left, "_left"), _numbered(right, "_right")
    at = [(f"_left{left.columns.index(a)}", f"_right{right.columns.index(b)}") for a, b in keys]
    condition = reduce(and_, (F.col(a) == F.col(b) for a, b in at))
    names = [b for _, b in at]

    def split(ours: DataFrame, theirs: DataFrame) -> DataFrame:
        misses = ours.join(theirs.select(*names).distinct(), condition, "left_anti")
        return ours.join(theirs, condition, "inner").unionByName(misses, allowMissingColumns=True)

    if hot_right:
        return split(ours, theirs).toDF(*left.columns, *right.columns)
    hot = [] if hot_right is False else _hot_hashes(theirs, names, hot_rows)
    if not hot:
        return ours.join(theirs, condition, "left").toDF(*left.columns, *right.columns)
    is_hot = F.xxhash64(*names).isin(hot)
    rows = theirs.where(is_hot).select(*names).distinct().collect()
    listed = F.broadcast(left.sparkSession.createDataFrame(rows, theirs.select(*names).schema))
    cold = ours.join(listed, condition, "left_anti").join(theirs.where(~is_hot), condition, "left")
    joined = cold.unionByName(split(ours.join(listed, condition, "left_semi"), theirs.where(is_hot)))
    return joined.toDF(*left.columns, *right.columns)


def _hot_hashes(df: DataFrame, names: list[str], hot_rows: int) -> list[int]:
    """Hashes of the keys that hold ``hot_rows`` rows or more, and more than a thousandth of all; at most 1,000."""
    known = df.where(reduce(and_, (F.col(n).isNotNull() for n in names)))
    seen = known.agg(
        F.expr(f"approx_top_k(xxhash64({', '.join(names)}), 1000, {TRACKED})").alias("top"), F.count("*").alias("rows")
    ).first()
    return [x["item"] for x in seen.top or [] if x["count"] >= max(hot_rows, seen.rows // 1000)]


def _numbered(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*(f"{prefix}{i}" for i in range(len(df.columns))))
