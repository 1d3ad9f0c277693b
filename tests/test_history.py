"""First and last state: hand rows, ties, NULLs, random rows against brute force, skew."""

from __future__ import annotations

import random

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from dayfold.operators.history import _ends, first_last_state, min_max_by_key
from dayfold.operators.joins import left_join_on


# Nine changes of three ids.
CHANGES = [
    (1, "2022-01-01", 1),
    (1, "2022-01-02", 2),
    (1, "2022-01-03", 3),
    (2, "2022-01-01", 1),
    (2, "2022-01-02", 1),
    (3, "2022-01-03", 2),
    (3, "2022-01-04", 1),
    (3, "2022-01-05", 2),
    (3, "2022-01-06", 4),
]


def states(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, add_time string, state bigint")
    return rows_of(first_last_state(df, "id", "add_time", "state"))


def brute_force(rows):
    """The two left joins, written as loops."""
    found = []
    for key in {r[0] for r in rows}:
        times = [r[1] for r in rows if r[0] == key and r[1] is not None]
        low, high = (min(times), max(times)) if times else (None, None)

        def at(time, key=key):
            hits = [r[2] for r in rows if r[0] == key and r[1] == time]
            return hits if key is not None and time is not None and hits else [None]

        found += [(key, low, a, high, b) for a in at(low) for b in at(high)]
    return found


def ranked(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_nine_changes(spark):
    assert states(spark, CHANGES) == [
        (1, "2022-01-01", 1, "2022-01-03", 3),
        (2, "2022-01-01", 1, "2022-01-02", 1),
        (3, "2022-01-03", 2, "2022-01-06", 4),
    ]


@pytest.mark.parametrize(
    "rows, expected",
    [
        (
            [(1, "d1", 1), (1, "d1", 2), (1, "d3", 3)],
            [(1, "d1", 1, "d3", 3), (1, "d1", 2, "d3", 3)],
        ),
        ([(5, "d1", 4)], [(5, "d1", 4, "d1", 4)]),
        ([(None, "d1", 9)], [(None, "d1", None, "d1", None)]),
        ([(2, None, 7)], [(2, None, None, None, None)]),
        ([(2, None, 7), (2, "d1", 8)], [(2, "d1", 8, "d1", 8)]),
        ([(4, "d1", None), (4, "d2", 1)], [(4, "d1", None, "d2", 1)]),
        ([(6, "2022-01-10", 1), (6, "2022-01-9", 2)], [(6, "2022-01-10", 1, "2022-01-9", 2)]),
        ([], []),
    ],
)
def test_hand_rows(spark, rows, expected):
    assert states(spark, rows) == expected


def test_ties_at_both_ends_multiply(spark):
    rows = [(1, "d1", s) for s in (1, 2)] + [(1, "d9", s) for s in (7, 7, 8)]
    assert len(states(spark, rows)) == 6


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_random_rows_against_brute_force(spark, settings, seed, broadcast):
    settings(spark__sql__autoBroadcastJoinThreshold=broadcast)
    pick = random.Random(seed)
    rows = [
        (
            pick.choice([None, 1, 2, 3, 4, 5, 6]),
            pick.choice([None, None, "a", "b", "c", "d"]),
            pick.choice([None, 1, 2, 3]),
        )
        for _ in range(60)
    ]
    assert ranked(states(spark, rows)) == ranked(brute_force(rows))


def test_partitioning_does_not_matter(spark):
    df = spark.createDataFrame(CHANGES, "id bigint, add_time string, state bigint")
    results = [
        rows_of(first_last_state(df.repartition(n), "id", "add_time", "state")) for n in (1, 3, 8)
    ]
    assert results[0] == results[1] == results[2]


def test_id_and_output_names(spark):
    df = spark.createDataFrame(CHANGES, "user bigint, at string, mode bigint")
    found = first_last_state(df, "user", "at", "mode")
    assert found.columns == ["user", "start_time", "start_state", "end_time", "end_state"]


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
}


def hot_changes(spark):
    """A third of the rows share one id and one time that is neither first nor last."""
    n = 90_000
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") < n // 3, F.lit(-1)).otherwise(F.col("id") % 5000).alias("key"),
        F.when(F.col("id") < n // 3, F.lit(50))
        .when(F.col("id") % 5000 == 0, F.lit(0))
        .otherwise(F.col("id") % 97)
        .alias("time"),
        F.col("id").alias("state"),
    ).unionByName(
        spark.createDataFrame([(-1, 0, 1), (-1, 99, 2)], "key bigint, time bigint, state bigint")
    )


def test_hot_time_is_split(spark, settings):
    settings(**SKEW)
    found = first_last_state(hot_changes(spark), "key", "time", "state")
    rows = found.where("key = -1").collect()
    assert [tuple(r) for r in rows] == [(-1, 0, 1, 99, 2)]
    ends = _ends(hot_changes(spark).select(F.col("key").alias("id"), "time", "state"))
    ends.collect()
    assert "skew=true" in plan_of(ends)


def test_changes_are_joined_once(spark, settings, sf_dir):
    """One sort of the changes; first and last states are paired from the few rows at either end."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    changes = orders.selectExpr("o_custkey AS id", "o_orderdate AS time", "o_orderstatus AS state")
    ends = _ends(changes)
    ends.collect()
    plan = plan_of(ends)
    assert plan.count("SortMergeJoin") == 1 and plan.count("Sort [") == 2
    paired = first_last_state(orders, "o_custkey", "o_orderdate", "o_orderstatus")
    paired.collect()
    assert "orders.parquet" not in plan_of(paired)


def test_min_max_by_key(spark):
    df = spark.createDataFrame(CHANGES + [(None, "x", 1)], "id bigint, add_time string, s bigint")
    assert rows_of(min_max_by_key(df, "id", "add_time")) == [
        (None, "x", "x"),
        (1, "2022-01-01", "2022-01-03"),
        (2, "2022-01-01", "2022-01-02"),
        (3, "2022-01-03", "2022-01-06"),
    ]


@pytest.mark.parametrize("hot_right", [False, True])
def test_left_join_keeps_misses_and_multiplies_matches(spark, hot_right):
    left = spark.createDataFrame(
        [(1, "a"), (1, "a"), (2, "b"), (None, "a"), (3, None)], "k bigint, t string"
    )
    right = spark.createDataFrame(
        [(1, "a", 10), (1, "a", 11), (2, "x", 12), (None, "a", 13), (3, None, 14)],
        "rk bigint, rt string, v bigint",
    )
    joined = left_join_on(left, right, [("k", "rk"), ("t", "rt")], hot_right)
    assert joined.columns == ["k", "t", "rk", "rt", "v"]
    assert rows_of(joined) == [
        (None, "a", None, None, None),
        (1, "a", 1, "a", 10),
        (1, "a", 1, "a", 10),
        (1, "a", 1, "a", 11),
        (1, "a", 1, "a", 11),
        (2, "b", None, None, None),
        (3, None, None, None, None),
    ]


def test_left_join_splits_a_hot_key_on_the_right(spark, settings):
    settings(**SKEW)
    right = hot_changes(spark).toDF("rk", "rt", "v")
    left = spark.range(-1, 5000, 1, 8).select(F.col("id").alias("k"), F.lit(50).alias("t"))
    keys = [("k", "rk"), ("t", "rt")]
    split = left_join_on(left, right, keys, hot_right=True)
    assert split.count() == left_join_on(left, right, keys).count()
    split.collect()
    assert "skew=true" in plan_of(split)


@pytest.mark.parametrize("hot_right", [False, True])
def test_left_join_of_sides_that_share_names(spark, hot_right):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k bigint, v string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k bigint, v string")
    joined = left_join_on(left, right, [("k", "k")], hot_right)
    assert joined.columns == ["k", "v", "k", "v"]
    assert rows_of(joined) == [
        (None, "c", None, None),
        (1, "a", 1, "x"),
        (1, "a", 1, "y"),
        (2, "b", None, None),
    ]


def test_hot_right_keys_are_found_by_the_join_itself(spark, settings):
    """A third of the right rows under one key: the default call splits that key, and says the same as the plain join."""
    settings(**SKEW)
    left = spark.range(0, 3000, 1, 4).select((F.col("id") % 1000).alias("k"), F.lit("x").alias("t")).union(
        spark.createDataFrame([(None, "x"), (7, None)], "k bigint, t string")
    )
    right = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).cast("int").alias("k"),
        F.lit("x").alias("t"),
        F.col("id").alias("v"),
        F.lit("payload" * 10).alias("p"),
    )
    keys = [("k", "k"), ("t", "t")]
    found = left_join_on(left, right, keys, hot_rows=10_000)
    plain = left_join_on(left, right, keys, hot_right=False)
    assert found.columns == plain.columns
    total = [F.count("*").alias("n"), F.expr("bit_xor(xxhash64(*))").alias("h"), F.expr("sum(xxhash64(*) % 1000003)").alias("s")]
    numbered = [d.toDF(*(f"c{i}" for i in range(6))) for d in (found, plain)]
    assert numbered[0].agg(*total).collect() == numbered[1].agg(*total).collect()
    numbered[0].collect()
    assert "skew=true" in plan_of(numbered[0])


def test_no_hot_key_leaves_the_plain_join(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey")
    plan = plan_of(left_join_on(orders, lines, [("o_orderkey", "l_orderkey")]))
    assert plan.count("FileScan") == 2 and "LeftAnti" not in plan
    assert left_join_on(orders, lines.limit(0), [("o_orderkey", "l_orderkey")]).count() == orders.count()
