"""A third of the rows on one key: the large-input plans split it and lose nothing."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from dayfold.operators.words import split_words_dict
from dayfold.plans import reports, rollups

N = 60_000
DAY = dt.date(2024, 11, 16)


@pytest.fixture
def large(settings):
    """No broadcast by estimate, and thresholds at which test data counts as skewed."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )


def hot(spark, name):
    """Rows whose key is 0 for the first third and one of 500 for the rest."""
    i = F.col("id")
    return spark.range(0, N, 1, 8).select(
        F.lit(DAY).alias("dt"), F.when(i < N // 3, 0).otherwise(i % 500).alias(name), i
    )


def test_a_hot_paper(spark, large):
    views = hot(spark, "paper_id").select(
        "dt",
        F.col("paper_id").cast("bigint"),
        F.col("id").alias("user_id"),
        F.lit(2).cast("bigint").alias("score"),
        F.lit(3).cast("bigint").alias("duration_sec"),
    )
    papers = spark.range(500).select(
        F.col("id").alias("paper_id"),
        F.col("id").cast("string").alias("paper_title"),
        (F.col("id") % 5).alias("course_id"),
        (F.col("id") % 5).cast("string").alias("course_name"),
    )
    found = reports.exam_by_course(rollups.exam_window(views, papers))
    by_course = {r.course_id: r for r in found.collect()}
    assert sum(r.uv for r in by_course.values()) == N
    assert by_course[0].uv == N // 3 + 8000
    assert "skew=true" in plan_of(found)


def test_a_hot_user(spark, large):
    """A user without limits on orders is one row per day when the users are joined on."""
    orders = hot(spark, "user_id").select("dt", "user_id", F.lit(1.5).alias("amount"))
    users = spark.range(500).select(
        F.col("id").alias("user_id"), (F.col("id") % 2).alias("region_id")
    )
    regions = spark.createDataFrame([(0, "p"), (1, "q")], "region_id int, province_name string")
    found = reports.totals_by_region(rollups.region_trade_window(orders, users, regions))
    assert [(r[0], r[2], r[3]) for r in rows_of(found)] == [("p", 250, 40_000), ("q", 250, 20_000)]


def test_a_hot_word(spark, large, settings):
    """A dictionary too large to broadcast, and one word on a third of all places."""
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    texts = spark.range(0, 600, 1, 8).select(
        "id", F.concat(F.repeat(F.lit("a"), 40), F.repeat(F.lit("bc"), 40)).alias("text")
    )
    dictionary = spark.createDataFrame([("a",), ("bc",), ("zz",)], "word string")
    found = split_words_dict(texts, "text", dictionary, keep=["id"], broadcast_limit=0)
    counts = {r.word: r["count"] for r in found.groupBy("word").count().collect()}
    assert counts == {"a": 600 * 40, "bc": 600 * 40}
    tasks = found.where("word = 'a'").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 600 * 40 / 2


def test_hot_copies_of_a_text(spark):
    """A third of the texts are the same: their words are counted before they move."""
    texts = hot(spark, "source").select(
        "source",
        F.when(F.col("source") == 0, "same words")
        .otherwise(F.concat_ws(" ", "id", "id"))
        .alias("t"),
    )
    rollup = rollups.keyword_window(texts, "t", window="source")
    plan = plan_of(rollup)
    assert plan.index("partial_count") > plan.index("Exchange")
    totals = {r.keyword: r.keyword_count for r in reports.keyword_totals(rollup).collect()}
    assert totals["same"] == totals["words"] == N // 3 + 80
    assert sum(totals.values()) == 2 * N
