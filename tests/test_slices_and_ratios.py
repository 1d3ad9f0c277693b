"""Day slices, date ranges, ratios and casts."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import plan_of, rows_of
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from dayfold.functions.columns import own_column
from dayfold.functions.ratios import money, ratio, ratio_2dp, ratio_whole
from dayfold.operators.slices import as_day, date_range, day_slice
from dayfold.session import fresh_folder


@pytest.fixture
def days(spark):
    return spark.createDataFrame(
        [(d, dt.date(2024, 11, d)) for d in (13, 14, 16, 17, 18)] + [(0, None)], "n int, dt date"
    )


@pytest.mark.parametrize(
    "name",
    ["2024-11-16", "20241116", "par20241116", dt.date(2024, 11, 16), dt.datetime(2024, 11, 16, 5)],
)
def test_names_of_a_day(name):
    assert as_day(name) == dt.date(2024, 11, 16)


@pytest.mark.parametrize("name", ["", "november", "2024-11", "par20241316"])
def test_no_day(name):
    with pytest.raises(ValueError):
        as_day(name)


def test_day_slice(days):
    assert [r.n for r in day_slice(days, "par20241116").collect()] == [16]
    assert day_slice(days, "20241115").count() == 0


def test_strict_slice_of_a_missing_day(days):
    assert day_slice(days, "20241116", strict=True).count() == 1
    with pytest.raises(ValueError, match="2024-11-15"):
        day_slice(days, "20241115", strict=True)


def test_date_range_holds_both_ends(days):
    assert sorted(r.n for r in date_range(days, "dt", "2024-11-17", 3).collect()) == [14, 16, 17]


@pytest.mark.parametrize("kind", ["int", "bigint", "string"])
def test_a_day_in_the_spelling_of_the_column(spark, kind):
    rows = spark.createDataFrame([("20241115",), ("20241116",), ("20241117",), (None,)], "t string")
    rows = rows.select(F.col("t").cast(kind).alias("dt"))
    assert [str(r[0]) for r in day_slice(rows, "2024-11-16").collect()] == ["20241116"]
    assert [str(r[0]) for r in date_range(rows, "dt", "par20241117", 1).collect()] == ["20241116", "20241117"]


def test_partitions_of_whole_numbers_are_pruned(spark):
    path = fresh_folder(spark, "numbered")
    rows = spark.createDataFrame([(1, 20241115), (2, 20241116)], "n int, dt int")
    rows.write.partitionBy("dt").parquet(path)
    found = day_slice(spark.read.parquet(path), "par20241116")
    assert [r.n for r in found.collect()] == [2]
    assert "PartitionFilters: [isnotnull(dt" in plan_of(found)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "string"])
def test_a_day_of_timestamps_or_text_is_the_whole_day(spark, kind):
    times = ["2024-11-15 23:59:59", "2024-11-16 00:00:00", "2024-11-16 23:59:59"]
    times += ["2024-11-17 00:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    df = df.select(F.col("t"), F.col("t").cast(kind).alias("at"))
    assert rows_of(day_slice(df, "20241116", "at").select("t")) == [(times[1],), (times[2],)]
    assert rows_of(date_range(df, "at", "20241116", 1).select("t")) == [(t,) for t in times[:3]]


def test_range_on_text_dates_reads_them_as_dates(spark):
    df = spark.createDataFrame([("2024-11-14",), ("2024-11-13",)], "d string")
    assert rows_of(date_range(df, "d", "2024-11-17", 3)) == [("2024-11-14",)]


def test_slice_of_a_timestamp_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("dt", F.to_date("ts"))
    plan = plan_of(day_slice(events, "2024-01-16").select("user_id"))
    assert "ts#" in plan and ">= 2024-01-16 00:00:00" in plan.split("DataFilters")[1]


def test_a_missing_column_named_like_a_function(spark):
    df = spark.range(1)
    assert df.select("current_date").count() == 1
    with pytest.raises(ValueError, match="current_date"):
        own_column(df, "current_date")
    with pytest.raises(ValueError, match="current_date"):
        date_range(df, "current_date", "2024-11-17", 3)


def one(spark, a, b, make):
    df = spark.createDataFrame([(a, b)], "a bigint, b bigint")
    return df.select(make(F.col("a"), F.col("b"))).first()[0]


@pytest.mark.parametrize(
    "a, b, expected",
    [(1, 2, 0.5), (5, 0, None), (0, 0, None), (5, None, None), (None, 5, None), (-7, 2, -3.5)],
)
def test_ratio(spark, a, b, expected):
    assert one(spark, a, b, ratio) == expected


@pytest.mark.parametrize(
    "a, b, expected",
    [(201, 200, "1.01"), (29, 200, "0.15"), (1, 3, "0.33"), (2, 3, "0.67"), (-201, 200, "-1.01")],
)
def test_two_places_half_up(spark, a, b, expected):
    assert one(spark, a, b, ratio_2dp) == Decimal(expected)


def test_two_places_of_nothing(spark):
    assert one(spark, 5, 0, ratio_2dp) is None


@pytest.mark.parametrize("a, b, expected", [(27, 10, 2), (-27, 10, -2), (5, 0, None), (30, 10, 3)])
def test_whole(spark, a, b, expected):
    assert one(spark, a, b, ratio_whole) == expected


def test_sum_overflow_is_an_error(spark):
    df = spark.createDataFrame([(2**63 - 1,), (1,)], "a bigint")
    with pytest.raises(ArithmeticException):
        df.agg(F.sum("a")).collect()


def test_money_adds_up_in_any_order(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(1e9,)], "x double")
    totals = {
        df.repartition(n).agg(F.sum(money(F.col("x")))).first()[0] for n in (1, 3, 7)
    }
    assert totals == {Decimal("1000000001.00")}
