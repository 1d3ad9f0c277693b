"""What the physical plans must and must not hold."""

from __future__ import annotations

import re

import pytest
from conftest import plan_of

from dayfold.operators.slices import date_range, day_slice
from registry.queries import QUERIES

FORBIDDEN = ["EvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "NestedLoopJoin"]


@pytest.mark.parametrize("name", QUERIES)
def test_plan_stays_in_the_jvm_without_cross_joins(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert [word for word in FORBIDDEN if word in plan] == []


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("split_words_dict")])
def test_no_broadcast_where_spark_knows_of_no_small_side(spark, settings, sf_dir, name):
    """Outside the dictionary, whose size is measured, no join asks for a broadcast."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    assert "Broadcast" not in plan_of(QUERIES[name](spark, sf_dir))


DAY_QUERIES = [n for n in QUERIES if n.endswith("_day")]


@pytest.mark.parametrize("name", DAY_QUERIES)
def test_the_day_reaches_every_large_scan(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    table, column = {
        "funnel_totals_day": ("events", "ts"),
        "keyword_totals_day": ("events", "ts"),
        "additive_users_hourly_day": ("events", "ts"),
        "totals_by_region_day": ("orders", "o_orderdate"),
    }.get(name, ("lineitem", "l_shipdate"))
    scans = [s for s in plan_of(df).splitlines() if "FileScan" in s]
    large = [s for s in scans if column in s]
    assert large
    for scan in large:
        assert re.search(rf"DataFilters: \[[^\]]*{column}#\d+ >= ", scan), (table, scan)


def test_scans_read_only_what_they_need(spark, sf_dir):
    plan = plan_of(QUERIES["scan_pruned"](spark, sf_dir))
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in plan


def test_exam_reports_take_one_scan(spark, sf_dir):
    by_paper = plan_of(QUERIES["exam_by_paper"](spark, sf_dir))
    by_course = plan_of(QUERIES["exam_by_course"](spark, sf_dir))
    assert len(re.findall(r"FileScan.*l_suppkey", by_paper)) == 1 and "Window" not in by_paper
    assert len(re.findall(r"FileScan.*l_suppkey", by_course)) == 1 and "Window" in by_course


def test_extremes_are_taken_before_the_exchange(spark, sf_dir):
    plan = plan_of(QUERIES["min_max_by_key"](spark, sf_dir))
    assert plan.count("Exchange") == 1 and "partial_min" in plan.split("Exchange")[1]


def test_text_days_reach_the_scan(spark, tmp_path):
    rows = [("2024-11-15", 1), ("2024-11-16", 2), ("2024-11-16 08:00", 3), ("20241116", 4), ("2024-11-167", 5), ("2024-11-17", 6), (None, 7)]
    spark.createDataFrame(rows, "day string, v int").write.parquet(str(tmp_path / "days"))
    table = spark.read.parquet(str(tmp_path / "days"))
    for found, wanted in (
        (day_slice(table, "2024-11-16", "day"), {2, 3, 4}),
        (date_range(table, "day", "2024-11-17", 1), {2, 3, 4, 6}),
    ):
        assert {r.v for r in found.collect()} == wanted
        pushed = plan_of(found).split("PushedFilters:")[1].split("]")[0]
        assert "GreaterThanOrEqual(day,2024-11-16)" in pushed and "LessThan(day,2024-11-1" in pushed


@pytest.mark.parametrize("name", [n for n in QUERIES if n.endswith("_stored") and n != "totals_by_date_stored"])
def test_stored_reports_read_one_partition(spark, sf_dir, name):
    assert "PartitionFilters: [isnotnull(dt" in plan_of(QUERIES[name](spark, sf_dir))


def test_partition_scan_prunes(spark, sf_dir):
    plan = plan_of(QUERIES["partition_scan"](spark, sf_dir))
    assert re.search(r"PartitionFilters: \[isnotnull\(dt#\d+\), \(dt#\d+ = 2024-01-16\)\]", plan)


def test_date_range_is_pushed(spark, sf_dir):
    plan = plan_of(QUERIES["filter_date_between"](spark, sf_dir))
    assert "o_orderdate#" in plan and ">= 1997-03-12 00:00:00" in plan
