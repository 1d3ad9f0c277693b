"""Rollups and reports on hand rows, and the identities that hold between them."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.operators.slices import day_slice
from dayfold.plans import reports, rollups, stand_ins
from dayfold.plans import stored as stored_module
from dayfold.session import fresh_folder
from dayfold.sources import tables
from dayfold.sources.schemas import ROLLUP_SCHEMAS
from registry.queries import QUERIES

D1, D2 = dt.date(2024, 11, 15), dt.date(2024, 11, 16)
D1T = dt.datetime(2024, 11, 15, 7)

BY_TABLE = {
    "keyword": reports.keyword_totals,
    "funnel": reports.funnel_totals,
    "review": reports.review_scores,
    "region_trade": reports.totals_by_region,
    "daily_trade": reports.totals_by_date,
    "exam": reports.exam_by_paper,
    "score_range": reports.score_distribution,
    "answer": reports.answer_rates,
}

BUILT = {
    "funnel": stand_ins.funnel_rollup,
    "review": stand_ins.review_rollup,
    "region_trade": stand_ins.region_trade_rollup,
    "daily_trade": stand_ins.daily_trade_rollup,
    "exam": stand_ins.exam_rollup,
    "score_range": stand_ins.score_range_rollup,
    "answer": stand_ins.answer_rollup,
}


def stored(spark, table, rows):
    return spark.createDataFrame(rows, ROLLUP_SCHEMAS[table])


@pytest.mark.parametrize("table", BUILT)
def test_rollups_have_the_stored_columns(spark, sf_dir, table):
    built = dict(BUILT[table](spark, sf_dir).dtypes)
    wanted = {
        f.name: f.dataType.simpleString()
        for f in T.StructType.fromDDL(ROLLUP_SCHEMAS[table])
    }
    assert wanted.items() <= built.items()


@pytest.mark.parametrize("table", BY_TABLE)
def test_empty_day(spark, table):
    found = BY_TABLE[table](stored(spark, table, [])).collect()
    if table == "funnel":
        assert [tuple(r) for r in found] == [(None,) * 5]
    else:
        assert found == []


def test_keyword_totals(spark):
    rows = [("a", 2, D1), ("a", 3, D1), (None, 1, D1), (None, 4, D1), ("b", None, D1), ("a", 9, D2)]
    rollup = stored(spark, "keyword", rows)
    assert rows_of(reports.keyword_totals(day_slice(rollup, D1))) == [
        (None, 5),
        ("a", 5),
        ("b", None),
    ]
    assert rows_of(reports.keyword_totals(rollup)) == [(None, 5), ("a", 14), ("b", None)]


def test_funnel_totals(spark):
    hour, no_hour = (D1T, D1T + dt.timedelta(hours=1)), (None, None)
    rows = [(1, 2, 3, 4, 5, *hour, D1), (10, 20, 30, 40, None, *no_hour, D1)]
    rows += [(9, 9, 9, 9, 9, *hour, D2)]
    rollup = stored(spark, "funnel", rows)
    assert rows_of(reports.funnel_totals(day_slice(rollup, D1))) == [(11, 22, 33, 44, 5)]


def test_review_scores(spark):
    rows = [(1, "x", 150, 100, 20, D1), (1, "x", 51, 100, 9, D1), (2, "y", 5, 0, 0, D1)]
    rows += [(1, "renamed", 4, 1, 0, D1)]
    assert rows_of(reports.review_scores(stored(spark, "review", rows))) == [
        (1, "renamed", Decimal("4.00"), 1, Decimal("0.00")),
        (1, "x", Decimal("1.01"), 200, Decimal("0.15")),
        (2, "y", None, 0, None),
    ]


def test_totals_by_region(spark):
    rows = [("p", Decimal("1.10"), 1, 2, D1), ("p", Decimal("2.20"), 1, 1, D1)]
    rollup = stored(spark, "region_trade", rows)
    assert rows_of(reports.totals_by_region(rollup)) == [("p", Decimal("3.30"), 2, 3)]


def test_totals_by_date_uses_the_stored_date(spark):
    rows = [(D1, Decimal("1.00"), 1, 1), (D1, Decimal("2.00"), 1, 2), (D2, None, 1, 1)]
    found = reports.totals_by_date(stored(spark, "daily_trade", rows))
    assert found.columns == ["biz_date", "final_amount", "uv", "vv"]
    assert rows_of(found) == [(D1, Decimal("3.00"), 2, 3), (D2, None, 1, 1)]
    with pytest.raises(ValueError):
        reports.totals_by_date(stored(spark, "keyword", []))


def test_exam_reports_at_two_grains(spark):
    rows = [
        (1, "p1", 7, "c", 2, 2, 2, 150, 27, D1),
        (2, "p2", 7, "c", 3, 1, 8, 50, 0, D1),
        (3, "p3", 8, "d", 1, 1, 0, 0, 5, D1),
    ]
    rollup = stored(spark, "exam", rows)
    assert rows_of(reports.exam_by_paper(rollup)) == [
        (1, "p1", 2, 75.0, 13),
        (2, "p2", 3, 6.25, 0),
        (3, "p3", 1, None, None),
    ]
    assert rows_of(reports.exam_by_course(rollup)) == [
        (7, "c", 3, 20.0, 2),
        (8, "d", 1, None, None),
    ]


def test_answer_rates(spark):
    rows = [(1, "q", 1, 4, 1, 2, D1), (1, "q", 2, 4, 1, 3, D1), (2, "r", 0, 0, 0, 0, D1)]
    assert rows_of(reports.answer_rates(stored(spark, "answer", rows))) == [
        (1, "q", 3, 8, 0.375, 2, 5, 0.4),
        (2, "r", 0, 0, None, 0, 0, None),
    ]


def random_views(seed):
    pick = random.Random(seed)
    return [
        (
            pick.choice([D1, D2, None]),
            pick.choice([1, 2, 3, 4]),
            pick.choice([None, 10, 11, 12]),
            pick.randint(1, 50),
            pick.randint(0, 100),
        )
        for _ in range(80)
    ]


VIEW = "dt date, paper_id bigint, user_id bigint, score bigint, duration_sec bigint"
PAPER = "paper_id bigint, paper_title string, course_id bigint, course_name string"
PAPERS = [(1, "p1", 7, "c"), (2, "p2", 7, "c"), (3, "p3", 8, "d")]


@pytest.mark.parametrize("seed", range(3))
def test_exam_users_against_brute_force(spark, seed):
    """A user counts once per day and paper, and once per day and course; paper 4 has no name and
    no course, and some rows have no day."""
    views = random_views(seed)
    rollup = rollups.exam_window(
        spark.createDataFrame(views, VIEW), spark.createDataFrame(PAPERS, PAPER)
    )
    course = {p[0]: p[2] for p in PAPERS}

    def users(key):
        return sum(len({v[2] for v in views if (v[0], key(v)) == k and v[2]}) for k in keys(key))

    def keys(key):
        return {(v[0], key(v)) for v in views}

    by_paper = reports.exam_by_paper(rollup).collect()
    by_course = reports.exam_by_course(rollup).collect()
    assert {r.paper_id for r in by_paper} == {v[1] for v in views}
    assert {r.paper_title for r in by_paper if r.paper_id == 4} == {None}
    assert sum(r.uv for r in by_paper) == users(lambda v: v[1])
    assert sum(r.uv for r in by_course) == users(lambda v: course.get(v[1]))
    for r in by_course:
        rows = [v for v in views if course.get(v[1]) == r.course_id]
        assert r.avg_score == pytest.approx(sum(v[3] for v in rows) / len(rows))
        assert r.avg_duration_sec == int(sum(v[4] for v in rows) / len(rows))
    assert rollup.count() == len({(v[0], v[1]) for v in views})
    for column, value in (("score", 3), ("duration_sec", 4)):
        assert sum(r[column] for r in rollup.collect()) == sum(v[value] for v in views)


@pytest.mark.parametrize("seed", range(3))
def test_answer_users_against_brute_force(spark, seed):
    pick = random.Random(seed)
    answers = [
        (pick.choice([D1, None]), pick.choice([1, 2, 9]), pick.choice([None, 5, 6, 7]), pick.choice([True, False, None]))
        for _ in range(40)
    ]
    rollup = rollups.answer_window(
        spark.createDataFrame(
            answers, "dt date, question_id bigint, user_id bigint, correct boolean"
        ),
        spark.createDataFrame([(1, "q"), (2, "r")], "question_id bigint, question_txt string"),
    )
    assert sum(r["count"] for r in rollup.collect()) == len(answers)
    for r in rollup.collect():
        rows = [a for a in answers if a[:2] == (r.dt, r.question_id)]
        assert r["count"] == len(rows)
        assert r.correct_count == sum(a[3] is True for a in rows)
        assert r.uu_count == len({a[2] for a in rows if a[2]})
        assert r.correct_uu_count == len({a[2] for a in rows if a[2] and a[3]})


def test_unnamed_keys_keep_their_sums(spark):
    reviews = [(D1, 1, 5, 4), (D1, 1, 5, 5), (D1, 1, 6, 1), (D1, 9, 5, 2), (None, 1, 5, 3)]
    rollup = rollups.review_window(
        spark.createDataFrame(reviews, "dt date, course_id bigint, user_id bigint, stars bigint"),
        spark.createDataFrame([(1, "x")], "course_id bigint, course_name string"),
    )
    found = {(r.dt, r.course_id, r.course_name): (r.review_stars, r.uv, r.star5) for r in rollup.collect()}
    assert found == {
        (D1, 1, "x"): (10, 2, 1),
        (D1, 9, None): (2, 1, 0),
        (None, 1, "x"): (3, 1, 0),
    }
    orders = [(D1, 1, 2.0), (D1, 2, 3.0), (D1, 3, 4.0), (None, 1, 1.0), (D1, None, 8.0)]
    trade = rollups.region_trade_window(
        spark.createDataFrame(orders, "dt date, user_id bigint, amount double"),
        spark.createDataFrame([(1, 7), (2, 8)], "user_id bigint, region_id bigint"),
        spark.createDataFrame([(7, "p")], "region_id bigint, province_name string"),
    )
    totals = rows_of(reports.totals_by_region(trade))
    assert totals == [(None, Decimal("15.00"), 2, 3), ("p", Decimal("3.00"), 2, 2)]


def test_windows_inside_the_day(spark, sf_dir):
    """A user seen in two hours of a day counts twice in the hourly rollup and once in the daily."""
    rows = [(1, "2024-11-15 07:10:00"), (1, "2024-11-15 07:50:00"), (1, "2024-11-15 08:00:00"), (2, None)]
    events = spark.createDataFrame(rows, "user_id bigint, t string").withColumn("ts", F.to_timestamp_ntz("t"))
    hourly = rollups.users_window(rollups.in_windows(events), ["window_start", "window_end"], "user_id")
    assert rows_of(hourly) == [(None, None, 1)] + [(D1T + dt.timedelta(hours=i), D1T + dt.timedelta(hours=i + 1), 1) for i in (0, 1)]
    quarter = rollups.in_windows(events, "15 minutes").select("window_start").distinct()
    assert quarter.count() == 4
    assert QUERIES["additive_users_hourly_day"](spark, sf_dir).agg(F.sum("users_summed")).first()[0] >= 1


def test_score_ranges(spark):
    views = [(D1, 1, u, s, 0) for u, s in ((1, 1), (2, 10), (3, 11), (3, 12), (4, 50), (5, None))]
    rollup = rollups.score_range_window(
        spark.createDataFrame(views, VIEW), spark.createDataFrame(PAPERS, PAPER)
    )
    assert rows_of(rollup.select("score_range", "uv")) == [
        (None, 1),
        ("1-10", 2),
        ("11-20", 1),
        ("41-50", 1),
    ]


@pytest.mark.parametrize(
    "table, rollup, report",
    [(t, r, BY_TABLE[t]) for t, r in BUILT.items() if t != "daily_trade"]
    + [("exam", stand_ins.exam_rollup, reports.exam_by_course)],
)
def test_a_day_before_or_after_the_rollup(spark, sf_dir, table, rollup, report):
    day = "2024-01-16" if table == "funnel" else "1997-03-15"
    before = report(rollup(spark, sf_dir, day))
    after = report(day_slice(rollup(spark, sf_dir), day))
    assert rows_of(before) == rows_of(after) and before.count() > 0


def test_words_over_the_rollup_are_words_of_the_texts(spark, sf_dir):
    total = reports.keyword_totals(stand_ins.keyword_rollup(spark, sf_dir))
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain = rollups.keyword_window(texts.withColumn("all", F.lit(1)), "text", "all")
    assert rows_of(total) == rows_of(plain.drop("all"))


def test_global_totals_are_the_sum_over_days(spark, sf_dir):
    rollup = stand_ins.funnel_rollup(spark, sf_dir)
    per_day = rollup.groupBy("dt").agg(F.sum("home_count").alias("n"))
    total = reports.funnel_totals(rollup).first().home_count
    assert per_day.agg(F.sum("n")).first()[0] == total


def test_users_are_additive_not_distinct(spark, sf_dir):
    events = stand_ins.events(spark, sf_dir)
    summed = rollups.users_window(events, ["dt"], "user_id").agg(F.sum("uv")).first()[0]
    assert summed > events.agg(F.countDistinct("user_id")).first()[0]


STORED_ROWS = {
    "keyword": ("w", 2),
    "funnel": (1, 2, 3, 4, 5, None, None),
    "review": (1, "x", 9, 2, 1),
    "region_trade": ("p", Decimal("1.10"), 1, 2),
    "exam": (1, "p1", 7, "c", 2, 2, 2, 150, 27),
    "score_range": (1, "p1", "1-10", 3),
    "answer": (1, "q", 1, 4, 1, 2),
}


def test_every_report_over_stored_tables(spark):
    location = fresh_folder(spark, "stored")
    database = "stored_" + location.rsplit("-", 1)[-1]
    tables.create_database(spark, database, location)
    tables.create_rollup_tables(spark, database)
    days = [D1, D1, D2, D2 + dt.timedelta(days=1)]
    for table, row in STORED_ROWS.items():
        stored_module.store(stored(spark, table, [(*row, d) for d in days]), database, table)
    trade = [(d, Decimal("2.00"), 1, 1) for d in days]
    stored_module.store(stored(spark, "daily_trade", trade), database, "daily_trade")

    for name, (table, _, report) in stored_module.STORED_REPORTS.items():
        rows = [(d, *trade[0][1:]) for d in days] if table == "daily_trade" else [
            (*STORED_ROWS[table], d) for d in days
        ]
        for picked, day, before in (
            (rows, None, 0),
            (rows[:2], "par20241115", 0),
            (rows[2:3], D2, 0),
            (rows[:3], D2, 3),
            ([], "2024-11-14", 0),
        ):
            found = stored_module.stored_report(spark, database, name, day, before)
            assert rows_of(found) == rows_of(report(stored(spark, table, picked))), (name, day)
            if picked and day and table != "daily_trade":
                assert "PartitionFilters: [isnotnull(dt" in plan_of(found)
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_hours_of_a_day_are_added_up(spark, sf_dir):
    """A stored day holds several windows per key; users of several hours count once in each."""
    hours = stand_ins.hourly_answer_rollup(spark, sf_dir)
    per_key = hours.groupBy("dt", "question_id").count().agg({"count": "max"}).first()[0]
    assert per_key > 1
    days = rollups.compacted(hours, ["question_id", "question_txt"])
    assert days.columns == hours.columns and days.dtypes == hours.dtypes
    assert days.groupBy("dt", "question_id").count().agg({"count": "max"}).first()[0] == 1
    assert rows_of(reports.answer_rates(days)) == rows_of(reports.answer_rates(hours))
    # counted once a day the users are fewer
    asked = stand_ins.events(spark, sf_dir).selectExpr("dt", "cast(length(event_type) AS bigint) AS question_id", "user_id", "event_id % 2 = 0 AS correct")
    questions = hours.select("question_id", "question_txt").distinct()
    daily = rollups.answer_window(asked, questions)
    totals = [{r.question_id: r for r in reports.answer_rates(d).collect()} for d in (hours, daily)]
    assert totals[0].keys() == totals[1].keys()
    assert all(totals[0][k]["count"] == totals[1][k]["count"] for k in totals[0])
    assert sum(r.uu_count for r in totals[0].values()) > sum(r.uu_count for r in totals[1].values())


@pytest.mark.parametrize("build", ["review", "region", "exam", "score"])
def test_any_rollup_takes_windows_inside_the_day(spark, sf_dir, build):
    """The window columns stand in the place of the day, so all other sums are those of the day's rows split by them."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "to_date(l_shipdate) AS dt", "l_shipdate + make_interval(0, 0, 0, 0, cast(l_orderkey % 3 AS int)) AS ts", "l_partkey AS course_id", "l_suppkey AS paper_id",
        "l_suppkey AS user_id", "l_orderkey % 5 + 1 AS stars", "cast(l_quantity AS bigint) AS score", "l_orderkey AS duration_sec", "l_extendedprice AS amount",
    )
    rows = rollups.in_windows(lines)
    names = spark.createDataFrame([], "course_id bigint, course_name string")
    papers = spark.createDataFrame([], "paper_id bigint, paper_title string, course_id bigint, course_name string")
    users = spark.createDataFrame([], "user_id bigint, region_id bigint")
    regions = spark.createDataFrame([], "region_id bigint, province_name string")
    made = {
        "review": lambda d, **w: (rollups.review_window(d, names, **w), ["review_stars", "star5"]),
        "region": lambda d, **w: (rollups.region_trade_window(d, users, regions, **w), ["final_amount", "order_count"]),
        "exam": lambda d, **w: (rollups.exam_window(d, papers, **w), ["view_count", "score", "duration_sec"]),
        "score": lambda d, **w: (rollups.score_range_window(d, papers, **w), []),
    }[build]
    hours, sums = made(rows, window=rollups.WINDOW)
    daily, _ = made(lines)
    assert hours.columns[:3] == list(rollups.WINDOW) and hours.columns[3:] == daily.columns[1:]
    assert hours.count() > daily.count()
    if sums:
        assert rows_of(hours.groupBy("dt").agg(*(F.sum(c) for c in sums))) == rows_of(daily.groupBy("dt").agg(*(F.sum(c) for c in sums)))
