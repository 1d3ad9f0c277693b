"""The raw frames of ``rollups`` read from the sample tables, which stand in for real ones.

=============  ==========================================================================
funnel steps   ``events``: view, click, signup, purchase, error
review         ``lineitem``: course = part, user = supplier, stars = order key modulo 5, plus 1
trade          ``orders``: user = customer, province = the customer's nation
exam view      ``lineitem``: paper = supplier, course = its nation, user = order,
               score = quantity, seconds = order key
answer         ``lineitem``: question = part, user = the order's customer,
               correct = not returned (flag N)
=============  ==========================================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.operators.slices import day_slice
from dayfold.operators.spread import spread
from dayfold.plans import rollups
from dayfold.sources.tables import load

STEPS = {
    "home_count": "view",
    "course_detail_count": "click",
    "cart_add_count": "signup",
    "order_count": "purchase",
    "pay_success_count": "error",
}


def _on(frame: DataFrame, day: str | None) -> DataFrame:
    """The rows of one day, taken before any rollup; all rows without a day."""
    return day_slice(frame, day) if day else frame


def _date(column: str) -> Column:
    return F.to_date(column).alias("dt")


def events(spark: SparkSession, folder: str, day: str | None = None) -> DataFrame:
    return _on(load(spark, folder, "events").withColumn("dt", F.to_date("ts")), day)


def documents(spark: SparkSession, folder: str, key: str) -> DataFrame:
    pieces = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spread(load(spark, folder, "documents").select(key, "text"), pieces)


def orders(spark: SparkSession, folder: str, day: str | None = None) -> DataFrame:
    placed = load(spark, folder, "orders").select(
        _date("o_orderdate"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("amount"),
    )
    return _on(placed, day)


def views(spark: SparkSession, folder: str, day: str | None = None) -> DataFrame:
    lines = load(spark, folder, "lineitem").select(
        _date("l_shipdate"),
        F.col("l_suppkey").alias("paper_id"),
        F.col("l_orderkey").alias("user_id"),
        F.col("l_quantity").cast("bigint").alias("score"),
        F.col("l_orderkey").alias("duration_sec"),
    )
    return _on(lines, day)


def papers(spark: SparkSession, folder: str) -> DataFrame:
    nations = load(spark, folder, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("course_name")
    )
    return (
        load(spark, folder, "supplier")
        .join(nations, "s_nationkey", "left")
        .select(
            F.col("s_suppkey").alias("paper_id"),
            F.col("s_name").alias("paper_title"),
            F.col("s_nationkey").cast("bigint").alias("course_id"),
            "course_name",
        )
    )


def _parts(spark: SparkSession, folder: str, key: str, name: str) -> DataFrame:
    return load(spark, folder, "part").select(
        F.col("p_partkey").alias(key), F.col("p_name").alias(name)
    )


def keyword_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Texts carry no time; their source serves as the window."""
    return rollups.keyword_window(documents(spark, folder, "source"), "text", window="source")


def search_rollup(spark: SparkSession, folder: str, day: str | None = None) -> DataFrame:
    """Words per day: the properties of an event are the text."""
    return rollups.keyword_window(events(spark, folder, day), "props", window="dt")


def funnel_rollup(spark: SparkSession, folder: str, day: str | None = None) -> DataFrame:
    return rollups.funnel_window(events(spark, folder, day), STEPS)


def review_rollup(spark: SparkSession, folder: str, day: str | None = None) -> DataFrame:
    reviews = load(spark, folder, "lineitem").select(
        _date("l_shipdate"),
        F.col("l_partkey").alias("course_id"),
        F.col("l_suppkey").alias("user_id"),
        (F.col("l_orderkey") % 5 + 1).alias("stars"),
    )
    courses = _parts(spark, folder, "course_id", "course_name")
    return rollups.review_window(_on(reviews, day), courses)


def region_trade_rollup(spark: SparkSession, folder: str, day: str | None = None) -> DataFrame:
    users = load(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("region_id")
    )
    regions = load(spark, folder, "nation").select(
        F.col("n_nationkey").alias("region_id"), F.col("n_name").alias("province_name")
    )
    return rollups.region_trade_window(orders(spark, folder, day), users, regions)


def hourly_search_rollup(spark: SparkSession, folder: str, day: str | None = None) -> DataFrame:
    """Words per hour of the properties of events."""
    placed = rollups.in_windows(events(spark, folder, day))
    return rollups.keyword_window(placed, "props", window=rollups.WINDOW)


def hourly_answer_rollup(spark: SparkSession, folder: str, day: str | None = None) -> DataFrame:
    """Answers per hour: an event is an answer to the question of its type, right with an even id."""
    asked = rollups.in_windows(events(spark, folder, day)).select(
        *rollups.WINDOW,
        F.length("event_type").cast("bigint").alias("question_id"),
        "user_id",
        (F.col("event_id") % 2 == 0).alias("correct"),
    )
    questions = load(spark, folder, "events").groupBy(F.length("event_type").cast("bigint").alias("question_id")).agg(
        F.min("event_type").alias("question_txt")
    )
    return rollups.answer_window(asked, questions, window=rollups.WINDOW)


def daily_trade_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.daily_trade_window(orders(spark, folder))


def exam_rollup(spark: SparkSession, folder: str, day: str | None = None) -> DataFrame:
    return rollups.exam_window(views(spark, folder, day), papers(spark, folder))


def score_range_rollup(spark: SparkSession, folder: str, day: str | None = None) -> DataFrame:
    return rollups.score_range_window(views(spark, folder, day), papers(spark, folder))


def answer_rollup(spark: SparkSession, folder: str, day: str | None = None) -> DataFrame:
    lines = load(spark, folder, "lineitem").select(
        _date("l_shipdate"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("question_id"),
        (F.col("l_returnflag") == "N").alias("correct"),
    )
    takers = load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id")
    )
    answers = _on(lines, day).join(takers, "order_id", "left")
    return rollups.answer_window(answers, _parts(spark, folder, "question_id", "question_txt"))
