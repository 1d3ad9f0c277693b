"""Reports: the stored partial sums of many windows, added up again.

Every report takes a rollup frame. Hand it ``day_slice(rollup, day)`` for the report of one day,
the whole rollup for the report of all days. User counts (``uv``, ``*_uu_count``) are sums of
per-window counts: a user seen in two windows counts twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold.functions.columns import own_column
from dayfold.functions.ratios import ratio, ratio_2dp, ratio_whole


def _sums(*columns: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def keyword_totals(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("keyword").agg(*_sums("keyword_count"))


def funnel_totals(rollup: DataFrame) -> DataFrame:
    """Five step totals in one row; NULLs where there are no rows."""
    return rollup.agg(
        *_sums(
            "home_count",
            "course_detail_count",
            "cart_add_count",
            "order_count",
            "pay_success_count",
        )
    )


def review_scores(rollup: DataFrame) -> DataFrame:
    users = F.sum("uv")
    return rollup.groupBy("course_id", "course_name").agg(
        ratio_2dp(F.sum("review_stars"), users).alias("avg_stars"),
        users.alias("uv"),
        ratio_2dp(F.sum("star5"), users).alias("star5_rate"),
    )


def totals_by_region(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("province_name").agg(
        F.sum("final_amount").alias("final_amount"),
        F.sum("uu_order_count").alias("uv"),
        F.sum("order_count").alias("vv"),
    )


def totals_by_date(rollup: DataFrame) -> DataFrame:
    """Trade totals per date. The stored date column ``current_date`` comes out as ``biz_date``."""
    return rollup.groupBy(own_column(rollup, "current_date").alias("biz_date")).agg(
        *_sums("final_amount", "uv", "vv")
    )


def exam_by_paper(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("paper_id", "paper_title").agg(*_exam_measures("paper_user_count"))


def exam_by_course(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("course_id", "course_name").agg(*_exam_measures("course_user_count"))


def _exam_measures(user_count: str) -> list[Column]:
    views = F.sum("view_count")
    return [
        F.sum(user_count).alias("uv"),
        ratio(F.sum("score"), views).alias("avg_score"),
        ratio_whole(F.sum("duration_sec"), views).alias("avg_duration_sec"),
    ]


def score_distribution(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("paper_id", "paper_title", "score_range").agg(*_sums("uv"))


def answer_rates(rollup: DataFrame) -> DataFrame:
    correct, answers = F.sum("correct_count"), F.sum("count")
    correct_users, users = F.sum("correct_uu_count"), F.sum("uu_count")
    return rollup.groupBy("question_id", "question_txt").agg(
        correct.alias("correct_count"),
        answers.alias("count"),
        ratio(correct, answers).alias("correct_rate"),
        correct_users.alias("correct_uu_count"),
        users.alias("uu_count"),
        ratio(correct_users, users).alias("correct_uu_rate"),
    )
