"""Rollups: raw rows to the partial sums of each time window.

Two rules hold throughout. Users are counted distinct within one window, by (window, key, user)
first, so that no key and no user has to fit into one task. Names are joined on after the sums, so
that a hot key meets its name once per window and not once per row. A key without a name keeps its
sums, under a name of NULL, so that the sums over all groups are those of all raw rows.

Raw frames carry ``dt``, the day of the row. All other columns are listed with each function. The
window is the day, or what ``window`` names: ``WINDOW`` for rows that went through ``in_windows``, so
that a stored day holds several rows per key. ``compacted`` merges those into one again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayfold.functions.ratios import money
from dayfold.operators.words import split_words


#: The columns of a window within a day.
WINDOW = ("dt", "window_start", "window_end")


def keyword_window(texts: DataFrame, text: str, window: str | Sequence[str]) -> DataFrame:
    """Occurrences of each word per window; any column, or several, can be the window."""
    window = [window] if isinstance(window, str) else list(window)
    return (
        split_words(texts, text, keep=window)
        .groupBy(*window, "keyword")
        .agg(F.count("*").alias("keyword_count"))
    )


def in_windows(rows: DataFrame, length: str = "1 hour", time: str = "ts") -> DataFrame:
    """``rows`` with window_start and window_end, the ends of the window their time falls into. A
    row without a time falls into a window of NULLs."""
    start = F.window(time, length)["start"]
    placed = rows.where(F.col(time).isNotNull()).select("*", start.alias("window_start"))
    timeless = rows.where(F.col(time).isNull()).select(
        "*", F.lit(None).cast(placed.schema["window_start"].dataType).alias("window_start")
    )
    end = F.col("window_start") + F.expr(f"interval {length}")
    return placed.union(timeless).withColumn("window_end", end)


def funnel_window(
    events: DataFrame, steps: Mapping[str, str], length: str = "1 hour"
) -> DataFrame:
    """Step counts per window of ``length``. ``events``: dt, ts, event_type; ``steps``: output
    column to type."""
    counts = [
        F.count_if(F.col("event_type") == value).alias(column) for column, value in steps.items()
    ]
    return in_windows(events, length).groupBy(*WINDOW).agg(*counts)


def review_window(
    reviews: DataFrame, courses: DataFrame, window: Sequence[str] = ("dt",)
) -> DataFrame:
    """Review sums per day and course. ``reviews``: dt, course_id, user_id, stars; ``courses``:
    course_id, course_name. A user who reviews a course twice on a day counts once."""
    per_user = reviews.groupBy(*window, "course_id", "user_id").agg(
        F.sum("stars").alias("review_stars"), F.count_if(F.col("stars") == 5).alias("star5")
    )
    sums = per_user.groupBy(*window, "course_id").agg(
        F.sum("review_stars").alias("review_stars"),
        F.count("user_id").alias("uv"),
        F.sum("star5").alias("star5"),
    )
    return sums.join(courses, "course_id", "left").select(
        *window, "course_id", "course_name", "review_stars", "uv", "star5"
    )


def region_trade_window(
    orders: DataFrame, users: DataFrame, regions: DataFrame, window: Sequence[str] = ("dt",)
) -> DataFrame:
    """Trade sums per day and province. ``orders``: dt, user_id, amount; ``users``: user_id,
    region_id; ``regions``: region_id, province_name.

    A user lives in one region, so the sums per (day, user) already hold each user once.
    """
    per_user = orders.groupBy(*window, "user_id").agg(
        F.sum(money(F.col("amount"))).alias("final_amount"), F.count("*").alias("order_count")
    )
    per_region = (
        per_user.join(users, "user_id", "left")
        .groupBy(*window, "region_id")
        .agg(
            F.sum("final_amount").cast("decimal(28,2)").alias("final_amount"),
            F.count("user_id").alias("uu_order_count"),
            F.sum("order_count").alias("order_count"),
        )
    )
    return per_region.join(regions, "region_id", "left").select(
        *window, "province_name", "final_amount", "uu_order_count", "order_count"
    )


def daily_trade_window(orders: DataFrame) -> DataFrame:
    """Trade sums per day. ``orders``: dt, user_id, amount."""
    return orders.groupBy(F.col("dt").alias("current_date")).agg(
        F.sum(money(F.col("amount"))).alias("final_amount"),
        F.countDistinct("user_id").alias("uv"),
        F.count("*").alias("vv"),
    )


def exam_window(
    views: DataFrame, papers: DataFrame, window: Sequence[str] = ("dt",)
) -> DataFrame:
    """Exam sums per day and paper, with users counted at two grains. ``views``: dt, paper_id,
    user_id, score, duration_sec; ``papers``: paper_id, paper_title, course_id, course_name.

    A user of several papers of one course counts for the course once a day, on the lowest paper
    id, so that ``course_user_count`` adds up over the papers of a course. Papers without a course
    count as those of one course. All comes from one pass over (day, paper, user); the window that
    marks the paper is left out by Spark for a report that does not ask for it.
    """
    per_user = views.groupBy(*window, "paper_id", "user_id").agg(
        F.sum("score").alias("score"),
        F.sum("duration_sec").alias("duration_sec"),
        F.count("*").alias("view_count"),
    )
    # A missing user has one row per day and paper here, so it forms no large window either.
    per_course = Window.partitionBy(*window, "course_id", "user_id").orderBy("paper_id")
    counted = (F.row_number().over(per_course) == 1) & F.col("user_id").isNotNull()
    placed = per_user.join(papers.select("paper_id", "course_id"), "paper_id", "left")
    sums = placed.withColumn("_counted", counted).groupBy(*window, "paper_id").agg(
        F.sum("score").alias("score"),
        F.sum("duration_sec").alias("duration_sec"),
        F.sum("view_count").alias("view_count"),
        F.count("user_id").alias("paper_user_count"),
        F.count_if("_counted").alias("course_user_count"),
    )
    return sums.join(papers, "paper_id", "left").select(
        *window,
        "paper_id",
        "paper_title",
        "course_id",
        "course_name",
        "paper_user_count",
        "course_user_count",
        "view_count",
        "score",
        "duration_sec",
    )


def score_range_window(
    views: DataFrame, papers: DataFrame, width: int = 10, window: Sequence[str] = ("dt",)
) -> DataFrame:
    """Users per day, paper and range of scores, such as ``1-10``. ``views`` and ``papers`` as in
    ``exam_window``; scores are whole numbers."""
    low = (F.floor((F.col("score") - 1) / width) * width + 1).cast("bigint")
    ranged = views.withColumn("score_low", low)
    counts = ranged.groupBy(*window, "paper_id", "score_low").agg(
        F.countDistinct("user_id").alias("uv")
    )
    ends = F.col("score_low").cast("string"), (F.col("score_low") + (width - 1)).cast("string")
    label = F.concat(ends[0], F.lit("-"), ends[1])
    return counts.join(papers, "paper_id", "left").select(
        *window, "paper_id", "paper_title", label.alias("score_range"), "uv"
    )


def answer_window(
    answers: DataFrame, questions: DataFrame, window: Sequence[str] = ("dt",)
) -> DataFrame:
    """Answer sums per day and question. ``answers``: dt, question_id, user_id, correct (boolean);
    ``questions``: question_id, question_txt.

    Both user counts come from one pass over (day, question, user).
    """
    per_user = answers.groupBy(*window, "question_id", "user_id").agg(
        F.count_if("correct").alias("correct_count"), F.count("*").alias("count")
    )
    sums = per_user.groupBy(*window, "question_id").agg(
        F.sum("correct_count").alias("correct_count"),
        F.sum("count").alias("count"),
        F.count(F.when(F.col("correct_count") > 0, F.col("user_id"))).alias("correct_uu_count"),
        F.count("user_id").alias("uu_count"),
    )
    return sums.join(questions, "question_id", "left").select(
        *window,
        "question_id",
        "question_txt",
        "correct_count",
        "count",
        "correct_uu_count",
        "uu_count",
    )


def users_window(rows: DataFrame, keys: Sequence[str], user: str) -> DataFrame:
    """Distinct users per window, where ``keys`` hold the window and any further key."""
    return rows.groupBy(*keys).agg(F.countDistinct(user).alias("uv"))


def compacted(rollup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The windows of each day and key merged into one, from the first start to the last end.

    ``rollup`` has ``WINDOW``, the ``keys`` and sums. Reports over the result are those over ``rollup``,
    as they add up the same sums: a user of two of the windows still counts twice.
    """
    sums = [c for c in rollup.columns if c not in (*WINDOW, *keys)]
    ends = F.min("window_start").alias("window_start"), F.max("window_end").alias("window_end")
    types = {c: rollup.schema[c].dataType for c in sums}
    merged = rollup.groupBy("dt", *keys).agg(*(F.sum(c).cast(types[c]).alias(c) for c in sums), *ends)
    return merged.select(*rollup.columns)
