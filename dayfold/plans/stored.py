"""Reports over rollup tables that are stored in a database, by report name and day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from dayfold.operators.slices import date_range
from dayfold.plans import reports
from dayfold.sources import tables

# report name: the table it reads, the column that holds the day, the report
STORED_REPORTS = {
    "keyword_totals": ("keyword", "dt", reports.keyword_totals),
    "funnel_totals": ("funnel", "dt", reports.funnel_totals),
    "review_scores": ("review", "dt", reports.review_scores),
    "totals_by_region": ("region_trade", "dt", reports.totals_by_region),
    "totals_by_date": ("daily_trade", "current_date", reports.totals_by_date),
    "exam_by_paper": ("exam", "dt", reports.exam_by_paper),
    "exam_by_course": ("exam", "dt", reports.exam_by_course),
    "score_distribution": ("score_range", "dt", reports.score_distribution),
    "answer_rates": ("answer", "dt", reports.answer_rates),
}


def store(rollup: DataFrame, database: str, table: str, replace: bool = False) -> None:
    """Append the rows of a rollup to its table, by column name; with ``replace``, in place of what
    the table holds of their days."""
    write = tables.replace_days if replace else tables.append
    write(rollup, f"{database}.{table}")


def stored_report(
    spark: SparkSession,
    database: str,
    report: str,
    day: str | dt.date | None = None,
    days_before: int = 0,
) -> DataFrame:
    """A report of one day, of the days up to it, or of all that is stored.

    Only the directories of those days are read, where the table is stored by day.
    """
    table, day_column, make = STORED_REPORTS[report]
    rows = spark.table(f"{database}.{table}")
    return make(date_range(rows, day_column, day, days_before) if day else rows)
