"""One day, or a range of days, of a table."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.functions.columns import own_column


def as_day(day: str | dt.date) -> dt.date:
    """A date from a date, ``2024-11-16``, or a partition name that ends in ``20241116``."""
    if isinstance(day, dt.datetime):
        return day.date()
    if isinstance(day, dt.date):
        return day
    found = re.search(r"(\d{4})-?(\d{2})-?(\d{2})$", day)
    if not found:
        raise ValueError(f"no date in {day!r}")
    return dt.date(*map(int, found.groups()))


def day_slice(
    df: DataFrame, day: str | dt.date, column: str = "dt", strict: bool = False
) -> DataFrame:
    """The rows of one day. Prunes to one directory where ``df`` is stored by that column.

    The column may be a date, a timestamp, a whole number such as 20241116, or text that starts
    with 2024-11-16 or is 20241116; numbers and text are compared in their own spelling. A day that
    holds no rows gives an empty frame; ``strict`` raises for it instead, at the price of one small
    job.
    """
    value, wanted = own_column(df, column), as_day(day)
    compact, kind = f"{wanted:%Y%m%d}", df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        match = value == F.lit(int(compact))
    elif isinstance(kind, T.StringType):
        match = _spelled(value, wanted, wanted)
    else:
        match = value.cast("date") == F.lit(wanted)
    sliced = df.where(match)
    if strict and sliced.isEmpty():
        raise ValueError(f"no rows for {as_day(day)} in column {column!r}")
    return sliced


def date_range(df: DataFrame, column: str, end: str | dt.date, days_before: int) -> DataFrame:
    """The rows from ``days_before`` days before ``end`` up to ``end``, both days included. The
    column is as in ``day_slice``."""
    last, value, kind = as_day(end), own_column(df, column), df.schema[column].dataType
    first = last - dt.timedelta(days=days_before)
    if isinstance(kind, T.IntegralType):
        return df.where(value.between(int(f"{first:%Y%m%d}"), int(f"{last:%Y%m%d}")))
    if isinstance(kind, T.StringType):
        return df.where(_spelled(value, first, last))
    return df.where(value.cast("date").between(F.date_sub(F.lit(last), days_before), F.lit(last)))


def _spelled(value: Column, first: dt.date, last: dt.date) -> Column:
    """Whether a text begins with one of the days, as ranges of text, which a Parquet scan can use.

    Days are spelled 2024-11-16, alone or before a time (after a blank or a T), or 20241116.
    """
    dashed, solid = (str(first), str(last)), (f"{first:%Y%m%d}", f"{last:%Y%m%d}")
    # all that begins with the last day sorts before the same text ending in the next character
    ranges = [(value >= a) & (value < b[:-1] + chr(ord(b[-1]) + 1)) for a, b in (dashed, solid)]
    exact = value.rlike(r"^(\d{4}-\d{2}-\d{2}([ T]|$)|\d{8}$)")
    return (ranges[0] | ranges[1]) & exact
