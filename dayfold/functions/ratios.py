"""Ratios of sums and the casts the reports put around them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as double; NULL where the divisor is zero or NULL."""
    return F.try_divide(numerator, denominator)


def ratio_2dp(numerator: Column, denominator: Column) -> Column:
    """The ratio rounded half-up to two places."""
    return ratio(numerator, denominator).cast("decimal(16,2)")


def ratio_whole(numerator: Column, denominator: Column) -> Column:
    """The ratio cut to a whole number, toward zero."""
    return ratio(numerator, denominator).cast("bigint")


def money(column: Column) -> Column:
    """An amount made exact before it is summed, so that the order of addition cannot matter."""
    return column.cast("decimal(18,2)")
