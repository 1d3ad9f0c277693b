"""Enough pieces for work that is heavy per row."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, pieces: int | None = None) -> DataFrame:
    """The rows dealt out over ``pieces`` tasks; as they are without a number.

    For frames just read from a few large files, ahead of work that costs far more than a shuffle
    of its input, such as the word split: a file of one row group is otherwise the work of one task.
    """
    return df.repartition(pieces) if pieces else df
