"""Column lookup that cannot fall through to a function of the same name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def own_column(df: DataFrame, name: str) -> Column:
    """The column ``name`` of ``df``.

    A missing column called ``current_date`` would resolve to today's date without an error, so
    the name is looked up in the frame first.
    """
    if name not in df.columns:
        raise ValueError(f"no column {name!r} among {df.columns}")
    return df[f"`{name}`"]
