"""First and last state of each id in a table of changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.functions.columns import own_column
from dayfold.session import fresh_folder


def min_max_by_key(
    df: DataFrame, key: str, value: str, low: str = "min_value", high: str = "max_value"
) -> DataFrame:
    """Smallest and largest value per key; text compares in text order.

    Both are taken in each task first, so what is exchanged is a row per key and task. For text Spark
    sorts a task's rows by key to do so, which measured as fast as packing the first seven bytes
    into a number, and much faster than wider numbers or than removing equal texts by hashing.
    """
    rows = df.select(own_column(df, key).alias("_key"), own_column(df, value).alias("_value"))
    return rows.groupBy(F.col("_key").alias(key)).agg(
        F.min("_value").alias(low), F.max("_value").alias(high)
    )


def first_last_state(df: DataFrame, id_col: str, time_col: str, state_col: str) -> DataFrame:
    """One row per id with its first and last time and the states held then.

    Ties stay whole: k rows at the first time and m at the last give k * m rows. A NULL id, and an
    id whose times are all NULL, keep one row with NULL states, since NULL matches nothing.

    The result is that of two left joins from the times of each id to the changes. The changes meet
    the times once, by an inner join on the id, which Spark can split where an id has very many of
    them; the few at either end are written to the shared folder, and first and last are paired from
    there, again by an inner join. Ids that match nothing go into the same table without a state.
    """
    changes = df.select(
        own_column(df, id_col).alias("id"),
        own_column(df, time_col).alias("time"),
        own_column(df, state_col).alias("state"),
    )
    ends = _ends(changes)
    folder = fresh_folder(df.sparkSession, "first-and-last")
    ends.write.parquet(folder)
    kept = df.sparkSession.read.schema(ends.schema).parquet(folder)

    first = kept.where("first").select("id", "start_time", F.col("state").alias("start_state"))
    last = kept.where("last").select("id", F.col("state").alias("end_state"), "end_time")
    columns = ["id", "start_time", "start_state", "end_time", "end_state"]
    alone = kept.where("first IS NULL").select(
        "id", "start_time", F.col("state").alias("start_state"), "end_time", F.col("state").alias("end_state")
    )
    found = first.join(last, "id").select(*columns).union(alone)
    return found.withColumnRenamed("id", id_col)


def _ends(changes: DataFrame) -> DataFrame:
    """The changes (id, time, state) at the first or the last time of their id, as ``first`` or ``last`` or both; and a
    row with NULL there and no state for an id without a time, or NULL.

    The id's hash is a key of the join beside the id, so that the times are exchanged anew for it: as they come from
    their aggregate Spark would not split the join.
    """
    again = F.xxhash64("id").alias("again")
    span = min_max_by_key(changes, "id", "time", "start_time", "end_time")
    timed = changes.where("id IS NOT NULL AND time IS NOT NULL").select("*", again)
    met = timed.join(span.where("start_time IS NOT NULL").select("*", again), ["id", "again"])
    at_start, at_end = F.col("time") == F.col("start_time"), F.col("time") == F.col("end_time")
    met = met.where(at_start | at_end).select(
        "id", "start_time", "end_time", "state", at_start.alias("first"), at_end.alias("last")
    )
    no, nothing = F.lit(None).cast("boolean"), F.lit(None).cast(changes.schema["state"].dataType)
    unmet = span.where("id IS NULL OR start_time IS NULL").select(
        "id", "start_time", "end_time", nothing.alias("state"), no.alias("first"), no.alias("last")
    )
    return met.union(unmet)
