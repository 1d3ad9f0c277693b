"""Table lifecycle (create, append, read, drop) and storage partitioned by day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dayfold.functions.columns import own_column
from dayfold.operators.slices import as_day
from dayfold.sources.schemas import ROLLUP_SCHEMAS, WINDOW_SCHEMAS


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table kept as ``<folder>/<table>.parquet``."""
    return spark.read.parquet(f"{folder}/{table}.parquet")


def create_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)} LOCATION '{location}'")


def create_table(
    spark: SparkSession, name: str, columns: str, partition_by: Sequence[str] = ()
) -> None:
    """Create ``name`` (or ``database.name``) unless it exists; ``columns`` is DDL text."""
    by = ", ".join(f"`{c}`" for c in partition_by)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}) USING parquet"
        + (f" PARTITIONED BY ({by})" if by else "")
    )


def create_rollup_tables(
    spark: SparkSession,
    database: str,
    names: Iterable[str] = tuple(ROLLUP_SCHEMAS),
    windows: bool = False,
) -> list[str]:
    """Create rollup tables in ``database``, all or those named, each with a ``dt`` by it. With
    ``windows`` they hold the ends of windows inside the day."""
    made = list(names)
    for table in made:
        columns = (WINDOW_SCHEMAS.get(table) if windows else None) or ROLLUP_SCHEMAS[table]
        by = ["dt"] if columns.endswith("dt date") else []
        create_table(spark, f"{database}.{table}", columns, by)
    return made


def drop_database(spark: SparkSession, name: str) -> None:
    """Drop a database with all its tables, if it exists."""
    spark.sql(f"DROP DATABASE IF EXISTS {_quoted(name)} CASCADE")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")


def append_rows(spark: SparkSession, name: str, rows: Iterable[tuple]) -> None:
    """Append literal rows, given in the order of the table's columns."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in spark.table(name).schema])
    spark.createDataFrame(list(rows), schema).write.insertInto(name)


def _for_table(df: DataFrame, name: str) -> tuple[DataFrame, list[str]]:
    """The columns of ``df`` in the order of the table's, and the columns that it is stored by."""
    columns = df.sparkSession.table(name).columns
    if strangers := [c for c in df.columns if c not in columns]:
        raise ValueError(f"table {name} has no columns {strangers}")
    rows = df.select(*(own_column(df, c) for c in columns))
    stored_by = [c.name for c in df.sparkSession.catalog.listColumns(name) if c.isPartition]
    return rows.hint("rebalance", *stored_by) if stored_by else rows, stored_by


def append(df: DataFrame, name: str) -> None:
    """Append a frame by column name, with a few files per day where the table is stored by day.

    Raises for a column that the table lacks, and for one that the frame lacks.
    """
    _for_table(df, name)[0].write.insertInto(name)


def replace_days(df: DataFrame, name: str, days: Iterable[str | dt.date] = ()) -> None:
    """Write a frame in place of the days it holds, so that loading a day again changes nothing.

    Other days stay, but for those named in ``days``: of these the table keeps what the frame holds, so
    a day that has become empty at its source is emptied here too. Rows of days that are not among the
    named ones raise. The table has to be stored by day.
    """
    rows, stored_by = _for_table(df, name)
    if not stored_by:
        raise ValueError(f"table {name} is not stored by day")
    named = sorted({as_day(d) for d in days})
    if named:
        column = own_column(rows, stored_by[0])
        if not rows.where(column.isNull() | ~column.isin(named)).isEmpty():
            raise ValueError(f"the frame holds rows of other days than {[str(d) for d in named]}")
        filled = {r[0] for r in rows.select(column).distinct().collect()}
    conf, mode = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(mode)
    conf.set(mode, "dynamic")
    try:
        rows.write.insertInto(name, overwrite=True)
    finally:
        conf.set(mode, before)
    for day in named:
        if day not in filled:
            df.sparkSession.sql(
                f"ALTER TABLE {_quoted(name)} DROP IF EXISTS PARTITION (`{stored_by[0]}` = DATE '{day}')"
            )


def write_by_day(df: DataFrame, path: str, day: str = "dt") -> None:
    """Write one directory per day.

    Rows of a day are brought together, so that a day gets a few files and not one from every
    task; a day too large for one task is split by the rebalance.
    """
    df.hint("rebalance", day).write.partitionBy(day).parquet(path)


def read_by_day(spark: SparkSession, path: str, columns: str | T.StructType) -> DataFrame:
    """Read what ``write_by_day`` wrote. The schema is given: directory names carry no type."""
    return spark.read.schema(columns).parquet(path)
