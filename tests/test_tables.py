"""Table lifecycle, storage by day, and the shared folder."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import plan_of, rows_of
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import functions as F

from dayfold import session
from dayfold.operators.slices import day_slice
from dayfold.sources import tables
from dayfold.sources.schemas import ROLLUP_SCHEMAS


@pytest.fixture
def database(spark):
    location = session.fresh_folder(spark, "database")
    name = "db_" + location.rsplit("-", 1)[-1]
    tables.create_database(spark, name, location)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_lifecycle(spark, database):  # the columns and the text below are fixed values
    name = f"{database}.changes"
    tables.drop_table(spark, name)
    tables.create_table(spark, name, "id bigint, add_time varchar(20), state bigint")
    tables.append_rows(spark, name, [(1, "2022-01-01", 1)])
    tables.create_table(spark, name, "id bigint, add_time varchar(20), state bigint")
    tables.append_rows(spark, name, [(1, "2022-01-02", None), (2, "大卷手纸", 3)])
    assert rows_of(spark.table(name)) == [
        (1, "2022-01-01", 1),
        (1, "2022-01-02", None),
        (2, "大卷手纸", 3),
    ]
    tables.drop_table(spark, name)
    with pytest.raises(AnalysisException):
        spark.table(name).collect()


def test_text_too_long_for_its_column(spark, database):
    name = f"{database}.short"
    tables.create_table(spark, name, "t varchar(3)")
    with pytest.raises(SparkRuntimeException, match="EXCEED_LIMIT_LENGTH"):
        tables.append_rows(spark, name, [("abcd",)])


def test_append_goes_by_column_name(spark, database):
    name = f"{database}.named"
    tables.create_table(spark, name, "a bigint, b bigint")
    tables.append(spark.range(1).select(F.lit(2).alias("b"), F.lit(1).alias("a")), name)
    assert rows_of(spark.table(name)) == [(1, 2)]


def test_append_raises_on_a_column_the_table_lacks(spark, database):
    name = f"{database}.narrow"
    tables.create_table(spark, name, "a bigint")
    with pytest.raises(ValueError, match="extra"):
        tables.append(spark.range(1).select(F.lit(1).alias("a"), F.lit(2).alias("extra")), name)
    with pytest.raises(ValueError, match="no column"):
        tables.append(spark.range(1), name)


def test_a_day_loaded_twice_is_there_once(spark, database):
    tables.create_rollup_tables(spark, database, ["keyword"])
    name, schema = f"{database}.keyword", ROLLUP_SCHEMAS["keyword"]
    days = [dt.date(2024, 11, 15), dt.date(2024, 11, 16)]
    tables.replace_days(spark.createDataFrame([("a", 1, d) for d in days], schema), name)
    for _ in range(2):
        tables.replace_days(spark.createDataFrame([("a", 5, days[1]), ("b", 2, days[1])], schema), name)
    assert rows_of(spark.table(name)) == [("a", 1, days[0]), ("a", 5, days[1]), ("b", 2, days[1])]
    tables.create_table(spark, f"{database}.flat", "a bigint")
    with pytest.raises(ValueError, match="not stored by day"):
        tables.replace_days(spark.range(1).withColumnRenamed("id", "a"), f"{database}.flat")


def test_drop_database(spark):
    location = session.fresh_folder(spark, "database")
    name = "gone_" + location.rsplit("-", 1)[-1]
    tables.create_database(spark, name, location)
    tables.create_table(spark, f"{name}.t", "a bigint")
    tables.drop_database(spark, name)
    tables.drop_database(spark, name)
    assert not spark.catalog.databaseExists(name)


def test_rollup_tables_are_stored_by_day(spark, database):
    assert tables.create_rollup_tables(spark, database) == list(ROLLUP_SCHEMAS)
    name = f"{database}.keyword"
    days = [dt.date(2024, 11, 15), dt.date(2024, 11, 16)]
    rows = [(w, n, d) for d in days for w, n in (("spark", 2), ("sql", 3))]
    schema = "keyword string, keyword_count bigint, dt date"
    tables.append(spark.createDataFrame(rows, schema).repartition(8), name)
    sliced = day_slice(spark.table(name), "par20241116")
    assert rows_of(sliced) == [("spark", 2, days[1]), ("sql", 3, days[1])]
    plan = plan_of(sliced)
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert len(spark.table(name).inputFiles()) == 2


def test_a_stored_column_named_current_date(spark, database):
    tables.create_rollup_tables(spark, database)
    name = f"{database}.daily_trade"
    frame = spark.sql(
        "SELECT DATE'2024-11-16' AS `current_date`, CAST(1.5 AS DECIMAL(28,2)) AS final_amount, "
        "1L AS uv, 2L AS vv"
    )
    tables.append(frame, name)
    assert spark.table(name).first()[0] == dt.date(2024, 11, 16)


def test_write_and_read_by_day(spark):
    path = session.fresh_folder(spark, "by-day")
    rows = spark.range(0, 1000, 1, 8).select(
        "id", F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 4).cast("int")).alias("dt")
    )
    tables.write_by_day(rows, path)
    back = tables.read_by_day(spark, path, rows.schema)
    assert rows_of(back) == rows_of(rows)
    one_day = day_slice(back, "20240103")
    assert one_day.count() == 250 and len(one_day.inputFiles()) <= 4
    assert "PartitionFilters: [isnotnull(dt" in plan_of(one_day)


def test_a_large_day_is_written_by_several_tasks(spark, settings):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB")
    path = session.fresh_folder(spark, "large-day")
    rows = spark.range(0, 200_000, 1, 8).select("id", F.lit(dt.date(2024, 1, 1)).alias("dt"))
    tables.write_by_day(rows, path)
    back = tables.read_by_day(spark, path, rows.schema)
    assert back.count() == 200_000 and len(back.inputFiles()) > 1


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark) == named
    assert session.fresh_folder(spark, "x").startswith(named + "/")
    assert session.fresh_folder(spark, "x") != session.fresh_folder(spark, "x")


class Conf(dict):
    conf = property(lambda self: self)


def test_a_cluster_must_name_the_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Conf({"spark.master": "spark://host:7077"}))


def test_a_local_session_uses_its_warehouse():
    local = Conf({"spark.master": "local[2]", "spark.sql.warehouse.dir": "file:/somewhere/"})
    assert session.shared_folder(local) == "file:/somewhere"


def test_a_day_that_has_become_empty(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS emptied LOCATION '{tmp_path}'")
    try:
        tables.create_table(spark, "emptied.t", "a string, n int, dt date", ["dt"])
        days = [dt.date(2024, 11, d) for d in (15, 16, 17)]
        schema = "a string, n int, dt date"
        tables.replace_days(spark.createDataFrame([("a", 1, d) for d in days], schema), "emptied.t")
        # nothing to load for the 16th, new sums for the 17th
        again = spark.createDataFrame([("b", 2, days[2])], schema)
        tables.replace_days(again, "emptied.t", ["par20241116", days[2]])
        assert rows_of(spark.table("emptied.t")) == [("a", 1, days[0]), ("b", 2, days[2])]
        tables.replace_days(again.limit(0), "emptied.t", [days[2], "2024-11-30"])
        assert rows_of(spark.table("emptied.t")) == [("a", 1, days[0])]
        with pytest.raises(ValueError, match="other days"):
            tables.replace_days(again, "emptied.t", [days[0]])
        assert rows_of(spark.table("emptied.t")) == [("a", 1, days[0])]
    finally:
        spark.sql("DROP DATABASE emptied CASCADE")
