"""Every query over the sample tables, by name: ``(spark, folder) -> DataFrame``.

A report runs over all days of its rollup; the same report under ``<name>_day`` runs over one day,
as the daily report does, and under ``<name>_range`` over a range of dates.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.functions.ratios import ratio, ratio_2dp, ratio_whole
from dayfold.functions.words import words_of
from dayfold.operators.history import first_last_state, min_max_by_key
from dayfold.operators.joins import left_join_on
from dayfold.operators.slices import date_range, day_slice
from dayfold.operators.words import (
    drop_split_words,
    register_split_words,
    register_split_words_dict,
    split_words,
    split_words_dict,
)
from dayfold.plans import reports, rollups, stand_ins
from dayfold.plans.stored import STORED_REPORTS, store, stored_report
from dayfold.session import fresh_folder
from dayfold.sources import tables
from dayfold.sources.tables import load

Query = Callable[[SparkSession, str], DataFrame]

EVENT_DAY = "2024-01-16"
SHIP_DAY = "1997-03-15"
RANGE_END = "1997-03-15"
ORDER_DAY = "1997-03-15"

# report, rollup, day of the one-day report (None: the rollup has no day)
REPORTS = {
    "keyword_totals": (reports.keyword_totals, stand_ins.keyword_rollup, None),
    "funnel_totals": (reports.funnel_totals, stand_ins.funnel_rollup, EVENT_DAY),
    "review_scores": (reports.review_scores, stand_ins.review_rollup, SHIP_DAY),
    "totals_by_region": (reports.totals_by_region, stand_ins.region_trade_rollup, ORDER_DAY),
    "totals_by_date": (reports.totals_by_date, stand_ins.daily_trade_rollup, None),
    "exam_by_paper": (reports.exam_by_paper, stand_ins.exam_rollup, SHIP_DAY),
    "exam_by_course": (reports.exam_by_course, stand_ins.exam_rollup, SHIP_DAY),
    "score_distribution": (reports.score_distribution, stand_ins.score_range_rollup, SHIP_DAY),
    "answer_rates": (reports.answer_rates, stand_ins.answer_rollup, SHIP_DAY),
}


def _report_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for name, (report, rollup, day) in REPORTS.items():
        found[name] = lambda s, d, report=report, rollup=rollup: report(rollup(s, d))
        if day:
            found[f"{name}_day"] = lambda s, d, report=report, rollup=rollup, day=day: report(
                rollup(s, d, day)
            )
    return found


def keyword_totals_day(spark: SparkSession, folder: str) -> DataFrame:
    return reports.keyword_totals(stand_ins.search_rollup(spark, folder, EVENT_DAY))


def totals_by_date_range(spark: SparkSession, folder: str) -> DataFrame:
    rollup = stand_ins.daily_trade_rollup(spark, folder)
    return reports.totals_by_date(date_range(rollup, "current_date", RANGE_END, 3))


def scan_all(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "lineitem").select("*")


def scan_pruned(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "lineitem").select("l_orderkey", "l_shipdate")


def partition_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The events stored by day, then one day of them."""
    rows = stand_ins.events(spark, folder)
    path = fresh_folder(spark, "events-by-day")
    tables.write_by_day(rows, path)
    return day_slice(tables.read_by_day(spark, path, rows.schema), EVENT_DAY)


def _fresh_database(spark: SparkSession) -> str:
    location = fresh_folder(spark, "tables")
    database = "dayfold_" + location.rsplit("-", 1)[-1]
    tables.create_database(spark, database, location)
    return database


def funnel_totals_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The funnel rollup of all days stored by day, then the report of one day."""
    database = _fresh_database(spark)
    tables.create_rollup_tables(spark, database, ["funnel"])
    store(stand_ins.funnel_rollup(spark, folder), database, "funnel")
    return stored_report(spark, database, "funnel_totals", EVENT_DAY)


def _loaded_daily(
    spark: SparkSession, folder: str, report: str, rollup: Callable[..., DataFrame], day: str
) -> DataFrame:
    """The stored report of a day, as daily loads leave it: the day before, the day, and the day a
    second time. The caller may drop the database once the result is read."""
    database, table = _fresh_database(spark), STORED_REPORTS[report][0]
    tables.create_rollup_tables(spark, database, [table])
    before = str(date.fromisoformat(day) - timedelta(days=1))
    for load_of in (before, day, day):
        store(rollup(spark, folder, load_of), database, table, replace=True)
    return stored_report(spark, database, report, day)


def totals_by_date_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The trade rollup of all days, one row each, and the report of a range of them."""
    database = _fresh_database(spark)
    tables.create_rollup_tables(spark, database, ["daily_trade"])
    store(stand_ins.daily_trade_rollup(spark, folder), database, "daily_trade")
    return stored_report(spark, database, "totals_by_date", RANGE_END, 3)


def _hourly(spark: SparkSession, folder: str, table: str, rollup: Callable[..., DataFrame]) -> str:
    """A database with the hourly sums of all days stored by day, and those of one day loaded again."""
    database = _fresh_database(spark)
    tables.create_rollup_tables(spark, database, [table], windows=True)
    store(rollup(spark, folder), database, table)
    store(rollup(spark, folder, EVENT_DAY), database, table, replace=True)
    return database


def keyword_totals_hourly_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The keyword report of a day whose stored rows are hours."""
    database = _hourly(spark, folder, "keyword", stand_ins.hourly_search_rollup)
    return stored_report(spark, database, "keyword_totals", EVENT_DAY)


def answer_rates_hourly_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The answer report of a day whose stored rows are hours; a user counts once in each hour."""
    database = _hourly(spark, folder, "answer", stand_ins.hourly_answer_rollup)
    return stored_report(spark, database, "answer_rates", EVENT_DAY)


def answer_rates_compacted_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same after the stored hours of all days have been merged into one row per day and question."""
    database = _hourly(spark, folder, "answer", stand_ins.hourly_answer_rollup)
    hours = spark.table(f"{database}.answer")
    days = rollups.compacted(hours, ["question_id", "question_txt"])
    tables.create_rollup_tables(spark, compact := _fresh_database(spark), ["answer"], windows=True)
    store(days, compact, "answer")
    return stored_report(spark, compact, "answer_rates", EVENT_DAY)


def _stored_queries() -> dict[str, Query]:
    """The other daily reports over stored tables."""
    loads = {name: (rollup, day) for name, (_, rollup, day) in REPORTS.items() if day}
    loads["keyword_totals"] = (stand_ins.search_rollup, EVENT_DAY)
    del loads["funnel_totals"]
    return {
        f"{name}_stored": lambda s, d, name=name, rollup=rollup, day=day: _loaded_daily(
            s, d, name, rollup, day
        )
        for name, (rollup, day) in loads.items()
    }


def table_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Drop, create, append a frame, append one row, append many rows, read back."""
    name = f"{_fresh_database(spark)}.changes"
    tables.drop_table(spark, name)
    for _ in range(2):
        tables.create_table(spark, name, "id bigint, add_time varchar(20), state string")  # fixed values
    tables.append(
        load(spark, folder, "orders").select(
            F.col("o_orderkey").alias("id"),
            F.to_date("o_orderdate").cast("string").alias("add_time"),
            F.col("o_orderstatus").alias("state"),
        ),
        name,
    )
    tables.append_rows(spark, name, [(-1, "2022-01-01", "大卷手纸")])
    tables.append_rows(spark, name, [(-2, "2022-01-01", "F"), (-2, "2022-01-02", None)])
    return spark.table(name)


def filter_date_between(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("order_date"), "o_totalprice"
    )
    return date_range(orders, "order_date", RANGE_END, 3)


def left_join_two_keys(
    spark: SparkSession, folder: str, hot_right: bool = False
) -> DataFrame:
    """Each order with its lines that were shipped on the day of the order, if any."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_shipdate", "l_quantity")
    keys = [("o_orderkey", "l_orderkey"), ("o_orderdate", "l_shipdate")]
    return left_join_on(orders, lines, keys, hot_right)


def min_max_of_text(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select(
        "o_custkey", F.to_date("o_orderdate").cast("string").alias("day_text")
    )
    return min_max_by_key(orders, "o_custkey", "day_text", "start_time", "end_time")


def order_states(spark: SparkSession, folder: str) -> DataFrame:
    return first_last_state(
        load(spark, folder, "orders"), "o_custkey", "o_orderdate", "o_orderstatus"
    )


def event_states(spark: SparkSession, folder: str) -> DataFrame:
    """Few ids with very many changes each."""
    return first_last_state(load(spark, folder, "events"), "user_id", "ts", "event_type")


def _flag_sums(spark: SparkSession, folder: str) -> tuple[DataFrame, tuple]:
    lines = load(spark, folder, "lineitem")
    returned = F.count_if(F.col("l_returnflag") == "R")
    return lines.groupBy("l_suppkey"), (F.sum(F.col("l_quantity").cast("bigint")), returned)


def ratio_of_sums(spark: SparkSession, folder: str) -> DataFrame:
    grouped, sums = _flag_sums(spark, folder)
    return grouped.agg(ratio(*sums).alias("quantity_per_return"))


def cast_decimal_ratio(spark: SparkSession, folder: str) -> DataFrame:
    grouped, sums = _flag_sums(spark, folder)
    return grouped.agg(ratio_2dp(*sums).alias("quantity_per_return"))


def cast_bigint_ratio(spark: SparkSession, folder: str) -> DataFrame:
    grouped, sums = _flag_sums(spark, folder)
    return grouped.agg(ratio_whole(*sums).alias("quantity_per_return"))


def additive_users(spark: SparkSession, folder: str) -> DataFrame:
    """Daily distinct users of each event type, added up over the days."""
    daily = rollups.users_window(
        stand_ins.events(spark, folder), ["dt", "event_type"], user="user_id"
    )
    return daily.groupBy("event_type").agg(F.sum("uv").alias("users_summed"))


def additive_users_hourly_day(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct users of each hour and event type of one day, added up over the hours."""
    hourly = rollups.users_window(
        rollups.in_windows(stand_ins.events(spark, folder, EVENT_DAY)),
        ["window_start", "event_type"],
        user="user_id",
    )
    return hourly.groupBy("event_type").agg(F.sum("uv").alias("users_summed"))


def document_words(spark: SparkSession, folder: str) -> DataFrame:
    return split_words(stand_ins.documents(spark, folder, "doc_id"), "text", keep=["doc_id"])


def part_name_words(spark: SparkSession, folder: str) -> DataFrame:
    """Part names with the spaces taken out, searched for the words of all part names."""
    parts = load(spark, folder, "part")
    dictionary = parts.select(F.explode(words_of(F.col("p_name"))).alias("word"))
    joined = parts.select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("")).alias("name"))
    return split_words_dict(joined, "name", dictionary, keep=["p_partkey"])


def document_dictionary_words(spark: SparkSession, folder: str) -> DataFrame:
    """How often each word of the benchmark texts occurs anywhere inside the documents."""
    dictionary = load(spark, folder, "benchmark").select(
        F.explode(words_of(F.col("text"))).alias("word")
    )
    documents = stand_ins.documents(spark, folder, "doc_id")
    found = split_words_dict(documents, "text", dictionary, keep=["doc_id"])
    return found.groupBy("word").agg(F.count("*").alias("places"))


def sql_split_words(spark: SparkSession, folder: str) -> DataFrame:
    """The word split called from SQL through a registered table function."""
    register_split_words(spark, "dayfold_words")
    found = spark.sql(
        "SELECT d.doc_id, w.keyword FROM {documents} AS d, LATERAL dayfold_words(d.text) AS w",
        documents=stand_ins.documents(spark, folder, "doc_id"),
    )
    drop_split_words(spark, "dayfold_words", missing_ok=False)
    return found


def sql_split_words_dict(spark: SparkSession, folder: str) -> DataFrame:
    """The dictionary split called from SQL, through a table function that reads a stored dictionary."""
    table = f"{_fresh_database(spark)}.words"
    tables.create_table(spark, table, "word string")
    parts = load(spark, folder, "part")
    tables.append(parts.select(F.explode(words_of(F.col("p_name"))).alias("word")), table)
    register_split_words_dict(spark, table, "dayfold_dictionary_words")
    found = spark.sql(
        "SELECT p.p_partkey, w.position, w.word FROM "
        "(SELECT p_partkey, replace(p_name, ' ', '') AS name FROM {parts}) AS p, "
        "LATERAL dayfold_dictionary_words(p.name) AS w",
        parts=parts,
    )
    drop_split_words(spark, "dayfold_dictionary_words", missing_ok=False)
    return found


QUERIES: dict[str, Query] = {
    **_report_queries(),
    "keyword_totals_day": keyword_totals_day,
    "totals_by_date_range": totals_by_date_range,
    "first_last_state": order_states,
    "first_last_state_events": event_states,
    "split_words": document_words,
    "split_words_dict": part_name_words,
    "split_words_dict_documents": document_dictionary_words,
    "register_split_words": sql_split_words,
    "register_split_words_dict": sql_split_words_dict,
    "scan_all": scan_all,
    "scan_pruned": scan_pruned,
    "partition_scan": partition_scan,
    "funnel_totals_stored": funnel_totals_stored,
    **_stored_queries(),
    "totals_by_date_stored": totals_by_date_stored,
    "keyword_totals_hourly_stored": keyword_totals_hourly_stored,
    "answer_rates_hourly_stored": answer_rates_hourly_stored,
    "answer_rates_compacted_stored": answer_rates_compacted_stored,
    "table_roundtrip": table_roundtrip,
    "filter_date_between": filter_date_between,
    "left_join_two_keys": left_join_two_keys,
    "left_join_two_keys_hot": lambda s, d: left_join_two_keys(s, d, hot_right=True),
    "min_max_by_key": min_max_of_text,
    "ratio_of_sums": ratio_of_sums,
    "cast_decimal_ratio": cast_decimal_ratio,
    "cast_bigint_ratio": cast_bigint_ratio,
    "additive_users": additive_users,
    "additive_users_hourly_day": additive_users_hourly_day,
}
