"""Identities that hold for any rows."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from conftest import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dayfold.operators.history import first_last_state
from dayfold.operators.joins import left_join_on
from dayfold.operators.slices import day_slice
from dayfold.operators.words import split_words_dict
from dayfold.plans import reports, rollups

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
maybe = st.one_of(st.none(), st.integers(0, 4))
changes = st.lists(st.tuples(maybe, maybe, maybe), max_size=30)


@few
@given(rows=changes)
def test_rows_per_id_multiply_the_ties(spark, rows):
    df = spark.createDataFrame(rows, "id int, time int, state int")
    found = first_last_state(df, "id", "time", "state").collect()
    count = Counter(r.id for r in found)
    for key in {r[0] for r in rows}:
        times = [r[1] for r in rows if r[0] == key and r[1] is not None]
        known = key is not None and times
        low, high = (times.count(min(times)), times.count(max(times))) if known else (1, 1)
        assert count.pop(key) == low * high
    assert not count


@few
@given(rows=changes, pieces=st.integers(1, 6))
def test_partitioning_of_changes_does_not_matter(spark, rows, pieces):
    df = spark.createDataFrame(rows, "id int, time int, state int")
    one = first_last_state(df.coalesce(1), "id", "time", "state")
    many = first_last_state(df.repartition(pieces), "id", "time", "state")
    assert rows_of(one) == rows_of(many)


@few
@given(left=st.lists(st.tuples(maybe, maybe), max_size=12), right=changes)
def test_both_left_joins_agree(spark, left, right):
    a = spark.createDataFrame(left, "k int, t int")
    b = spark.createDataFrame(right, "rk int, rt int, v int")
    keys = [("k", "rk"), ("t", "rt")]
    assert rows_of(left_join_on(a, b, keys)) == rows_of(left_join_on(a, b, keys, hot_right=True))


DAYS = [dt.date(2024, 11, d) for d in (15, 16, 17)]
amounts = st.lists(
    st.tuples(st.sampled_from(DAYS), maybe, st.floats(-1e6, 1e6).map(lambda x: round(x, 2))),
    min_size=1,
    max_size=30,
)


@few
@given(rows=amounts)
def test_totals_by_date_are_totals_of_the_raw_rows(spark, rows):
    orders = spark.createDataFrame(rows, "dt date, user_id int, amount double")
    rollup = rollups.daily_trade_window(orders)
    for r in reports.totals_by_date(rollup).collect():
        day = [x for x in rows if x[0] == r.biz_date]
        assert float(r.final_amount) == round(sum(x[2] for x in day), 2)
        assert r.uv == len({x[1] for x in day if x[1] is not None}) and r.vv == len(day)


@few
@given(rows=amounts)
def test_days_add_up_to_the_whole(spark, rows):
    orders = spark.createDataFrame(rows, "dt date, user_id int, amount double")
    users = spark.createDataFrame([(u, u % 2) for u in range(5)], "user_id int, region_id int")
    regions = spark.createDataFrame([(0, "p"), (1, "q")], "region_id int, province_name string")
    rollup = rollups.region_trade_window(orders, users, regions)
    whole = reports.totals_by_region(rollup)
    by_day = [reports.totals_by_region(day_slice(rollup, d)) for d in DAYS]
    added = (
        by_day[0]
        .unionByName(by_day[1])
        .unionByName(by_day[2])
        .groupBy("province_name")
        .agg(*(F.sum(c).alias(c) for c in ("final_amount", "uv", "vv")))
    )
    assert rows_of(whole) == rows_of(added)


@few
@given(
    texts=st.lists(st.text("ab纸😀 ", max_size=150), max_size=6),
    words=st.lists(st.text("ab纸😀 ", max_size=5), max_size=8),
    limit=st.sampled_from([0, 500, 1 << 20]),
)
def test_dictionary_words_are_all_found(spark, texts, words, limit):
    found = split_words_dict(
        spark.createDataFrame(list(enumerate(texts)), "id int, text string"),
        "text",
        spark.createDataFrame([(w,) for w in words], "word string"),
        keep=["id"],
        broadcast_limit=limit,
        salts=3,
    )
    expected = sorted(
        (i, at + 1, w)
        for i, text in enumerate(texts)
        for w in set(words)
        if w
        for at in range(len(text))
        if text.startswith(w, at)
    )
    assert sorted(tuple(r) for r in found.collect()) == expected
