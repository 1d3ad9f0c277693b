"""Word split by pattern, by dictionary and from SQL."""

from __future__ import annotations

import random
import re

import pytest
from conftest import plan_of, rows_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from dayfold.operators import words as words_module
from dayfold.operators.words import (
    drop_split_words,
    register_split_words,
    register_split_words_dict,
    split_words,
    split_words_dict,
)

TEXTS = [(1, "Ab cd"), (2, None), (3, "--"), (4, ""), (5, "Été, éTÉ 42!"), (6, "大卷 手纸")]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame(TEXTS, "id bigint, text string")


def words_frame(spark, words):
    return spark.createDataFrame([(w,) for w in words], "word string")


def test_words_of_each_row(texts):
    assert rows_of(split_words(texts, "text", keep=["id"])) == [
        (1, "ab"),
        (1, "cd"),
        (5, "42"),
        (5, "été"),
        (5, "été"),
        (6, "大卷"),
        (6, "手纸"),
    ]


def test_keep_empty(texts):
    found = split_words(texts, "text", keep=["id"], pattern="[a-z]+", keep_empty=True)
    assert rows_of(found.where("id < 5")) == [(1, "ab"), (1, "cd"), (2, None), (3, None), (4, None)]


def test_no_python_in_the_split(texts):
    plan = plan_of(split_words(texts, "text", keep=["id"]))
    assert "EvalPython" not in plan and "Exchange" not in plan


def test_sql_function(spark, texts):
    texts.createOrReplaceTempView("texts")
    register_split_words(spark, "cut_words")
    inner = spark.sql("SELECT id, keyword FROM texts, LATERAL cut_words(text)")
    outer = spark.sql("SELECT id, keyword FROM texts LEFT JOIN LATERAL cut_words(text) ON true")
    assert rows_of(inner) == rows_of(split_words(texts, "text", keep=["id"]))
    assert rows_of(outer) == rows_of(split_words(texts, "text", keep=["id"], keep_empty=True))
    assert "EvalPython" not in plan_of(inner)
    drop_split_words(spark, "cut_words")
    drop_split_words(spark, "cut_words")
    with pytest.raises(AnalysisException):
        drop_split_words(spark, "cut_words", missing_ok=False)


def test_sql_function_with_quotes_in_the_pattern(spark):
    register_split_words(spark, "cut_quoted", pattern=r"[a-z']+|\d+")
    found = spark.sql(
        "SELECT keyword FROM VALUES ('It''s 12 o''clock') AS t(x), LATERAL cut_quoted(x)"
    )
    assert [r.keyword for r in found.collect()] == ["it's", "12", "o'clock"]
    drop_split_words(spark, "cut_quoted")


def test_dictionary_words_in_text_without_spaces(spark):
    texts = spark.createDataFrame([(6, "大卷手纸")], "id bigint, word string")
    dictionary = words_frame(spark, ["手纸", "卷"])
    found = split_words_dict(texts, "word", dictionary, keep=["id"])
    assert rows_of(found) == [(6, 2, "卷"), (6, 3, "手纸")]


def brute_force(texts, words):
    return sorted(
        (key, at + 1, w)
        for key, text in texts
        for at in range(len(text or ""))
        for w in set(words)
        if w and text.startswith(w, at)
    )


# limit in bytes, start of 400 further words, broadcast and merge joins in the plan
PATHS = {
    "broadcast": (64 << 20, "qqq", 3, 0),
    "heads of three": (10_000, "qqq", 1, 2),
    "heads of two": (6_000, "q", 1, 2),
    "shuffle": (0, "q", 0, 2),
}


@pytest.mark.parametrize("path", PATHS)
@pytest.mark.parametrize("seed", range(2))
def test_dictionary_against_brute_force(spark, settings, seed, path):
    """Long texts of several blocks, wide characters, words longer than a block."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    pick = random.Random(seed)
    letters = "ab纸é😀 \n"
    sizes = [0, 1, 5, 64, 65, 300] * 2
    texts = [(k, "".join(pick.choices(letters, k=n))) for k, n in enumerate(sizes)]
    texts += [(90, None), (91, "a" * 400)]
    long_text = max((t for _, t in texts if t), key=len)
    words = ["".join(pick.choices(letters, k=n)) for n in (1, 1, 2, 2, 3, 3, 4, 5, 6)]
    words += ["a", "", "aa", "a" * 70, long_text[30:130], "a"]
    words += ["".join(pick.choices(letters, k=3000))]
    limit, start, broadcasts, merges = PATHS[path]
    many = [f"{start}{n:03d}" for n in range(400)]
    found = split_words_dict(
        spark.createDataFrame(texts, "id bigint, text string"),
        "text",
        words_frame(spark, words + many),
        keep=["id"],
        broadcast_limit=limit,
        salts=4,
    )
    assert sorted(tuple(r) for r in found.collect()) == brute_force(texts, words)
    plan = plan_of(found)
    assert "EvalPython" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    joins = plan.count("BroadcastHashJoin"), plan.count("SortMergeJoin")
    assert joins == (broadcasts, merges)
    if broadcasts:
        assert f"substring(word#{{}}, 1, {2 if path == 'heads of two' else 3})" in re.sub(
            r"word#\d+", "word#{}", plan
        )


def test_short_words_take_no_row_per_place(spark):
    """Texts over several slices, cut inside characters and words, and more lengths of words than bits."""
    pick = random.Random(4)
    long_text = "".join(pick.choices(["a", "纸", "é😀", "bb", " word "], k=250_000))
    texts = [(1, None), (2, ""), (None, "xa"), (4, long_text), (5, "b" * 90), (5, "b" * 90), (6, "wor"), (7, "d 纸")]
    words = ["a", "é", "纸a", "😀纸é", "word", "word a", *("b" * n for n in range(1, 65)), *("😀" * n for n in range(10, 65)), "纸" * 30]
    frame = spark.createDataFrame(texts, "id bigint, text string").repartition(2)
    found = split_words_dict(frame, "text", words_frame(spark, [*words, "", None, "a"]), keep=["id"])
    assert "Generate" not in plan_of(found) and "BroadcastHashJoin" in plan_of(found)
    none = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, found.collect()), key=none) == sorted(
        ((key, at + 1, w) for key, text in texts for at in range(len(text or "")) for w in words if text.startswith(w, at)), key=none
    )


def test_kept_columns_of_any_type(spark):
    texts = spark.createDataFrame([(1, "ab")], "id int, text string").selectExpr("map(id, text) AS m", "array(id) AS l", "cast(id AS decimal(20, 2)) AS d", "text")
    assert split_words_dict(texts, "text", words_frame(spark, ["b"]), keep=["m", "l", "d"]).first() == ({1: "ab"}, [1], 1, 2, "b")


def test_empty_dictionary(spark, texts):
    assert split_words_dict(texts, "text", words_frame(spark, []), keep=["id"]).count() == 0


def test_null_words_are_ignored(spark):
    texts = spark.createDataFrame([(1, "ab")], "id bigint, text string")
    found = split_words_dict(texts, "text", words_frame(spark, [None, "b"]), keep=["id"])
    assert rows_of(found) == [(1, 2, "b")]


def test_dictionary_is_broadcast_only_within_the_limit(spark, settings, sf_dir):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    dictionary = parts.select(F.explode(F.split("p_name", " ")).alias("word"))

    def plan(limit):
        return plan_of(
            split_words_dict(parts, "p_name", dictionary, ["p_partkey"], broadcast_limit=limit)
        )

    assert "BroadcastHashJoin" in plan(64 << 20) and "SortMergeJoin" not in plan(64 << 20)
    assert "BroadcastHashJoin" not in plan(0) and "SortMergeJoin" in plan(0)


def test_hash_lookup_compares_the_texts(spark, monkeypatch):
    """Even if all hashes were alike, only equal texts would match."""
    monkeypatch.setattr(words_module.F, "xxhash64", lambda *columns: F.lit(1).cast("bigint"))
    texts = spark.createDataFrame([(1, "abcab")], "id bigint, text string")
    found = split_words_dict(texts, "text", words_frame(spark, ["ab", "bca", "x"]), keep=["id"])
    assert rows_of(found) == [(1, 1, "ab"), (1, 2, "bca"), (1, 4, "ab")]


def test_dictionary_is_computed_once(spark, tmp_path):
    """What is measured is what is looked up, even if the source has changed in between."""
    folder = str(tmp_path / "words")
    words_frame(spark, ["ab"]).write.parquet(folder)
    counted = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    dictionary = spark.read.parquet(folder).mapInArrow(seen, "word string")
    texts = spark.createDataFrame([(1, "abcab")], "id bigint, text string")
    found = split_words_dict(texts, "text", dictionary, keep=["id"])
    words_frame(spark, ["abcab"]).write.mode("overwrite").parquet(folder)
    assert rows_of(found) == [(1, 1, "ab"), (1, 4, "ab")]
    assert counted.value == 1


@pytest.mark.parametrize("name", ["word", "position"])
def test_kept_columns_must_not_be_called_like_the_result(spark, name):
    texts = spark.createDataFrame([("x", "ab")], f"{name} string, text string")
    with pytest.raises(ValueError, match="rename"):
        split_words_dict(texts, "text", words_frame(spark, ["a"]), keep=[name])


def test_kept_columns_may_have_any_other_name(spark):
    texts = spark.createDataFrame([(1, 2, "ab")], "_text int, _rest int, text string")
    found = split_words_dict(texts, "text", words_frame(spark, ["b", "c" * 100]), keep=["_rest", "_text"])
    assert found.columns == ["_rest", "_text", "position", "word"]
    assert rows_of(found) == [(2, 1, 2, "b")]


def test_a_long_word_does_not_widen_the_lookup(spark):
    """Places carry a link of it at most, so texts that do not hold the link cost what they cost without it."""
    texts = spark.createDataFrame([(1, "ab" * 5000)], "id bigint, text string")
    found = split_words_dict(texts, "text", words_frame(spark, ["ba", "c" * 4000]), keep=["id"])
    assert f"{words_module.LINK}) AS _rest" in plan_of(found)
    assert found.count() == 4999


def test_long_words_with_one_beginning(spark):
    text = "xy" * 200 + "z"
    words = ["xy" * n for n in (32, 33, 100, 200)] + ["xy" * 200 + "z", "xy" * 32 + "q", "z"]
    texts = spark.createDataFrame([(1, text)], "id bigint, text string")
    found = split_words_dict(texts, "text", words_frame(spark, words), keep=["id"])
    assert sorted(tuple(r) for r in found.collect()) == brute_force([(1, text)], words)


def test_dictionary_function_in_sql(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS words_db LOCATION '{tmp_path}'")
    texts = [(1, "大卷手纸" * 40), (2, None), (3, ""), (4, "xyz"), (4, "xyz"), (5, "a\n😀a" + "b" * 70)]
    words = ["手纸", "卷", "纸大卷", "a", "😀", "b" * 65, "", "xyz"]
    try:
        words_frame(spark, [*words, None, "卷"]).write.saveAsTable("words_db.words")
        register_split_words_dict(spark, "words_db.words", "dict_words")
        spark.createDataFrame(texts, "id bigint, text string").createOrReplaceTempView("dict_texts")
        found = spark.sql("SELECT d.id, w.* FROM dict_texts AS d, LATERAL dict_words(d.text) AS w")
        assert sorted(tuple(r) for r in found.collect()) == brute_force(texts, words)
        plan = plan_of(found)
        assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
        # words that are added to the table later are found
        words_frame(spark, ["yz"]).write.insertInto("words_db.words")
        more = spark.sql("SELECT w.word FROM dict_texts AS d, LATERAL dict_words(d.text) AS w WHERE d.id = 4")
        assert rows_of(more) == [("xyz",), ("xyz",), ("yz",), ("yz",)]
        drop_split_words(spark, "dict_words", missing_ok=False)
    finally:
        spark.sql("DROP DATABASE words_db CASCADE")
