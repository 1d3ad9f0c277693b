"""Phrases whose words stand together far more often than apart, by dynamic itemset counting.

A phrase is a run of words within one piece of a text; pieces end at ``.,;:!?`` and line ends, words at blanks and tabs.
A-Z count as a-z. Everything is counted per language (NULL: ``und``).

The texts are dealt into shards, which are scanned in a cycle, one Spark job each. Words are counted from the first scan
on. A longer phrase is counted as soon as its two subphrases (without its last, without its first word) have reached the
threshold, from the next scan on and for one full cycle, so that all lengths are counted side by side and every counted
phrase is counted over all texts, once. The job ends when no phrase is short of its cycle.

What is active, and since when, goes to the tasks as a table of fixed size, one byte per hashed phrase. Phrases that share
a byte are activated together, by whichever is first, but each is counted from the step on at which all its subphrases are
active: some are then counted without need, and none is missed or counted for less than a cycle. A full table means more phrases to count, never other results. The counts themselves are kept by
the phrases' texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayfold.llm.common import BYTE_VALUES, LOWER, MULTIPLIER, attached, mixed, pieces, prefix_hash, span_hash, stored, text_bytes
from dayfold.session import fresh_folder

ENDS_PIECE = np.zeros(256, bool)
ENDS_PIECE[np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8)] = True
ENDS_WORD = ENDS_PIECE.copy()
ENDS_WORD[np.frombuffer(b" \t", np.uint8)] = True

#: Texts of so many bytes are counted together before their counts leave a task.
TOGETHER = 8 << 20

#: Phrases that leave a task in one batch.
ROWS = 1 << 18

#: Bytes of the table of active phrases, one table per length.
SLOTS = 1 << 24

COUNTS = "lang string, n int, since int, phrase string, f bigint"


def _words(data: np.ndarray, offsets: np.ndarray):
    """The words of the texts as codes into the distinct words, and for each the piece it stands in."""
    data = LOWER[data]
    inside = ~ENDS_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (np.r_[True, ~inside[:-1]] | edge[:-1]))
    ends = np.flatnonzero(inside & (np.r_[~inside[1:], True] | edge[1:])) + 1
    bounds = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[inside])])
    coded = pc.dictionary_encode(words)
    piece = np.cumsum(ENDS_PIECE[data] | edge[:-1])[starts]
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), piece


def _hashes(words: pa.Array, lang: str) -> np.ndarray:
    """A 64-bit hash of each word in its language."""
    data, offsets = text_bytes(words.cast(pa.large_string()))
    own = np.frombuffer(lang.encode() or b"\0", np.uint8)
    seed = span_hash(prefix_hash(BYTE_VALUES[own]), np.zeros(1, np.int64), np.array([len(own)]))
    return mixed(span_hash(prefix_hash(BYTE_VALUES[data]), offsets[:-1], offsets[1:]) ^ seed)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of phrases, each from that of the phrase without its last word and that of this word."""
    return mixed(left * np.uint64(MULTIPLIER) + right)


def _counted(batches: Iterator[pa.RecordBatch], active: list[np.ndarray], step: int, shards: int) -> Iterator[pa.RecordBatch]:
    """Counts of the texts (lang, text) of one shard: of words in the first cycle, and of the phrases in their cycle.

    ``active[n - 1]`` has for each slot the step from which on what extends a phrase of n words there is counted, or 0.
    """
    for batch in batches:
        for lang in batch.column("lang").unique().to_pylist():
            data, offsets = text_bytes(batch.filter(pc.equal(batch.column("lang"), lang)).column("text"))
            for first, last in pieces(offsets, TOGETHER):
                some = data[offsets[first] : offsets[last]]
                yield from _of_texts(some, offsets[first : last + 1] - offsets[first], lang, active, step, shards)


def _of_texts(data, offsets, lang, active, step, shards):
    words, codes, piece = _words(data, offsets)
    if len(codes) == 0:
        return

    def rows(n: int, since: np.ndarray, phrases: pa.Array, counts: np.ndarray):
        for i in range(0, len(counts), ROWS):
            part = slice(i, i + ROWS)
            size = len(counts[part])
            columns = [pa.repeat(lang, size), pa.repeat(pa.scalar(n, pa.int32()), size), pa.array(since[part].astype(np.int32))]
            columns += [phrases[part].cast(pa.string()), pa.array(counts[part].astype(np.int64))]
            yield pa.record_batch(columns, names=["lang", "n", "since", "phrase", "f"])

    words = words.cast(pa.large_string())
    if step < shards:
        yield from rows(1, np.zeros(len(words), np.int32), words, np.bincount(codes, minlength=len(words)))
    word_hash = _hashes(words, lang)
    # for the phrase of n - 1 words that begins at a place: its hash, and from when on its extensions are counted
    hashes = word_hash[codes]
    since = active[0][hashes % np.uint64(len(active[0]))]
    for n in range(2, len(active) + 2):
        if len(codes) < n:
            return
        together = piece[n - 1 :] == piece[: len(piece) - n + 1]
        known = together & (since[:-1] > 0) & (since[1:] > 0)
        since = np.where(known, np.maximum(since[:-1], since[1:]), 0)
        places = np.flatnonzero(since > max(0, step - shards))
        if len(places):
            key = codes[places]
            for i in range(1, n):
                if i > 1:
                    key = np.unique(key, return_inverse=True)[1]
                key = key * len(words) + codes[places + i]
            _, at, counts = np.unique(key, return_index=True, return_counts=True)
            at = places[at]
            phrases = pc.binary_join_element_wise(*(words.take(pa.array(codes[at + i])) for i in range(n)), pa.scalar(" ", pa.large_string()))
            yield from rows(n, since[at], phrases, counts)
        if n <= len(active):
            hashes = _joined(hashes[:-1], word_hash[codes[n - 1 :]])
            # a slot may be older than the phrase, which is not counted before its own subphrases are active
            slot = active[n - 1][hashes % np.uint64(len(active[n - 1]))]
            since = np.where(known & (slot > 0), np.maximum(slot, since), 0)


def _slots(batches: Iterator[pa.RecordBatch], slots: int) -> Iterator[pa.RecordBatch]:
    """(n, slot) of phrases (lang, n, phrase)."""
    for batch in batches:
        for lang in batch.column("lang").unique().to_pylist():
            of_lang = batch.filter(pc.equal(batch.column("lang"), lang))
            for n in of_lang.column("n").unique().to_pylist():
                phrases = of_lang.filter(pc.equal(of_lang.column("n"), n)).column("phrase")
                words = pc.list_flatten(pc.split_pattern(phrases, " "))
                hashes = _hashes(words, lang).reshape(-1, n)
                found = hashes[:, 0]
                for i in range(1, n):
                    found = _joined(found, hashes[:, i])
                slot = (found % np.uint64(slots)).astype(np.int64)
                yield pa.record_batch([pa.repeat(pa.scalar(n, pa.int32()), len(slot)), pa.array(slot)], names=["n", "slot"])


def _activate(frequent: DataFrame, active: list[np.ndarray], step: int) -> bool:
    """Set the free slots of ``frequent`` (lang, n, phrase) to ``step``; whether there were any.

    The slots come to the driver as bits, so as many bytes as an eighth of the table at most.
    """
    size = len(active[0])
    slots = frequent.select("lang", "n", "phrase").mapInArrow(lambda batches: _slots(batches, size), "n int, slot bigint")
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    words = slots.groupBy("n", F.shiftright("slot", 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    some = False
    for n in range(1, len(active) + 1):
        of_n = words.filter(pc.equal(words.column("n"), n))
        bits = np.zeros(size // 64, np.int64)
        bits[of_n.column("at").to_numpy()] = of_n.column("bits").to_numpy()
        fresh = np.unpackbits(bits.view(np.uint8), bitorder="little").astype(bool) & (active[n - 1] == 0)
        active[n - 1][fresh] = step
        some |= bool(fresh.any())
    return some


def phrase_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, least: int = 10, shards: int = 3, slots: int = SLOTS
) -> DataFrame:
    """(lang, n, phrase, f) of all words, and of the phrases of 2 to ``longest`` words found ``least`` times or more.

    NULL texts are empty. ``slots`` is the size of the table of active phrases, a multiple of 64.
    """
    spark = docs.sparkSession
    place = F.pmod(F.xxhash64(lang, text), F.lit(shards)).cast("int").alias("shard")
    folder = fresh_folder(spark, "phrase-shards")
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"), place)
    rows.where(F.length("text") > 0).write.partitionBy("shard").parquet(folder)
    texts = spark.read.schema("lang string, text string, shard int").parquet(folder)

    active = [np.zeros(slots, np.uint8) for _ in range(longest - 1)]
    done, still, step, until = [], None, 0, shards
    while step < until:
        sent = spark.sparkContext.broadcast([zlib.compress(a, 1) for a in active])
        shard = texts.where(F.col("shard") == step % shards).select("lang", "text")
        counts = shard.mapInArrow(_scan(sent, step, shards), COUNTS)
        counts = counts if still is None else counts.unionByName(still)
        counts = counts.groupBy("lang", "n", "since", "phrase").agg(F.sum("f").alias("f"))
        # a phrase whose cycle is over and that is too rare is no longer needed
        ends = F.col("since") + shards - 1
        counts = stored(counts.where((ends > step) | (F.col("n") == 1) | (F.col("f") >= least)), "phrase-counts")
        sent.destroy()
        done.append(counts.where(ends == step))
        still = counts.where(ends > step)
        step += 1
        if _activate(counts.where((F.col("f") >= least) & (F.col("n") < longest)), active, step):
            until = max(until, step + shards)
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found.select("lang", "n", "phrase", "f")


def _scan(active: Broadcast, step: int, shards: int):
    def scan(batches):
        tables = [np.frombuffer(zlib.decompress(a), np.uint8) for a in active.value]
        return _counted(batches, tables, step, shards)

    return scan


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = 3,
    least: int = 10,
    contained_percent: int = 50,
    top: int = 2000,
    shards: int = 3,
    slots: int = SLOTS,
) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a, l, r, n, score.

    A candidate stands in the texts a >= ``least`` times. Each cut in two parts, found l and r times, gives a score of
    a * a / (l * r) in millionths, rounded down; the lowest counts, of equal ones that with the shortest first part.
    Candidates are left out that lie within a longer one found at least ``contained_percent`` percent as often. The rank
    is by score, then a (largest first), then phrase. ``n`` is the number of all words of the language.

    Texts without words, and an empty table, give no rows; NULL texts are empty, a NULL language is ``und``.
    """
    counts = phrase_counts(docs, text, lang, longest, least, shards, slots)
    total = counts.where("n = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = counts.where(F.col("f") >= least)
    found = frequent.where("n > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))

    part = F.expr("transform(sequence(1, size(words) - 1), k -> struct(k, array_join(slice(words, 1, k), ' ') AS first, "
                  "array_join(slice(words, k + 1, size(words)), ' ') AS rest))")  # fmt: skip
    cuts = found.select("lang", "phrase", "a", F.explode(part).alias("cut")).select("lang", "phrase", "a", "cut.*")
    first = frequent.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rest = frequent.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    exact = {c: f"cast({c} as decimal(18, 0))" for c in "alr"}
    score = F.expr(f"({exact['a']} * {exact['a']} * 1000000) div ({exact['l']} * {exact['r']})")
    scored = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).withColumn("score", score.cast("bigint"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))

    inner = F.expr(
        "flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), "
        "i -> array_join(slice(words, i, m), ' '))))"
    )
    longer = found.where("size(words) > 2").select("lang", "a", F.explode(inner).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * contained_percent)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("low.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    ranked = ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "low.l", "low.r", "low.score")
    return attached(ranked, stored(total, "phrase-totals"), "lang", "inner").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
