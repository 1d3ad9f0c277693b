"""One row per word of a text column: by pattern, by dictionary, and as a SQL table function."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from dayfold.functions.columns import own_column
from dayfold.functions.words import WORD_PATTERN, words_of
from dayfold.session import fresh_folder

# Texts are cut into blocks of this many characters before single places in them are looked at.
BLOCK = 64
# A place in a text is first looked up by at most this many characters; the first that fits is used.
HEADS = (3, 2, 1)
# A place carries at most this many characters of a word. Of longer words this is the first link, and
# only where that is found is the rest of the word taken from the text.
LINK = 64
# Memory a broadcast word takes on top of its own bytes, counted generously.
ROW_OVERHEAD = 64
# Bytes of text whose places are looked at together by hash.
SLICE = 1 << 19
# Types of columns that pass through Arrow unchanged; rows with others stay in Spark.
PLAIN = {"string", "binary", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date"}


def split_words(
    df: DataFrame,
    text: str,
    keep: Sequence[str],
    keyword: str = "keyword",
    pattern: str = WORD_PATTERN,
    keep_empty: bool = False,
) -> DataFrame:
    """The ``keep`` columns and one word per row.

    A row without words vanishes, or with ``keep_empty`` stays once with a NULL word.
    """
    explode = F.explode_outer if keep_empty else F.explode
    words = words_of(own_column(df, text), pattern)
    return df.select(*(own_column(df, k) for k in keep), explode(words).alias(keyword))


def split_words_dict(
    df: DataFrame,
    text: str,
    dictionary: DataFrame,
    keep: Sequence[str],
    word: str = "word",
    broadcast_limit: int = 64 << 20,
    salts: int = 32,
) -> DataFrame:
    """The ``keep`` columns, ``position`` (from 1) and ``word`` for every dictionary word in a text.

    Works on text written without spaces: every place is tried, overlapping words are all given,
    case counts. A dictionary within ``broadcast_limit`` whose words have up to ``LINK`` characters
    is looked up by hash, slice by slice of the text, and what is found so is then compared with the
    words. Otherwise each place is first looked up by the head of a word, which says what lengths can
    follow there, and then by the whole word. A word of more than ``LINK`` characters is looked up
    by these first, and by the whole only where they were found.

    The words are written to the shared folder once and measured there, so that a dictionary that
    takes long to derive, or that changes meanwhile, does no harm. Heads and words are broadcast
    only within ``broadcast_limit`` bytes. Without the heads every length is tried. Beyond the limit
    the words are joined by a shuffle, each word in ``salts`` copies, so that a word which is most
    of the text spreads over as many partitions.
    """
    if clash := [k for k in keep if k in ("position", "word")]:
        raise ValueError(f"the result has columns position and word of its own, so rename {clash}")
    found = _Words(dictionary.select(own_column(dictionary, word).alias("word")), broadcast_limit, salts)
    names = [f"_keep{i}" for i in range(len(keep))]
    texts = df.select(
        *(own_column(df, k).alias(n) for k, n in zip(keep, names, strict=True)),
        own_column(df, text).alias("_text"),
    )
    if found.fit and found.longest <= LINK and {f.dataType.simpleString() for f in texts.schema} <= PLAIN:
        hits = found.hashed_within(texts, names)
    else:
        hits = found.within(_spans(texts, names, found), names)
    return hits.toDF(*keep, "position", "word")


class _Words:
    """A dictionary written once, and the lookup of its words at every place of a span of text."""

    def __init__(self, words: DataFrame, broadcast_limit: int, salts: int):
        spark = words.sparkSession
        folder = fresh_folder(spark, "dictionary")
        words.where(F.length("word") > 0).distinct().write.parquet(folder)
        self.words, self.limit, self.salts = spark.read.schema("word string").parquet(folder), broadcast_limit, salts
        facts = self.words.agg(
            F.count("*").alias("words"),
            F.sum(F.octet_length("word")).alias("bytes"),
            F.collect_set(F.length("word")).alias("lengths"),
        ).first()
        self.lengths = sorted(facts.lengths) or [1]
        self.longest = self.lengths[-1]
        self.reach = min(self.longest, LINK)
        self.fit = (facts.bytes or 0) + facts.words * ROW_OVERHEAD <= broadcast_limit
        most_heads = broadcast_limit // (ROW_OVERHEAD + 8 * len(self.lengths))
        self.head = HEADS[0] if facts.words <= most_heads else _head_length(self.words, most_heads)

    def within(self, spans: DataFrame, ids: list[str]) -> DataFrame:
        """``ids``, ``position`` and ``word`` of the words that begin in the first ``_own`` characters of a span.

        ``spans``: ids, ``_start`` (characters before the span), ``_own`` and ``_text``, which reaches over the places
        of its own as far as the longest word does.
        """
        long_words = self.longest > LINK
        more = ["_text", "_in"] if long_words else []
        places = _places(spans, ids, self.reach).select(*ids, "position", "_rest", *more)
        here = [*ids, "position", *more]
        lengths = sorted({min(n, self.reach) for n in self.lengths})
        if self.head:
            heads = self.words.groupBy(F.substring("word", 1, self.head).alias("_head")).agg(
                F.collect_set(F.least(F.length("word"), F.lit(self.reach))).alias("_lengths")
            )
            starts = _pieces(places, [*here, "_rest"], _fixed({min(n, self.head) for n in lengths}))
            pieces = _pieces(_broadcast_lookup(starts, heads, "_head"), here, F.col("_lengths"))
        else:
            pieces = _pieces(places, here, _fixed(lengths))
        if long_words:
            links = self.words.groupBy(F.substring("word", 1, LINK).alias("_link")).agg(
                F.collect_set(F.length("word")).alias("_lengths")
            )
            linked = self._matched(pieces, links, "_link").select(*here, F.explode("_lengths").alias("_n"))
            whole = F.substring("_text", F.col("_in"), F.col("_n"))
            pieces = linked.where(F.col("_in") + F.col("_n") - 1 <= F.length("_text")).select(*here, whole.alias("_piece"))
        return self._matched(pieces, self.words, "word").select(*ids, "position", "word")

    def hashed_within(self, texts: DataFrame, ids: list[str]) -> DataFrame:
        """``ids``, ``position`` and ``word`` of the words in ``_text``: pieces of a word's hash, then compared with it."""
        # at most ``limit`` bytes, as for the broadcast of the words
        sent = texts.sparkSession.sparkContext.broadcast(_Hashes(self.words.toArrow().column("word")))
        fields = [*(f for f in texts.schema if f.name in ids), StructField("position", LongType()), StructField("_piece", StringType())]
        pieces = texts.select(*ids, "_text").mapInArrow(lambda batches: _hash_hits(batches, sent.value), StructType(fields))
        return _broadcast_lookup(pieces, self.words, "word").select(*ids, "position", "word")

    def _matched(self, pieces: DataFrame, table: DataFrame, name: str) -> DataFrame:
        if self.fit:
            return _broadcast_lookup(pieces, table, name)
        place = [c for c in pieces.columns if c not in ("_piece", "_text", "_lengths", "_link")]
        salt = F.pmod(F.xxhash64(*place), F.lit(self.salts)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1)))
        salted = pieces.withColumn("_salt", salt).withColumnRenamed("_piece", name)
        return salted.join(table.withColumn("_salt", copies), [name, "_salt"])


class _Hashes:
    """The hashes of a dictionary's words by their length in bytes, and bits that tell which lengths can follow a head."""

    def __init__(self, words: pa.ChunkedArray):
        data, offsets = _bytes(words)
        data = np.concatenate([data, np.zeros(8, np.uint8)])
        size = np.diff(offsets)
        self.lengths = [int(n) for n in np.unique(size)]
        self.of = []
        # heads of one to four bytes; of those of more lengths than bits some share one
        self.heads = [np.zeros(1 << 16, np.uint64) for _ in range(4)]
        for i, n in enumerate(self.lengths):
            at = offsets[:-1][size == n]
            self.of.append(np.unique(_hash(_words8(data), at, n)))
            k = min(n, 4)
            np.bitwise_or.at(self.heads[k - 1], _head(_words8(data)[at], k), np.uint64(1 << i % 64))


def _bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts end to end in UTF-8, and where each begins and the last one ends. NULL is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _words8(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number; ``data`` has eight bytes more than places."""
    return np.ndarray((len(data) - 8,), "<u8", data, strides=(1,))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _head(eight: np.ndarray, n: int) -> np.ndarray:
    return (_mixed(eight & np.uint64((1 << 8 * n) - 1)) & np.uint64(0xFFFF)).astype(np.int64)


def _hash(eight: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n`` bytes from each place ``at`` on."""
    h = np.zeros(len(at), np.uint64)
    for i in range(0, n, 8):
        h = _mixed(h + (eight[at + i] & np.uint64((1 << 8 * min(8, n - i)) - 1)))
    return h


def _hash_hits(batches: Iterator[pa.RecordBatch], words: _Hashes) -> Iterator[pa.RecordBatch]:
    """ids, ``position`` and ``_piece`` of the pieces of ``_text`` (last column) that have the hash of a word."""
    reach = max(words.lengths, default=0)
    for batch in batches:
        ids, names = batch.columns[:-1], [*batch.schema.names[:-1], "position", "_piece"]
        data, offsets = _bytes(batch.columns[-1])
        # characters of the batch before the slice, and before each text
        before, first = 0, np.zeros(len(offsets), np.int64)
        for low in range(0, len(data), SLICE):
            high = min(low + SLICE, len(data))
            some = np.concatenate([data[low : high + reach], np.zeros(reach + 8, np.uint8)])
            eight = _words8(some)
            chars = before + np.r_[0, np.cumsum((some[: high - low] & 0xC0) != 0x80)]
            begin = slice(*np.searchsorted(offsets, [low, high]))
            first[begin] = chars[offsets[begin] - low]
            before = chars[-1]
            lengths = np.zeros(high - low, np.uint64)
            for k, bits in enumerate(words.heads, 1):
                if bits.any():
                    lengths |= bits[_head(eight[: high - low], k)]
            places = np.flatnonzero(lengths)
            lengths = lengths[places]
            text = np.searchsorted(offsets, places + low, "right") - 1
            room = offsets[text + 1] - low - places
            for i, n in enumerate(words.lengths):
                here = np.flatnonzero((lengths & np.uint64(1 << i % 64) != 0) & (room >= n))
                h = _hash(eight, places[here], n)
                of = words.of[i]
                here = here[of[np.minimum(np.searchsorted(of, h), len(of) - 1)] == h]
                if len(here) == 0:
                    continue
                at, rows = places[here], text[here]
                pieces = some[at[:, None] + np.arange(n)]
                ends = np.arange(0, (len(at) + 1) * n, n, dtype=np.int32)
                found = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(pieces.reshape(-1))])
                position = pa.array(chars[at] - first[rows] + 1)
                rows = pa.array(rows)
                yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in ids), position, found], names=names)


def _head_length(words: DataFrame, most_heads: int) -> int | None:
    """The longest head of which a dictionary too large to broadcast has few enough, if any."""
    for n in HEADS:
        if words.select(F.substring("word", 1, n)).distinct().count() <= most_heads:
            return n
    return None


def _blocks(size: int, reach: int) -> Column:
    """A pattern that cuts a text every ``size`` characters; its first group reaches into the next block."""
    return F.lit(f"(?s)(?=(.{{1,{size + reach - 1}}})).{{1,{size}}}")


def _spans(texts: DataFrame, ids: list[str], words: _Words) -> DataFrame:
    """Whole texts; cut into blocks that reach over into the next, if the longest word is looked for beyond a link."""
    if words.longest <= LINK:
        return texts.select(*ids, F.lit(0).cast("bigint").alias("_start"), F.length("_text").alias("_own"), "_text")
    size = words.longest
    blocks = F.regexp_extract_all("_text", _blocks(size, size), F.lit(1))
    return texts.select(*ids, F.posexplode(blocks).alias("_no", "_text")).select(
        *ids,
        (F.col("_no").cast("bigint") * size).alias("_start"),
        F.least(F.lit(size), F.length("_text")).alias("_own"),
        "_text",
    )


def _places(spans: DataFrame, ids: list[str], reach: int) -> DataFrame:
    """One row per place of its own of a span, with ``_rest``, the text from there on over ``reach`` characters.

    Spans are cut into blocks first, each reaching over into the next, because taking a piece out of a long text costs
    more the further down it lies.
    """
    blocks = F.regexp_extract_all("_text", _blocks(BLOCK, reach), F.lit(1))
    cut = spans.select(*ids, "_start", "_own", "_text", F.posexplode(blocks).alias("_no", "_block"))
    steps = F.sequence(F.lit(1), F.least(F.lit(BLOCK), F.col("_own") - F.col("_no") * BLOCK))
    cut = cut.where(F.col("_no") * BLOCK < F.col("_own")).select("*", F.explode(steps).alias("_at"))
    inside = F.col("_no") * BLOCK + F.col("_at")
    return cut.select(
        *ids,
        (F.col("_start") + inside).alias("position"),
        F.substring("_block", F.col("_at"), F.lit(reach)).alias("_rest"),
        "_text",
        inside.alias("_in"),
    )


def _fixed(numbers: Iterable[int]) -> Column:
    return F.array(*(F.lit(n) for n in sorted(numbers)))


def _pieces(places: DataFrame, here: list[str], lengths: Column) -> DataFrame:
    """``_piece``, of each of the lengths, from the start of ``_rest``, where there is as much."""
    return (
        places.withColumn("_n", F.explode(lengths))
        .where(F.col("_n") <= F.length("_rest"))
        .select(*here, F.left("_rest", F.col("_n")).alias("_piece"))
    )


def _broadcast_lookup(pieces: DataFrame, table: DataFrame, name: str) -> DataFrame:
    """Inner join of ``_piece`` with the text column ``name`` of a table that fits in memory.

    A lookup by a hash in a long costs a fraction of one by text, and every piece of every text is
    looked up. The texts are compared after it, as a range from ``name`` to ``name``: a plain
    equality would become the key of the join.
    """
    hashed = table.withColumn("_hash", F.xxhash64(name))
    return (
        pieces.withColumn("_hash", F.xxhash64("_piece"))
        .join(F.broadcast(hashed), "_hash")
        .where(F.col("_piece").between(F.col(name), F.col(name)))
        .drop("_hash", "_piece")
    )


def register_split_words(
    spark: SparkSession, name: str = "split_words", pattern: str = WORD_PATTERN
) -> None:
    """Make ``name(text)`` a SQL table function that gives one ``keyword`` per row.

    Call it as ``FROM t, LATERAL name(t.text)``; to keep rows without words, as
    ``FROM t LEFT JOIN LATERAL name(t.text) ON true``, where the ``ON true`` is needed. Spark
    expands the body in place, so no row passes through Python.
    """
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION `{name}`(t STRING) "
        f"RETURNS TABLE (keyword STRING) "
        f"RETURN SELECT explode(regexp_extract_all(lower(t), '{quoted}', 0))"
    )


def register_split_words_dict(
    spark: SparkSession, dictionary: str, name: str = "split_words_dict", word: str = "word", longest: int | None = None
) -> None:
    """Make ``name(text)`` a SQL table function that gives ``position`` and ``word`` of every word of
    the table ``dictionary`` in a text without spaces, as ``split_words_dict`` does.

    Call it as ``FROM t, LATERAL name(t.text)``. The function reads the table at every call, so words
    added later are found, unless they are longer than ``longest`` characters, which is as long as
    the longest one now if not given: register it again then. Spark expands the body in place and
    joins it as a plan of its own, over the distinct texts, so no row passes through Python and the
    table is not collected. For words of several hundred characters call ``split_words_dict``.
    """
    column = f"`{word}`"
    if longest is None:
        longest = spark.table(dictionary).agg(F.max(F.length(word))).first()[0] or 1
    table = ".".join(f"`{part}`" for part in dictionary.split("."))
    words = f"SELECT DISTINCT {column} AS word FROM {table} WHERE length({column}) > 0"
    heads = ", ".join(str(n) for n in sorted(HEADS))
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION `{name}`(t STRING)
        RETURNS TABLE (position BIGINT, word STRING)
        RETURN SELECT p.no * {BLOCK} + p.at, d.word FROM (
          SELECT s.no, s.at, s.block, n FROM (
            SELECT no, at, block, head FROM (
              SELECT posexplode(regexp_extract_all(t, '(?s)(?=(.{{1,{BLOCK + longest - 1}}})).{{1,{BLOCK}}}', 1)) AS (no, block))
            LATERAL VIEW explode(sequence(1, least({BLOCK}, length(block)))) AS at
            LATERAL VIEW explode(array({heads})) AS head
            WHERE at + head - 1 <= length(block)) AS s
          JOIN (SELECT left(word, {max(HEADS)}) AS head, collect_set(length(word)) AS lengths FROM ({words})
                GROUP BY left(word, {max(HEADS)})) AS h
            ON h.head = substr(s.block, s.at, s.head)
          LATERAL VIEW explode(h.lengths) AS n
          WHERE s.at + n - 1 <= length(s.block)) AS p
        JOIN ({words}) AS d ON d.word = substr(p.block, p.at, p.n)"""
    )


def drop_split_words(
    spark: SparkSession, name: str = "split_words", missing_ok: bool = True
) -> None:
    """Drop the function; a missing one is an error only with ``missing_ok=False``."""
    spark.sql(f"DROP TEMPORARY FUNCTION {'IF EXISTS ' if missing_ok else ''}`{name}`")
