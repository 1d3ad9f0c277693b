"""Helpers of several operators: stored steps, bytes of text columns, span hashes, connected groups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.session import fresh_folder

MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
BYTE_VALUES = np.random.RandomState(20240607).randint(0, 1 << 62, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of text that numpy works on at a time; a longer document is one piece of its own.
PIECE_BYTES = 1 << 19

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def stored(df: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read again: its lineage ends there."""
    folder = fresh_folder(df.sparkSession, purpose)
    df.write.parquet(folder, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def task_count(df: DataFrame, text: str, bytes_each: int) -> int:
    """Tasks so that each gets about ``bytes_each`` bytes of ``text``; at least the session's shuffle count."""
    total = df.agg(F.sum(F.octet_length(text).cast("bigint"))).first()[0] or 0
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-total // bytes_each))


# Text columns as one buffer of bytes.


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All texts end to end as bytes, and the offsets of the texts in it (one more than texts). NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, size: int = PIECE_BYTES):
    """Ranges of whole texts of up to ``size`` bytes together, or of one longer text."""
    first, count = 0, len(offsets) - 1
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), count)
        yield first, last
        first = last


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((MULTIPLIER, INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums of 64-bit values: ``span_hash`` takes any span's hash from them."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0][: len(values)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span [start, end), the same for equal contents wherever they stand."""
    return mixed((sums[ends] - sums[starts]) * powers(len(sums))[1][starts] + (ends - starts).astype(np.uint64))


def mixed(h: np.ndarray) -> np.ndarray:
    """All bits of the 64 depend on all others."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word bytes; no run crosses from one text to the next."""
    inside = is_word[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


# Arrays of numbers inside rows, in byte planes, so that high zero bytes cost nothing once compressed.


def packed(numbers: np.ndarray, width: int = 8) -> bytes:
    """Numbers below 256**width as ``width`` planes of bytes."""
    raw = np.ascontiguousarray(numbers, dtype="<u8").view(np.uint8).reshape(-1, 8)
    return raw[:, :width].T.tobytes()


def unpacked(blob: bytes, width: int = 8) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(width, -1)
    raw = np.zeros((planes.shape[1], 8), np.uint8)
    raw[:, :width] = planes.T
    return raw.reshape(-1).view("<u8").astype(np.uint64)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, start + length), one range after the other."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.r_[0, np.cumsum(lengths)[:-1]], lengths)
    return np.arange(total, dtype=np.int64) + shift


# Connected groups.


def merged(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """The smallest number of each of ``count`` numbers' group, where a[i] and b[i] are linked."""
    label = np.arange(count)
    while len(a):
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        differ = low != high
        if not differ.any():
            break
        a, b = low[differ], high[differ]
        np.minimum.at(label, b, a)
        while not np.array_equal(jumped := label[label], label):
            label = jumped
    return label


def _local_stars(batches):
    """Of the links of one task, a star for each group."""
    links = pa.Table.from_batches(list(batches), _LINK)
    a, b = links.column(0).to_numpy(), links.column(1).to_numpy()
    names, codes = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = merged(codes[: len(a)], codes[len(a) :], len(names))
    away = root != np.arange(len(names))
    yield pa.record_batch([pa.array(names[away]), pa.array(names[root[away]])], schema=_LINK)


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def components(links: DataFrame, native: bool = False) -> DataFrame:
    """Connected groups of ``links`` (a, b): (id, component_id), the smallest id of its group, for linked ids.

    Alternates, until nothing changes, between hanging the larger neighbours of each id on its smallest one
    and hanging all smaller ones there. A hot id is aggregated partially, and its join side can be split. Links are
    first reduced to stars task by task, which ``native`` leaves out.
    """
    links = links.select(F.greatest("a", "b").cast("bigint").alias("a"), F.least("a", "b").cast("bigint").alias("b")).where("a <> b")
    if not native:
        links = links.mapInArrow(_local_stars, "a bigint, b bigint")
    now = stored(links.distinct(), "links")
    state = None
    while True:
        both = now.union(now.select("b", "a"))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        hung = large.join(lowest, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct("a", F.col("low").alias("b")))).alias("x"))
        now = stored(hung.select("x.*").where("a <> b").distinct(), "links")
        seen = now.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(20, 0)))")).first()
        if seen == state:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component_id")).union(now.select(F.col("b"), F.col("b")).distinct())
        state = seen


def attached(rows: DataFrame, few: DataFrame, key: str, how: str, most_bytes: int = 32 << 20) -> DataFrame:
    """``rows`` joined to the stored table ``few``: by broadcast if its rows are measured below ``most_bytes``, else by
    a shuffle of both."""
    width = few.agg(F.sum(F.lit(64) + sum((F.coalesce(_width(few, c), F.lit(0)) for c in few.columns), F.lit(0)))).first()[0] or 0
    return rows.join(F.broadcast(few) if width <= most_bytes else few, key, how)


def _width(df: DataFrame, name: str):
    kind = df.schema[name].dataType.simpleString()
    return F.size(name) * (8 if kind.startswith("array<int") or kind.startswith("array<bigint") else 64) if kind.startswith("array") else F.octet_length(name) if kind in ("string", "binary") else F.lit(8)


# Documents in chunks: small groups that several passes meet again, each time with what another stage found for them.

#: Chunks per task, so that the hash deals tasks alike.
CHUNKS_PER_TASK = 2


def chunked(docs: DataFrame, tasks: int) -> DataFrame:
    """(chunk, doc_id, key, text) of ``docs`` (doc_id, text). NULL text is empty; a NULL doc_id comes after all others.

    ``key`` tells the rows of a chunk apart; rows that repeat id and text share it.
    """
    doc_id = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_DOC))
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    return rows.select(F.pmod("key", F.lit(tasks * CHUNKS_PER_TASK)).cast("int").alias("chunk"), "doc_id", "key", "text")


#: Stands for a NULL doc_id, after all ids.
NO_DOC = (1 << 63) - 1


def chunk_texts(rows: pa.Table):
    """doc_ids, bytes and offsets of a chunk's documents, in the order of their keys."""
    order = np.argsort(rows.column("key").to_numpy(), kind="stable")
    rows = rows.take(pa.array(order))
    data, offsets = text_bytes(rows.column("text"))
    return rows.column("doc_id").to_numpy(), data, offsets


def by_bucket(buckets: np.ndarray):
    """(bucket, positions) of every bucket that occurs; positions keep their order."""
    order = np.argsort(buckets, kind="stable")
    cuts = np.flatnonzero(np.diff(buckets[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        yield int(buckets[part[0]]), part
