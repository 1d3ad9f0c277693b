"""Tokens per document in flat, unindexed token files.

A token file is nothing but 16-bit token ids, each document closed by an end-of-document id. Files are cut into blocks
of bytes; every block's separators are found by one vectorised comparison, and a prefix scan over the blocks of a file
stitches the documents that cross block boundaries.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayfold.llm.common import PIECE_BYTES, stored
from dayfold.session import fresh_folder

#: The pattern that splits text before the merges of the rank file; a fixed value of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256
BLOCK_TOKENS = 1 << 19

_encoders: dict[str, object] = {}


def encoder(ranks_path: str):
    """The byte-level encoder of a rank file, once per Python worker."""
    if ranks_path not in _encoders:
        import tiktoken

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        _encoders[ranks_path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[ranks_path]


def text_pieces(text: str, size: int = PIECE_BYTES):
    """``text`` in parts of about ``size`` characters, cut where a letter or digit comes before a blank and a letter
    follows it: no token crosses such a place. A text without such a place is one part."""
    at = 0
    while len(text) - at > size:
        cut = at + size
        while cut < len(text) - 1 and not (text[cut] == " " and text[cut - 1].isalnum() and text[cut + 1].isalpha()):
            cut += 1
        if cut >= len(text) - 1:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def write_token_files(docs: DataFrame, ranks_path: str, folder: str) -> None:
    """Flat token files of all whole texts, one per task, documents in the order of the rows; NULL text has no tokens.

    The end-of-document id is the writer's line separator, so a file has no other bytes than token ids.
    """

    def encode(batches):
        own = encoder(ranks_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                texts = batch.column(0).slice(at, 256).to_pylist()
                ids = [np.concatenate([np.array(own.encode_ordinary(p), np.uint16) for p in text_pieces(t or "")]) for t in texts]
                yield pa.record_batch([pa.array([x.tobytes() for x in ids], pa.binary())], ["tokens"])

    rows = docs.select("text").mapInArrow(encode, "tokens binary").select(F.col("tokens").cast("string"))
    end = np.array([END], "<u2").tobytes().decode("latin-1")
    rows.write.option("lineSep", end).option("encoding", "ISO-8859-1").text(folder)


def _range(path: str, start: int, length: int) -> bytes:
    from pyarrow import fs

    uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path
    system, name = fs.FileSystem.from_uri(uri)
    with system.open_input_file(name) as file:
        return file.read_at(length, start)


_SCAN = pa.schema([("file", pa.string()), ("start", pa.int64()), ("tokens", pa.int64()), ("ends", pa.list_(pa.int64()))])


def _scan_blocks(batches):
    for batch in batches:
        for path, start, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ids = np.frombuffer(_range(path, 2 * start, 2 * count), "<u2")
            ends = np.flatnonzero(ids == END) + start
            yield pa.record_batch([[path], [start], [len(ids)], pa.array([ends], _SCAN.field("ends").type)], schema=_SCAN)


def documents_of(spark: SparkSession, folder: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, ordinal, token_start, n_tokens) of every document in the token files below ``folder``.

    Blocks of ``block_tokens`` are scanned in parallel, whatever the sizes of the files. Tokens after a file's last
    separator are a document too. An empty folder or file gives no rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(folder)
    files = files.select(F.col("path").alias("file"), (F.col("length") / 2).cast("bigint").alias("total")).where("total > 0")
    starts = files.select("file", "total", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("total") - 1, F.lit(block_tokens).cast("bigint"))).alias("start"))
    blocks = starts.select("file", "start", F.least(F.lit(block_tokens), F.col("total") - F.col("start")).cast("bigint").alias("n"))
    found = blocks.repartition("file", "start").mapInArrow(_scan_blocks, "file string, start bigint, tokens bigint, ends array<bigint>")
    found = stored(found, "token-blocks")
    # the prefix scan has one small row per block
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    carried = found.select("file", "start", "tokens", F.size("ends").cast("bigint").alias("n"), last.alias("last"))
    carried = carried.select(
        F.col("file").alias("_file"),
        F.col("start").alias("_start"),
        F.coalesce(F.max("last").over(before), F.lit(-1)).alias("open"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("seen"),
    )
    rows = found.join(carried, (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start")))
    rows = rows.select("file", "ends", "open", "seen", F.posexplode("ends").alias("at", "end"))
    first = F.when(F.col("at") == 0, F.col("open")).otherwise(F.get("ends", F.col("at") - 1)) + 1
    closed = rows.select("file", (F.col("seen") + F.col("at")).alias("ordinal"), first.alias("token_start"), (F.col("end") - first).alias("n_tokens"))
    tail = found.groupBy("file").agg(F.max(F.col("start") + F.col("tokens")).alias("all"), F.max(last).alias("last"), F.sum(F.size("ends")).cast("bigint").alias("ordinal"))
    start = F.coalesce("last", F.lit(-1)) + 1
    tail = tail.where(F.col("all") > start).select("file", "ordinal", start.alias("token_start"), (F.col("all") - start).alias("n_tokens"))
    return closed.union(tail)


def token_counts(docs: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, n_tokens) of every document, counted in token files written from ``docs``.

    The files carry no ids, so a document is known by its file and its place there: a task writes its rows in order, and
    the same rows are numbered in a second pass over ``docs``, which must be a stored table (or rows of one, without a
    shuffle). Repeated rows are counted each.
    """
    spark = docs.sparkSession
    folder = fresh_folder(spark, "tokens")
    write_token_files(docs, ranks_path, folder)
    row = F.monotonically_increasing_id()
    names = docs.select("doc_id", F.shiftright(row, 33).alias("part"), row.bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    counts = documents_of(spark, folder).withColumn("part", F.regexp_extract("file", r"part-(\d+)-[^/]*$", 1).cast("bigint"))
    both = names.join(counts, (names["part"] == counts["part"]) & (names["place"] == counts["ordinal"]), "full")
    wrong = F.raise_error(F.lit("the token files do not hold the documents in the order of the table")).cast("bigint")
    odd = counts["ordinal"].isNull() | names["place"].isNull()
    return both.select("doc_id", F.when(odd, wrong).otherwise(F.col("n_tokens")).alias("n_tokens"))
