"""WARC archives with revisit records for repeated payloads.

Headers (page, digest, length) are aggregated by payload digest; every page is then joined to the response its payload
belongs to, and the archives are written with fresh headers: a response with its payload, or a revisit that names it.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold.session import fresh_folder

RECORD = "urn:dayfold:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, target_uri string"


def resolved(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """``pages`` (page_id, url, html) with digest, payload size and ``original``: the response's page_id of a revisit.

    Of equal payloads of ``least_bytes`` or more the largest page_id is the response. NULL html is an empty payload;
    a page without id can only be a response. Repeated rows of one page_id and payload are all responses if theirs is
    the largest id. Only digests that occur more than once take part in the join; its page side can be split.
    """
    html = F.coalesce("html", F.lit(""))
    # read twice rather than shuffled: the digests need no payload, and the payloads move once at most
    rows = pages.select("page_id", "url", html.alias("html")).select("*", F.sha1("html").alias("digest"), F.octet_length("html").cast("bigint").alias("payload_bytes"))
    repeated = rows.where(F.col("payload_bytes") >= least_bytes).groupBy(F.col("digest").alias("_digest"))
    repeated = repeated.agg(F.max("page_id").alias("_last"), F.count("*").alias("_n")).where("_n > 1")
    matched = rows.join(repeated, (F.col("digest") == F.col("_digest")) & (F.col("payload_bytes") >= least_bytes), "left")
    original = F.when(F.col("page_id") < F.col("_last"), F.col("_last"))
    return matched.select("page_id", "url", "html", "digest", "payload_bytes", original.alias("original"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def records(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """One column ``record``: the text of each record without its closing blank lines.

    Control characters of an URL are percent-encoded, so that no value can end a header.
    """
    url = F.coalesce("url", F.lit(""))
    for code in (37, 13, 10):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    revisit = F.col("original").isNotNull()
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    block = F.when(revisit, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), F.col("html")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.concat(F.lit(f"<{RECORD}"), page, F.lit(">"))),
        _line("WARC-Target-URI", url),
        _line("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssX")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(
            revisit,
            F.concat(
                _line("WARC-Refers-To", F.concat(F.lit(f"<{RECORD}"), F.col("original").cast("string"), F.lit(">"))),
                F.lit(f"WARC-Profile: {PROFILE}\r\n"),
            ),
        ).otherwise(""),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return resolved(pages, least_bytes).select(F.concat(head, block).alias("record"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 1000, records_per_file: int = 1000) -> None:
    """Compressed archive files below ``folder``. The two line ends that close a record are the writer's line separator."""
    writer = records(pages, least_bytes).write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
    writer.option("maxRecordsPerFile", records_per_file).text(folder)


def parse(data: bytes):
    """(headers, block) of each record of an archive, found by Content-Length alone."""
    at, view = 0, memoryview(data)
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = int(headers["Content-Length"])
        yield headers, view[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def _number(name: str | None) -> int | None:
    digits = (name or "").removeprefix(f"<{RECORD}").removesuffix(">")
    return int(digits) if digits not in ("", "none") else None


def _read(batches):
    import gzip
    import hashlib

    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string())])
    for batch in batches:
        for content in batch.column(0):
            rows = []
            for headers, block in parse(gzip.decompress(content.as_buffer())):
                kind = headers["WARC-Type"]
                digest, size = headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers["X-Payload-Length"])
                if kind == "response":
                    payload = block[len(HTTP) :]
                    found = hashlib.sha1(payload).hexdigest()
                    if (found, len(payload)) != (digest, size):
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its header")
                rows.append((_number(headers["WARC-Record-ID"]), size, digest, kind, _number(headers.get("WARC-Refers-To")), headers["WARC-Target-URI"]))
            yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)] if rows else [pa.array([], t) for t in schema.types], schema=schema)


def read_archives(spark, folder: str) -> DataFrame:
    """One row per record, payloads of responses checked against their digests. A task holds one split of files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(_read, READ)


def deduplicated_archives(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Write ``pages`` as archives to the shared folder and read them back. No pages: no rows."""
    folder = fresh_folder(pages.sparkSession, "warc")
    write_archives(pages, folder, least_bytes)
    return read_archives(pages.sparkSession, folder)
