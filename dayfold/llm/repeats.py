"""Removal of repeated byte strings by a logarithmic family of suffix arrays.

What counts is a string of ``SPAN`` bytes that also starts in a document with a smaller id. Every suffix has an anchor in
its first SPAN bytes, the 16-byte string of smallest hash there, so equal suffixes have equal anchors. A first pass finds
the anchors that occur in several chunks of documents; only suffixes under such anchors go on, run by run (neighbouring
suffixes mostly share an anchor), to the bucket of their anchor. There, documents come in batches in the order of their
ids. A batch gets its suffix array (suffixes in the order of the hash of their first SPAN bytes), which is merge-scanned
against the arrays of the levels before; then it becomes a level, and levels of about equal size merge.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.common import BYTE_VALUES, NO_DOC, by_bucket, chunk_texts, chunked, mixed, packed, pieces, powers, prefix_hash, ranges, span_hash, task_count, unpacked

SPAN = 50
ANCHOR = 16
#: Suffixes of a batch in a bucket; a document with more is one batch.
BATCH = 1 << 16
#: Bytes of text whose suffixes are hashed at a time.
SLICE = 1 << 18
CHUNK_BYTES = 6 << 20

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_KEY = np.uint64((1 << 48) - 1)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each window of ``width``."""
    done, size = values, 1
    while 2 * size <= width:
        done = np.minimum(done[:-size], done[size:])
        size *= 2
    rest = width - size
    return np.minimum(done[:-rest], done[rest:]) if rest else done


def runs_of(data: np.ndarray, offsets: np.ndarray):
    """Runs of neighbouring suffixes with one anchor: (start, count, anchor hash, content hash, document).

    A suffix counts if SPAN bytes of its document follow. The content of a run is its suffixes' first SPAN bytes.
    """
    empty = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)]
    found = [empty]
    for first, last in pieces(offsets):
        for base, stop in _slices(int(offsets[first]), int(offsets[last]), first + 1 == last):
            own = np.clip(offsets[first : last + 1], base, stop) - base
            part = data[base:stop]
            n = len(part)
            if n < SPAN:
                continue
            sums = prefix_hash(BYTE_VALUES[part])
            at = np.arange(n - ANCHOR + 1)
            grams = mixed((sums[ANCHOR:] - sums[: n - ANCHOR + 1]) * powers(n + 1)[1][: n - ANCHOR + 1])
            grams = np.minimum(grams, _NONE - np.uint64(1))
            anchor = _least(grams, SPAN - ANCHOR + 1)
            at = np.arange(len(anchor))
            end = np.repeat(own[1:], np.diff(own))[: len(anchor)]
            usable = at + SPAN <= end
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | ~usable[:-1]
            edge = own[1:-1]
            new[edge[edge < len(anchor)]] = True
            starts = np.flatnonzero(new & usable)
            stops = np.append(np.flatnonzero(new | ~usable), len(anchor))
            count = stops[np.searchsorted(stops, starts, "right")] - starts
            content = span_hash(sums, starts, starts + count + SPAN - 1)
            doc = np.searchsorted(own, starts, "right") - 1 + first
            found.append([starts + base, count, anchor[starts], content, doc])
    return [np.concatenate(x) for x in zip(*found, strict=True)]


def _slices(start: int, end: int, one: bool):
    """A long document in slices that overlap by all but one byte of a suffix; others as they are."""
    step = SLICE * 4
    if not one or end - start <= step:
        yield start, end
        return
    for at in range(start, end - SPAN + 1, step):
        yield at, min(end, at + step + SPAN - 1)


def _representatives(doc_ids: np.ndarray, content: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each run: does no document of the chunk with a smaller id hold the same content?"""
    order = np.lexsort((doc_ids[doc], content))
    new = np.ones(len(order), bool)
    new[1:] = content[order[1:]] != content[order[:-1]]
    least = doc_ids[doc[order]][np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else np.zeros(0, np.int64)
    kept = np.zeros(len(order), bool)
    kept[order] = doc_ids[doc[order]] == least
    return kept


def _bucket_of(anchor: np.ndarray, buckets: int) -> np.ndarray:
    return ((anchor >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _table(columns: dict[str, list], schema: pa.Schema) -> pa.Table:
    return pa.table({f.name: pa.array(columns[f.name], f.type) for f in schema}, schema=schema)


_ANCHORS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("anchors", pa.binary())])
_ANCHORS_SQL = "bucket int, chunk int, anchors binary"
_RUNS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("docs", pa.binary()), ("places", pa.binary()), ("starts", pa.binary()), ("counts", pa.binary()), ("bytes", pa.binary())])
_RUNS_SQL = "bucket int, chunk int, docs binary, places binary, starts binary, counts binary, bytes binary"
_COVER = pa.schema([("chunk", pa.int32()), ("places", pa.binary()), ("starts", pa.binary()), ("lengths", pa.binary())])
_COVER_SQL = "chunk int, places binary, starts binary, lengths binary"
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("kept_sha256", pa.string())])
_KEPT_SQL = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string"


def _sorted_packed(keys: np.ndarray) -> bytes:
    return packed(np.diff(keys, prepend=np.uint64(0)), 6)


def _sorted_unpacked(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob, 6), dtype=np.uint64)


def _anchors(buckets: int):
    """Pass 1: the distinct anchors of a chunk, by bucket."""

    def run(key, rows):
        doc_ids, data, offsets = chunk_texts(rows)
        anchor = _distinct(runs_of(data, offsets)[2])
        out = {f.name: [] for f in _ANCHORS}
        for bucket, at in by_bucket(_bucket_of(anchor, buckets)):
            out["bucket"].append(bucket)
            out["chunk"].append(key[0].as_py())
            out["anchors"].append(_sorted_packed(_distinct(anchor[at] & _KEY)))
        return _table(out, _ANCHORS)

    return run


def _shared(key, rows):
    """Of a bucket's anchors, for each chunk those that others have too."""
    chunks, blobs = rows.column("chunk").to_pylist(), [_sorted_unpacked(b) for b in rows.column("anchors").to_pylist()]
    every, count = np.unique(np.concatenate(blobs), return_counts=True)
    several = every[count > 1]
    out = {f.name: [] for f in _ANCHORS}
    for chunk, own in zip(chunks, blobs, strict=True):
        common = own[np.isin(own, several, assume_unique=True)]
        if len(common):
            out["bucket"].append(key[0].as_py())
            out["chunk"].append(chunk)
            out["anchors"].append(_sorted_packed(common))
    return _table(out, _ANCHORS)


def _runs(buckets: int):
    """Pass 2: a chunk's runs that have to be compared, with their bytes; what the chunk itself covers goes along."""

    def run(key, rows, shared):
        chunk = key[0].as_py()
        out = {f.name: [] for f in _RUNS}
        if rows.num_rows:
            doc_ids, data, offsets = chunk_texts(rows)
            start, count, anchor, content, doc = runs_of(data, offsets)
            kept = _representatives(doc_ids, content, doc)
            common = [_sorted_unpacked(b) for b in shared.column("anchors").to_pylist()]
            common = np.concatenate([np.zeros(0, np.uint64), *common])
            # anchors of several documents of the chunk itself
            order = np.lexsort((doc, anchor))
            both = order[1:][(anchor[order[1:]] == anchor[order[:-1]]) & (doc[order[1:]] != doc[order[:-1]])]
            common = _distinct(np.concatenate([common, anchor[both] & _KEY]))
            compare = kept & np.isin(anchor & _KEY, common)
            for bucket, at in by_bucket(np.where(compare, _bucket_of(anchor, buckets), -1)):
                if bucket < 0:
                    at = at[~kept[at]]
                    if not len(at):
                        continue
                length = count[at] + SPAN - 1
                out["bucket"].append(bucket if bucket >= 0 else chunk % buckets)
                out["chunk"].append(chunk)
                out["docs"].append(packed(doc_ids[doc[at]].view(np.uint64)) if bucket >= 0 else b"")
                out["places"].append(packed(doc[at], 4))
                out["starts"].append(packed(start[at] - offsets[doc[at]]))
                out["counts"].append(packed(count[at]))
                out["bytes"].append(data[ranges(start[at], length)].tobytes() if bucket >= 0 else b"")
        return _table(out, _RUNS)

    return run


def _first_of_equals(values: np.ndarray) -> np.ndarray:
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return new


def _distinct(values: np.ndarray) -> np.ndarray:
    """Ascending and once each; by sorting, which for 64-bit numbers is several times faster than ``np.unique``."""
    values = np.sort(values)
    return values[_first_of_equals(values)]


def repeated(doc: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Whether each suffix (given by the hash of its first SPAN bytes) also occurs in a document before its own.

    ``doc`` ascends. This is the logarithmic family: batches in the order of documents, levels of sorted suffixes.
    """
    found = np.zeros(len(doc), bool)
    levels: list[np.ndarray] = []
    first = 0
    while first < len(doc):
        last = min(len(doc), first + BATCH)
        last = int(np.searchsorted(doc, doc[last - 1], "right"))  # documents stay whole
        own, place = suffix[first:last], doc[first:last]
        order = np.argsort(own)
        array, place = own[order], place[order]
        new = _first_of_equals(array)
        heads = np.flatnonzero(new)
        entry = np.cumsum(new) - 1
        hit = place > np.minimum.reduceat(place, heads)[entry]
        array = array[new]
        known = np.zeros(len(array), bool)
        for level in levels:
            at = np.minimum(np.searchsorted(level, array), len(level) - 1)
            known |= level[at] == array
        found[first + order[hit | known[entry]]] = True
        array = array[~known]  # so no two levels hold the same suffix
        while levels and len(levels[-1]) <= 2 * len(array):
            array = np.sort(np.concatenate([levels.pop(), array]))
        if len(array):
            levels.append(array)
        first = last
    return found


def _covered(_, rows):
    """A bucket's runs, compared: the byte ranges that repeats cover, by chunk."""
    out = {f.name: [] for f in _COVER}
    sides = rows.select(["chunk", "docs", "places", "starts", "counts", "bytes"]).to_pylist()
    for side in sides:
        if not side["docs"]:  # found in the chunk itself
            out["chunk"].append(side["chunk"])
            out["places"].append(side["places"])
            out["starts"].append(side["starts"])
            out["lengths"].append(packed(unpacked(side["counts"]) + np.uint64(SPAN - 1)))
    sides = [s for s in sides if s["docs"]]
    suffixes, owners, runs = [], [], []
    for at, side in enumerate(sides):
        count = unpacked(side["counts"]).astype(np.int64)
        data = np.frombuffer(side["bytes"], np.uint8)
        lengths = count + SPAN - 1
        ends = np.cumsum(lengths)
        doc = unpacked(side["docs"]).view(np.int64)
        first = 0
        while first < len(count):  # a portion of the bytes at a time
            base = ends[first] - lengths[first]
            last = max(first + 1, int(np.searchsorted(ends, base + SLICE, "right")))
            part = data[base : ends[last - 1]]
            sums = prefix_hash(BYTE_VALUES[part])
            where = ranges(ends[first:last] - lengths[first:last] - base, count[first:last])
            suffixes.append(span_hash(sums, where, where + SPAN))
            owners.append(np.repeat(doc[first:last], count[first:last]))
            first = last
        runs.append((at, count))
    if sides:
        suffix, owner = np.concatenate(suffixes), np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        hit = np.zeros(len(owner), bool)
        hit[order] = repeated(owner[order], suffix[order])
        base = 0
        for at, count in runs:
            own = hit[base : base + int(count.sum())]
            base += len(own)
            run = np.repeat(np.arange(len(count)), count)
            begin = own.copy()
            begin[1:] &= ~(own[:-1] & (run[1:] == run[:-1]))
            finish = own.copy()
            finish[:-1] &= ~(own[1:] & (run[1:] == run[:-1]))
            begin, finish = np.flatnonzero(begin), np.flatnonzero(finish)
            if len(begin):
                starts = unpacked(sides[at]["starts"]).astype(np.int64)
                of = run[begin]
                out["chunk"].append(sides[at]["chunk"])
                out["places"].append(packed(unpacked(sides[at]["places"], 4)[of], 4))
                out["starts"].append(packed(starts[of] + begin - (np.cumsum(count) - count)[of]))
                out["lengths"].append(packed(finish - begin + SPAN))
    return _table(out, _COVER)


def _rest(key, rows, cover):
    """Pass 3: what is left of a chunk's documents."""
    if not rows.num_rows:
        return _table({f.name: [] for f in _KEPT}, _KEPT)
    doc_ids, data, offsets = chunk_texts(rows)
    depth = np.zeros(len(data) + 1, np.int32)
    for side in cover.select(["places", "starts", "lengths"]).to_pylist():
        start = offsets[unpacked(side["places"], 4).astype(np.int64)] + unpacked(side["starts"]).astype(np.int64)
        np.add.at(depth, start, 1)
        np.add.at(depth, start + unpacked(side["lengths"]).astype(np.int64), -1)
    gone = np.cumsum(depth[:-1], dtype=np.int32) > 0
    begin = gone.copy()
    begin[1:] &= ~gone[:-1]
    edge = offsets[1:-1]
    edge = edge[edge < len(gone)]
    begin[edge] = gone[edge]
    removed, spans = np.r_[0, np.cumsum(gone)], np.r_[0, np.cumsum(begin)]
    out = {f.name: [] for f in _KEPT}
    for i, doc in enumerate(doc_ids.tolist()):
        a, b = int(offsets[i]), int(offsets[i + 1])
        kept = data[a:b][~gone[a:b]].tobytes()
        out["doc_id"].append(doc)
        out["n_bytes"].append(b - a)
        out["n_removed"].append(int(removed[b] - removed[a]))
        out["n_spans"].append(int(spans[b] - spans[a]))
        out["kept"].append(kept)
        out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
    return _table(out, _KEPT)


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256), one row per row of ``docs`` (doc_id, text).

    Removed is every byte of the UTF-8 text that a SPAN-byte string covers which also starts in a document of smaller
    id. NULL text is empty. A NULL doc_id comes after all ids; rows of one doc_id do not remove each other's bytes.
    ``kept`` are the bytes left, which need not be UTF-8 any more. Other columns are left out.
    """
    tasks = task_count(docs, "text", CHUNK_BYTES)
    buckets = tasks
    rows = chunked(docs, tasks)
    found = rows.groupBy("chunk").applyInArrow(_anchors(buckets), _ANCHORS_SQL)
    shared = found.groupBy("bucket").applyInArrow(_shared, _ANCHORS_SQL)
    runs = rows.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(_runs(buckets), _RUNS_SQL)
    cover = runs.groupBy("bucket").applyInArrow(_covered, _COVER_SQL)
    rest = rows.groupBy("chunk").cogroup(cover.groupBy("chunk")).applyInArrow(_rest, _KEPT_SQL)
    return rest.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_DOC)))
