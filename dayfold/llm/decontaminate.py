"""Benchmark decontamination by suffix arrays of the training texts.

Every task sorts the word suffixes of its documents (a shard) and looks every benchmark suffix up by binary search, which
gives all places where it occurs; matches are extended word by word to their full length. Suffixes that cannot hold a
match are left out of the array: a word before the shortest window's end is in no benchmark text, or the first words
together start no benchmark window. A benchmark larger than a block is looked up block by block.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from dayfold.llm.common import LOWER, BYTE_VALUES, pieces, prefix_hash, ranges, span_hash, text_bytes, word_spans

#: Bytes of benchmark text looked up at a time.
BLOCK_BYTES = 4 << 20
LEAD = 4
#: ASCII bytes other than digits and letters separate words; all other bytes belong to words.
WORD_BYTES = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the offsets of the texts in words."""
    data = LOWER[data]
    starts, ends = word_spans(data, offsets, WORD_BYTES)
    return span_hash(prefix_hash(BYTE_VALUES[data]), starts, ends), np.searchsorted(starts, offsets)


def _key(ids: np.ndarray, at: np.ndarray, words: int) -> np.ndarray:
    """The next ``words`` word numbers from each place as bytes that sort as the numbers do."""
    block = ids[at[:, None] + np.arange(words)].astype(">u4")
    return np.ascontiguousarray(block).view(f"S{4 * words}").ravel()


@dataclass
class Benchmark:
    """Words of one block of items, and its windows by their length."""

    names: list[int | None]
    vocabulary: np.ndarray
    words: np.ndarray  # numbers of the words, from 1 on
    item_of: np.ndarray
    item_end: np.ndarray  # of each word, where its item ends
    windows: dict[int, np.ndarray]  # length: starts

    @staticmethod
    def of(items: list[tuple[int | None, str | None]], window: int) -> Benchmark:
        data, offsets = text_bytes(pa.array([t for _, t in items], pa.string()))
        hashes, bounds = word_hashes(data, offsets)
        vocabulary, numbers = np.unique(hashes, return_inverse=True)
        count = np.diff(bounds)
        windows = {}
        for i in np.flatnonzero(count):
            size = min(window, int(count[i]))
            windows.setdefault(size, []).append(np.arange(bounds[i], bounds[i + 1] - size + 1))
        item_of = np.repeat(np.arange(len(items)), count)
        return Benchmark([n for n, _ in items], vocabulary, numbers + 1, item_of, np.repeat(bounds[1:], count), {k: np.concatenate(v) for k, v in windows.items()})

    def numbers_of(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary number of each hash; 0 for a word of no item."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def occurrences(bench: Benchmark, hashes: np.ndarray, bounds: np.ndarray):
    """(place in the shard, place in the benchmark, window length) of every occurrence of a window."""
    ids = bench.numbers_of(hashes)
    n = len(ids)
    doc_end = np.repeat(bounds[1:], np.diff(bounds))
    stops = np.flatnonzero(ids == 0)
    reach = np.minimum(np.append(stops, n)[np.searchsorted(stops, np.arange(n))], doc_end) - np.arange(n)
    for size, test in bench.windows.items():
        able = np.flatnonzero(reach >= size)
        lead = min(LEAD, size)
        starts = np.unique(_key(bench.words, test, lead))
        if len(able):
            seen = _key(ids, able, lead)
            at = np.minimum(np.searchsorted(starts, seen), len(starts) - 1)
            able = able[starts[at] == seen]
        if not len(able):
            continue
        suffixes = _key(ids, able, size)
        order = np.argsort(suffixes, kind="stable")  # the shard's suffix array
        suffixes, able = suffixes[order], able[order]
        wanted = _key(bench.words, test, size)
        low, high = np.searchsorted(suffixes, wanted, "left"), np.searchsorted(suffixes, wanted, "right")
        count = high - low
        yield able[ranges(low, count)], np.repeat(test, count), size


def longest(bench: Benchmark, ids: np.ndarray, doc_end: np.ndarray, place: np.ndarray, test: np.ndarray, size: int) -> np.ndarray:
    """Words of the match that starts at each occurrence, extended as far as both texts agree."""
    length = np.full(len(place), size)
    alive = np.arange(len(place))
    while len(alive):
        a, b = place[alive] + length[alive], test[alive] + length[alive]
        inside = (a < doc_end[place[alive]]) & (b < bench.item_end[test[alive]])
        alive, a, b = alive[inside], a[inside], b[inside]
        alive = alive[ids[a] == bench.words[b]]
        length[alive] += 1
    return length


_STATE = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.int32())), ("items", pa.list_(pa.string())), ("longest", pa.int32()), ("match_word", pa.int32()), ("match_item", pa.int64())])
_STATE_SQL = "n_words bigint, hits array<int>, items array<string>, longest int, match_word int, match_item bigint"


def _search(bench: Benchmark, data: np.ndarray, offsets: np.ndarray):
    """Per document: words, hit word intervals [start, end, start, end ...], item names, longest match and where."""
    hashes, bounds = word_hashes(data, offsets)
    docs = len(offsets) - 1
    cover = np.zeros(len(hashes) + 1, np.int64)
    doc_of = np.repeat(np.arange(docs), np.diff(bounds))
    doc_end = np.repeat(bounds[1:], np.diff(bounds))
    ids = bench.numbers_of(hashes)
    items: list[set[str]] = [set() for _ in range(docs)]
    best = np.zeros((docs, 3), np.int64)
    for place, test, size in occurrences(bench, hashes, bounds):
        np.add.at(cover, place, 1)
        np.add.at(cover, place + size, -1)
        for doc, item in np.unique(np.stack([doc_of[place], bench.item_of[test]], 1), axis=0).tolist():
            if bench.names[item] is not None:
                items[doc].add(str(bench.names[item]))
        # a match that also goes on one word to the left is found from there
        left = (place > bounds[doc_of[place]]) & (test > 0)
        left[left] = (ids[place[left] - 1] == bench.words[test[left] - 1]) & (bench.item_of[test[left] - 1] == bench.item_of[test[left]])
        place, test = place[~left], test[~left]
        words = longest(bench, ids, doc_end, place, test, size)
        for k in np.lexsort((place, -words, doc_of[place])).tolist()[::-1]:
            doc = doc_of[place[k]]
            if words[k] >= best[doc, 0]:
                best[doc] = words[k], place[k] - bounds[doc], bench.item_of[test[k]] + 1
    hit = np.cumsum(cover[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
    spans: list[list[int]] = [[] for _ in range(docs)]
    for start, end in edge.reshape(-1, 2).tolist():
        while start < end:  # a run may go on into the next document
            doc = doc_of[start]
            stop = min(end, int(bounds[doc + 1]))
            spans[doc] += [start - int(bounds[doc]), stop - int(bounds[doc])]
            start = stop
    for doc in range(docs):
        words, at, item = best[doc].tolist()
        yield int(bounds[doc + 1] - bounds[doc]), spans[doc], sorted(items[doc]), words, at if words else None, bench.names[item - 1] if item else None


def _united(a: list[int], b: list[int]) -> list[int]:
    """Union of two lists of intervals."""
    found: list[int] = []
    for start, end in sorted([*zip(a[::2], a[1::2], strict=True), *zip(b[::2], b[1::2], strict=True)]):
        if found and start <= found[-1]:
            found[-1] = max(found[-1], end)
        else:
            found += [start, end]
    return found


def _blocks(benchmark: DataFrame, window: int):
    """The benchmark in blocks of bounded text, streamed to the driver."""
    block, held = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        block.append((row[0], row[1]))
        held += len(row[1] or "")
        if held >= BLOCK_BYTES:
            yield Benchmark.of(block, window)
            block, held = [], 0
    yield Benchmark.of(block, window)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Rows of ``docs`` with what they share with ``benchmark`` (item_id, text).

    Added: n_words, n_hit (words inside occurrences of windows of ``window`` item words; an item of fewer is one window),
    item_ids (of the items with occurring windows, sorted), longest_match (words), match_word and match_item (where it
    starts, and whose it is), contaminated. Letters A-Z count as a-z. NULL and empty texts have no words; repeated rows
    and items stay repeated or count once; items without id contaminate, but are not listed. No shuffle.
    """
    names = docs.columns
    added = ("n_words", "n_hit", "item_ids", "longest_match", "match_word", "match_item", "contaminated")
    if clash := set(added) & set(names):
        raise ValueError(f"columns {sorted(clash)} are there already")
    at, held = names.index("text"), "_found"
    while held in {n.lower() for n in names}:
        held += "_"
    state = docs
    for bench in _blocks(benchmark, window):
        shared = docs.sparkSession.sparkContext.broadcast(bench)  # BLOCK_BYTES of text at most

        def look(batches, shared=shared):
            for batch in batches:
                data, offsets = text_bytes(batch.column(at))
                for first, last in pieces(offsets):
                    own = offsets[first : last + 1]
                    part = batch.slice(first, last - first)
                    rows = list(_search(shared.value, data[own[0] : own[-1]], own - own[0]))
                    if part.num_columns > len(names):
                        rows = [_joined(a, b) for a, b in zip(part.column(len(names)).to_pylist(), rows, strict=True)]
                    keys = [f.name for f in _STATE]
                    found = pa.array([dict(zip(keys, r, strict=True)) for r in rows], _STATE)
                    yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], found], [*names, held])

        schema = StructType([*docs.schema.fields, StructField(held, StructType.fromDDL(_STATE_SQL))])
        state = state.mapInArrow(look, schema)
    hits = F.col(f"{held}.hits")
    total = F.aggregate(F.sequence(F.lit(0), (F.size(hits) / 2).cast("int") - 1), F.lit(0).cast("bigint"), lambda s, i: s + hits[i * 2 + 1] - hits[i * 2])
    n_hit = F.when(F.size(hits) > 0, total).otherwise(F.lit(0).cast("bigint"))
    return state.select(
        *names,
        F.col(f"{held}.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.col(f"{held}.items").alias("item_ids"),
        F.col(f"{held}.longest").alias("longest_match"),
        F.col(f"{held}.match_word").alias("match_word"),
        F.col(f"{held}.match_item").alias("match_item"),
        (n_hit > 0).alias("contaminated"),
    )


def _joined(before: dict, now: tuple) -> tuple:
    words, hits, items, length, at, item = now
    if before["longest"] >= length:
        length, at, item = before["longest"], before["match_word"], before["match_item"]
    return words, _united(before["hits"], hits), sorted({*before["items"], *items}), length, at, item


def items_digest(item_ids: list[str]) -> str:
    return hashlib.sha256(",".join(item_ids).encode()).hexdigest()


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark."""
    return contamination(docs, benchmark, window).where("not contaminated").select(*docs.columns)
