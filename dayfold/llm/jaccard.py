"""Exact n-gram Jaccard join in the metric space of shingle sets.

1. Documents of equal sets are one. Shingles are counted over all documents, and every set is put in the order of rising
   counts. Two sets within distance 1 - J share a shingle of their first |x| - ceil(J |x|) + 1 ones, so sets that share
   none there, directly or in a chain, lie in different regions and never meet.
2. A region of bounded size is joined in one task. In a larger one, pivots are taken and every set's distances to them are
   measured: a set falls to the cell of its nearest pivot (Voronoi), and is copied to every cell that the triangle
   inequality leaves open within the threshold. There it meets the sets that share a shingle of both prefixes, if what
   follows it in either is enough for the threshold: the first shingle that a pair shares has all others behind it.
3. Within a region, whatever is linked with a pivot is connected at once. Only sets outside the region's largest group
   still have to meet others, and of those only the ones whose distances to the pivots differ by no more than the
   threshold: the next pivot is taken among them, until no set outside the largest group is left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.common import BYTE_VALUES, LOWER, NO_DOC, by_bucket, chunk_texts, chunked, components, merged, mixed, packed, pieces, prefix_hash, ranges, span_hash, stored, task_count, unpacked, word_spans

WORDS = 5
CHUNK_BYTES = 6 << 20
#: White space that ends words: blank, and bytes 9 to 13.
WORD_BYTES = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])
#: Sets and shingles of a region that is joined in one task.
REGION_SETS = 1000
REGION_SHINGLES = 1 << 20
PIVOTS = 12

_KEY = np.uint64((1 << 48) - 1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of every text, ascending, and their offsets by text.

    Letters A-Z count as a-z. A text of fewer words is one shingle; one without words has none.
    """
    shingles, sizes = [np.zeros(0, np.uint64)], []
    for first, last in pieces(offsets):
        own = offsets[first : last + 1] - offsets[first]
        part = LOWER[data[offsets[first] : offsets[last]]]
        starts, ends = word_spans(part, own, WORD_BYTES)
        word = span_hash(prefix_hash(BYTE_VALUES[part]), starts, ends)
        bounds = np.searchsorted(starts, own)
        count = np.diff(bounds)
        made = np.where(count >= words, count - words + 1, np.minimum(count, 1))
        doc = np.repeat(np.arange(len(made)), made)
        at = ranges(bounds[:-1], made)
        width = np.minimum(words, count)[doc]
        value = np.zeros(len(at), np.uint64)
        for k in range(words):
            have = k < width
            value[have] = mixed(value[have] * np.uint64(0x9E3779B97F4A7C15) + word[at[have] + k])
        order = np.lexsort((value, doc))
        value, doc = value[order], doc[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
        shingles.append(value[new])
        sizes.append(np.bincount(doc[new], minlength=len(made)))
    return np.concatenate(shingles), np.r_[0, np.cumsum(np.concatenate([np.zeros(0, np.int64), *sizes]))].astype(np.int64)


def _set_names(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of every set."""
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(mixed(shingles), dtype=np.uint64)]
    return mixed((sums[bounds[1:]] - sums[bounds[:-1]]) + mixed(np.diff(bounds).astype(np.uint64)))


def _classes(doc_ids: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each document, the smallest doc_id with its set; and whether it is the first document of that id and set."""
    order = np.lexsort((doc_ids, names))
    new = np.ones(len(order), bool)
    new[1:] = names[order[1:]] != names[order[:-1]]
    least, first = np.zeros(len(order), np.int64), np.zeros(len(order), bool)
    least[order] = doc_ids[order][np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else 0
    first[order] = new
    return least, first


def _table(columns: dict[str, list], schema: pa.Schema) -> pa.Table:
    return pa.table({f.name: pa.array(columns[f.name], f.type) for f in schema}, schema=schema)


_COUNTS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("keys", pa.binary()), ("values", pa.binary()), ("names", pa.binary()), ("least", pa.binary())])
_COUNTS_SQL = "bucket int, chunk int, keys binary, values binary, names binary, least binary"
_SETS = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("class", pa.int64()), ("name", pa.int64()), ("shingles", pa.list_(pa.int64())), ("prefix", pa.list_(pa.int64()))])
_SETS_SQL = "doc_id bigint, n_shingles bigint, class bigint, name bigint, shingles array<bigint>, prefix array<bigint>"


def _bucket_of(values: np.ndarray, buckets: int) -> np.ndarray:
    return ((values >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _chunk_sets(rows: pa.Table, words: int):
    doc_ids, data, offsets = chunk_texts(rows)
    shingles, bounds = shingle_sets(data, offsets, words)
    names = _set_names(shingles, bounds)
    least, first = _classes(doc_ids, names)
    kept = np.repeat(first, np.diff(bounds))
    keys, count = np.unique(shingles[kept], return_counts=True)
    return doc_ids, shingles, bounds, names, least, first, keys, count


def _count(buckets: int, words: int):
    """Pass 1: how many different sets of a chunk hold each shingle; and the chunk's sets by name."""

    def run(key, rows):
        _, _, bounds, names, least, first, keys, count = _chunk_sets(rows, words)
        out: dict[int, list] = {}
        for bucket, at in by_bucket(_bucket_of(keys, buckets)):
            # 48 bits of a hash are enough to count by: shingles that share them only seem more frequent
            short, where = np.unique(keys[at] & _KEY, return_inverse=True)
            several = np.minimum(np.bincount(where, count[at]), 255).astype(np.int64)
            out[bucket] = [packed(np.diff(short, prepend=np.uint64(0)), 6), packed(several, 1), b"", b""]
        own = np.flatnonzero(first & (np.diff(bounds) > 0))
        for bucket, at in by_bucket(_bucket_of(names[own], buckets)):
            row = out.setdefault(bucket, [b"", b"", b"", b""])
            row[2:] = packed(names[own[at]]), packed(least[own[at]].view(np.uint64))
        chunk = key[0].as_py()
        columns = [list(out), [chunk] * len(out), *map(list, zip(*out.values(), strict=True))] if out else [[]] * 6
        return _table(dict(zip(_COUNTS.names, columns, strict=True)), _COUNTS)

    return run


def _levels(count: np.ndarray) -> np.ndarray:
    """Counts as codes of one byte that rise with them; 0 for a shingle of one set."""
    return np.minimum(255, np.floor(np.log2(count) * 8)).astype(np.uint8)


def _sum(_, rows):
    """Of a bucket: for each chunk the counts over all chunks, in its own order, and the smallest doc_id of sets that
    other chunks have too."""
    sides = rows.to_pylist()
    keys = [np.cumsum(unpacked(s["keys"], 6), dtype=np.uint64) for s in sides]
    counts = [unpacked(s["values"], 1).astype(np.int64) for s in sides]
    every, where = np.unique(np.concatenate(keys), return_inverse=True)
    code = _levels(np.maximum(1, np.bincount(where, np.concatenate(counts), len(every)))) if len(every) else np.zeros(0, np.uint8)
    names = [unpacked(s["names"]) for s in sides]
    least = np.concatenate([unpacked(s["least"]).view(np.int64) for s in sides])
    sets, of = np.unique(np.concatenate(names), return_inverse=True)
    lowest = np.full(len(sets), NO_DOC)
    np.minimum.at(lowest, of, least)
    several = np.bincount(of, minlength=len(sets)) > 1
    out = {f.name: [] for f in _COUNTS}
    a = b = 0
    for side, own, named in zip(sides, keys, names, strict=True):
        codes, shared = code[where[a : a + len(own)]], of[b : b + len(named)]
        a, b = a + len(own), b + len(named)
        shared = shared[several[shared]]
        used = np.flatnonzero(codes)  # most shingles stand in one set only, and are not sent back
        if len(used) or len(shared):
            out["bucket"].append(side["bucket"])
            out["chunk"].append(side["chunk"])
            out["keys"].append(packed(np.diff(own[used], prepend=np.uint64(0)), 6))
            out["values"].append(codes[used].tobytes())
            out["names"].append(packed(sets[shared]))
            out["least"].append(packed(lowest[shared].view(np.uint64)))
    return _table(out, _COUNTS)


def _sets(words: int, percent: int, buckets: int):
    """Pass 2: every document with its class; the sets of classes that share a shingle of their prefix with another."""

    def run(key, rows, counts):
        out = {f.name: [] for f in _SETS}
        if not rows.num_rows:
            return _table(out, _SETS)
        doc_ids, shingles, bounds, names, least, first, keys, _ = _chunk_sets(rows, words)
        code_of = np.zeros(len(keys), np.uint8)
        elsewhere: dict[int, int] = {}
        places = dict(by_bucket(_bucket_of(keys, buckets)))
        for side in counts.to_pylist():
            known = np.cumsum(unpacked(side["keys"], 6), dtype=np.uint64)
            if len(known):
                at = places[side["bucket"]]
                found = np.minimum(np.searchsorted(known, keys[at] & _KEY), len(known) - 1)
                hit = known[found] == keys[at] & _KEY
                code_of[at[hit]] = np.frombuffer(side["values"], np.uint8)[found[hit]]
            elsewhere.update(zip(unpacked(side["names"]).tolist(), unpacked(side["least"]).view(np.int64).tolist(), strict=True))
        code = code_of[np.minimum(np.searchsorted(keys, shingles), max(0, len(keys) - 1))]
        doc = np.repeat(np.arange(len(doc_ids)), np.diff(bounds))
        order = np.lexsort((shingles, code, doc))
        rank = np.arange(len(order)) - bounds[doc]  # doc ascends, so the order keeps each set in its place
        size = np.diff(bounds)
        prefix = size - (percent * size + 99) // 100 + 1
        in_prefix = (rank < prefix[doc]) & (code[order] > 0)
        for i, doc_id in enumerate(doc_ids.tolist()):
            a, b = int(bounds[i]), int(bounds[i + 1])
            lowest = min(int(least[i]), elsewhere.get(int(names[i]), NO_DOC)) if b > a else doc_id
            out["doc_id"].append(doc_id)
            out["n_shingles"].append(b - a)
            out["class"].append(lowest)
            out["name"].append(int(names[i].view(np.int64)))
            head = order[a:b][in_prefix[a:b]]
            sent = b > a and first[i] and lowest == doc_id and len(head)
            out["shingles"].append(shingles[a:b].view(np.int64) if sent else None)
            out["prefix"].append(shingles[head].view(np.int64) if sent else None)
        return _table(out, _SETS)

    return run


def region_links(offsets: np.ndarray, shingles: np.ndarray, percent: int, pivots: int = PIVOTS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect every group of sets of a region: step 3 of the method, in memory."""
    m = len(offsets) - 1
    size = np.diff(offsets)
    _, number = np.unique(shingles, return_inverse=True)
    doc = np.repeat(np.arange(m), size)
    mark = np.zeros(int(number.max()) + 1 if len(number) else 0, bool)
    label = np.arange(m)
    done = np.zeros(m, bool)
    away: list[np.ndarray] = []  # distances to the first pivots
    limit = 1 - percent / 100 + 1e-9
    a, b = [], []
    while True:
        largest = np.bincount(label, minlength=m).argmax()
        open_ = np.flatnonzero(~done & (label != largest))
        if not len(open_):
            break
        # the set farthest from the pivots so far, while these are few
        pivot = int(open_[np.argmax(np.min([d[open_] for d in away], axis=0))]) if away and len(away) < pivots else int(open_[0])
        done[pivot] = True
        meets = np.ones(m, bool)
        if len(away) >= pivots:
            for d in away:
                meets &= np.abs(d - d[pivot]) <= limit
        own = number[offsets[pivot] : offsets[pivot + 1]]
        mark[own] = True
        if meets.all():
            overlap = np.bincount(doc[mark[number]], minlength=m)
        else:
            part = np.flatnonzero(meets)
            at = ranges(offsets[part], size[part])
            overlap = np.bincount(np.repeat(part, size[part])[mark[number[at]]], minlength=m)
        mark[own] = False
        union = size + size[pivot] - overlap
        if len(away) < pivots:
            away.append(1 - overlap / union)
        near = np.flatnonzero(meets & (100 * overlap >= percent * union))
        near = near[near != pivot]
        a.append(np.full(len(near), pivot))
        b.append(near)
        if len(near):
            root = merged(label[np.full(len(near), pivot)], label[near], m)
            label = root[label]
    return np.concatenate([np.zeros(0, np.int64), *a]), np.concatenate([np.zeros(0, np.int64), *b])


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _join_regions(percent: int):
    def run(_, rows):
        rows = rows.sort_by("region")
        region, ids = rows.column("region").to_numpy(), rows.column("class").to_numpy()
        lists = rows.column("shingles").combine_chunks()
        lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
        values, offsets = lists.flatten().to_numpy(), np.r_[0, np.cumsum(np.asarray(lists.value_lengths()))].astype(np.int64)
        cuts = np.flatnonzero(np.diff(region)) + 1
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for first, last in zip(np.r_[0, cuts], np.r_[cuts, len(region)], strict=True):
            if last - first > 1:
                x, y = region_links(offsets[first : last + 1] - offsets[first], values[offsets[first] : offsets[last]], percent)
                a.append(ids[first + x])
                b.append(ids[first + y])
        return pa.table([np.concatenate(a), np.concatenate(b)], schema=_LINK)

    return run


def _overlap_links(pairs: DataFrame, percent: int) -> DataFrame:
    overlap = F.size(F.array_intersect("x", "y"))
    return pairs.select("a", "b", overlap.alias("both"), (F.size("x") + F.size("y")).alias("all")).where(F.col("both") * 100 >= (F.col("all") - F.col("both")) * percent).select("a", "b")


def _large_links(big: DataFrame, percent: int) -> DataFrame:
    """Links that connect the groups of regions too large for one task; ``big`` (region, class, shingles, prefix), stored."""
    # as many pivots for each region as there are slots, of each slot the set with the least share of shingles that no other
    # has: many sets are near to it
    slot = F.pmod(F.xxhash64("class", F.lit("slot")), F.lit(PIVOTS)).cast("int")
    pivots = big.groupBy("region", slot.alias("slot")).agg(F.min(F.struct((_lone(percent) / F.size("shingles")).alias("lone"), F.xxhash64("class").alias("hash"), "class")).alias("first"))
    pivots = pivots.select(F.col("region").alias("p_region"), "slot", F.col("first.class").alias("pivot"))
    sets = big.select(F.col("region").alias("s_region"), F.col("class").alias("s_class"), F.col("shingles").alias("p_shingles"))
    pivots = stored(pivots.join(sets, (F.col("p_region") == F.col("s_region")) & (F.col("pivot") == F.col("s_class"))).select("p_region", "slot", "pivot", "p_shingles"), "pivots")
    overlap = F.size(F.array_intersect("shingles", "p_shingles"))
    distance = 1 - overlap / (F.size("shingles") + F.size("p_shingles") - overlap)
    measured = big.join(pivots, F.col("region") == F.col("p_region")).select("region", "class", "slot", "pivot", distance.alias("distance"))
    measured = stored(measured, "pivot-distances")
    limit = 1 - percent / 100 + 1e-9
    links = measured.where((F.col("distance") <= limit) & (F.col("class") != F.col("pivot"))).select(F.col("class").alias("a"), F.col("pivot").alias("b"))
    groups = components(links)
    # one row per set: a fixed number of distances, in the order of the slots
    placed = measured.groupBy("region", "class").agg(F.array_sort(F.collect_list(F.struct("slot", "distance"))).alias("to"), F.max(F.col("class") == F.col("pivot")).alias("is_pivot"))
    placed = placed.join(groups, placed["class"] == groups["id"], "left").select("region", "class", "is_pivot", F.col("to.distance").alias("to"), F.coalesce("component_id", "class").alias("group"))
    placed = stored(placed, "placed")
    size = placed.groupBy("region", "group").count().groupBy("region").agg(F.max_by("group", F.struct("count", "group")).alias("largest"))
    outside = placed.join(size, "region").where((F.col("group") != F.col("largest")) & ~F.col("is_pivot"))
    # a set belongs to the cell of its nearest pivot; one outside the largest group meets those of all cells in reach
    nearest = F.array_min("to")
    heads = stored(_heads(big, percent), "prefixes")
    cell = placed.select(F.col("class").alias("_class"), F.array_position("to", nearest).cast("int").alias("cell"))
    cells = heads.join(cell, F.col("class") == F.col("_class")).select("shingle", "cell", F.col("class").alias("b"), F.col("size").alias("size_b"), F.col("left").alias("left_b"))
    reach = F.explode(F.filter(F.sequence(F.lit(1), F.size("to")), lambda i: F.get("to", i - 1) <= nearest + 2 * limit))
    reached = outside.select(F.col("class").alias("_class"), reach.alias("cell"))
    least = heads.groupBy("shingle").agg(F.min("size").alias("least"), F.count("*").alias("n")).where("n > 1").select(F.col("shingle").alias("_shingle"), "least")
    able = lambda left, one, other: left * (100 + percent) >= (one + other) * percent
    asking = heads.join(least, F.col("shingle") == F.col("_shingle")).where(able(F.col("left"), F.col("size"), F.col("least")))
    copies = asking.select("shingle", "class", "size", "left").join(reached, F.col("class") == F.col("_class"))
    copies = copies.select("shingle", "cell", F.col("class").alias("a"), F.col("size").alias("size_a"), F.col("left").alias("left_a"))
    met = copies.join(cells, ["shingle", "cell"]).where((F.col("a") != F.col("b")) & able(F.least("left_a", "left_b"), F.col("size_a"), F.col("size_b")))
    met = stored(met.select("a", "b").distinct(), "met-sets")
    side = lambda mark: placed.select(F.col("class").alias(mark), F.col("to").alias(f"to_{mark}"), F.col("group").alias(f"group_{mark}"))
    window = F.forall(F.zip_with("to_a", "to_b", lambda p, q: F.abs(p - q) <= limit), lambda x: x)
    met = met.join(side("a"), "a").join(side("b"), "b").where((F.col("group_a") != F.col("group_b")) & window).select("a", "b")
    full = lambda mark, name: big.select(F.col("class").alias(mark), F.col("shingles").alias(name))
    return links.union(_overlap_links(met.join(full("a", "x"), "a").join(full("b", "y"), "b"), percent))


def _lone(percent: int):
    """Of a set (shingles, prefix), the shingles that no other set has; they stand first and are left out of the prefix."""
    return F.expr(f"size(shingles) - ({percent} * size(shingles) + 99) div 100 + 1 - size(prefix)").cast("int")


def _heads(sets: DataFrame, percent: int) -> DataFrame:
    """(shingle, class, size, left) of the prefixes of ``sets`` (class, shingles, prefix): ``left`` is the number of the
    set's shingles from this one on, in the order of rising counts."""
    rows = sets.select("class", F.size("shingles").alias("size"), _lone(percent).alias("lone"), F.posexplode("prefix").alias("at", "shingle"))
    return rows.select("shingle", "class", "size", (F.col("size") - F.col("lone") - F.col("at")).alias("left"))


def near_documents(docs: DataFrame, words: int = WORDS, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, class, component_id) of every row of ``docs`` (doc_id, text).

    Two documents link if the Jaccard similarity of their sets of ``words``-word shingles is ``percent`` / 100 or more.
    class is the smallest doc_id with the same set, component_id the smallest one reachable by links. Documents without
    words link with nothing. A NULL doc_id comes after all ids; rows of one doc_id but different texts are compared as
    different documents, and each has the smallest id that either reaches. Other columns are left out.
    """
    tasks = task_count(docs, "text", CHUNK_BYTES)
    buckets = tasks
    rows = chunked(docs, tasks)
    counted = rows.groupBy("chunk").applyInArrow(_count(buckets, words), _COUNTS_SQL)
    summed = counted.groupBy("bucket").applyInArrow(_sum, _COUNTS_SQL)
    sets = rows.groupBy("chunk").cogroup(summed.groupBy("chunk")).applyInArrow(_sets(words, percent, buckets), _SETS_SQL)
    sets = stored(sets, "sets")
    # from here on a class is named by the hash of its set, which tells rows of one doc_id apart
    open_sets = sets.where("shingles is not null").select(F.col("name").alias("class"), "shingles", "prefix")
    heads = open_sets.select("class", F.explode("prefix").alias("shingle"))
    first = heads.groupBy("shingle").agg(F.min("class").alias("first"), F.max("class").alias("last")).where("first <> last").select("shingle", "first")
    region = components(heads.join(first, "shingle").where("class <> first").select(F.col("class").alias("a"), F.col("first").alias("b")).distinct())
    placed = open_sets.join(region, F.col("class") == region["id"]).select(F.col("component_id").alias("region"), "class", "shingles", "prefix")
    placed = stored(placed, "regions")
    sizes = placed.groupBy("region").agg(F.count("*").alias("sets"), F.sum(F.size("shingles")).alias("all"))
    large = stored(sizes.where((F.col("sets") > REGION_SETS) | (F.col("all") > REGION_SHINGLES)).select(F.col("region").alias("large")), "large-regions")
    small = placed.drop("prefix").join(large, F.col("region") == F.col("large"), "left_anti")
    # about REGION_SHINGLES in a group of regions
    total = sizes.join(large, F.col("region") == F.col("large"), "left_anti").agg(F.sum("all")).first()[0] or 0
    groups = max(tasks, -(-total // REGION_SHINGLES)) * 4
    links = small.withColumn("part", F.pmod(F.xxhash64("region"), F.lit(groups)).cast("int")).groupBy("part").applyInArrow(_join_regions(percent), "a bigint, b bigint")
    if not large.isEmpty():
        big = stored(placed.join(large, F.col("region") == F.col("large"), "left_semi"), "large-sets")
        links = links.union(_large_links(big, percent))
    found = components(links, native=True)  # links come as stars of pivots
    named = sets.join(found, F.col("name") == found["id"], "left").select("doc_id", "n_shingles", "class", F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "name")).alias("group"))
    low = named.where("group is not null").groupBy(F.col("group").alias("_group")).agg(F.min("class").alias("low"))
    out = named.join(low, F.col("group") == F.col("_group"), "left").select("doc_id", "n_shingles", "class", F.coalesce("low", "doc_id").alias("component_id"))
    null = lambda c: F.nullif(c, F.lit(NO_DOC)).alias(c)
    return out.select(null("doc_id"), "n_shingles", null("class"), null("component_id"))
