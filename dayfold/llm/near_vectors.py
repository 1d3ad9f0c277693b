"""Exact pairs of near embeddings by dual traversal of cover trees.

Vectors of equal direction are one point. Points are dealt into groups near common pivots; a tree of nested levels with
halving radii is built over each group, and pairs of groups are traversed together: a pair of nodes whose centres are
farther apart than both covering radii and the threshold's distance together holds no link and is pruned. So are pairs
of whole groups, by their cells' radii and by their distances to all pivots, before a group is read. Groups are written
once; the task of a pair reads both from there, so that disk grows with the vectors and not with the pairs of groups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.common import components, merged, ranges, stored
from dayfold.session import fresh_folder

#: Points of one group at most; two groups meet in a task.
GROUP_POINTS = 4096
PIVOTS = 64
#: Covering radii of the levels, from the root's children down; cosine c is the distance sqrt(2 - 2c).
RADII = (0.5, 0.25, 0.125)
SLACK = 1e-9
#: Distances near zero are roots of differences of about 1e-16.
ROOT_SLACK = 1e-7
#: Error of a product of unit vectors in single precision, which only decides what is measured in double.
ROUGH = 1e-4
#: Groups on either side of a block of pairs, which one task joins.
BLOCK = 4


def cover_tree(points: np.ndarray) -> list[dict[str, np.ndarray]]:
    """Levels of a cover tree over unit vectors, the widest first: ``centre`` (a point), ``parent`` (node of the level
    above) and ``radius`` (of the farthest point below); the last level's nodes list their points."""
    n = len(points)
    node = np.zeros(n, np.int64)  # of each point, on the level above
    levels = []
    for radius in RADII:
        centres, parents, own = [], [], np.full(n, -1)
        order = np.argsort(node, kind="stable")
        cuts = np.flatnonzero(np.diff(node[order])) + 1
        for members in np.split(order, cuts) if n else []:
            left = members
            while len(left):
                centre = left[0]
                near = points[left] @ points[centre] >= 1 - radius * radius / 2
                near[0] = True
                own[left[near]] = len(centres)
                centres.append(centre)
                parents.append(node[centre])
                left = left[~near]
        centres = np.array(centres, np.int64)
        away = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", points, points[centres[own]]))) if n else np.zeros(0)
        reach = np.zeros(len(centres))
        np.maximum.at(reach, own, away)
        levels.append({"centre": centres, "parent": np.array(parents, np.int64), "radius": reach})
        node = own
    levels.append({"leaf": node})
    return levels


def _children(parents: np.ndarray, count: int):
    order = np.argsort(parents, kind="stable")
    size = np.bincount(parents, minlength=count)
    return order, np.cumsum(size) - size, size


def _pairs(a: np.ndarray, b: np.ndarray, of_a, of_b) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children of each pair of nodes."""
    order_a, first_a, size_a = of_a
    order_b, first_b, size_b = of_b
    rep = np.repeat(np.arange(len(a)), size_a[a])
    left = order_a[ranges(first_a[a], size_a[a])]
    right = order_b[ranges(first_b[b[rep]], size_b[b[rep]])]
    return np.repeat(left, size_b[b[rep]]), right


def _dots(x: np.ndarray, a: np.ndarray, y: np.ndarray, b: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """x[a] . y[b], row by row, a portion at a time."""
    parts = [np.einsum("ij,ij->i", x[a[at : at + step]], y[b[at : at + step]]) for at in range(0, len(a), step)]
    return np.concatenate([np.zeros(0), *parts])


def near_pairs(x: np.ndarray, tree_x: list, y: np.ndarray, tree_y: list, cosine: float, step: int = 1 << 21):
    """Index pairs (i, j) with x[i] . y[j] >= ``cosine``, in portions; every such pair exactly once."""
    far = np.sqrt(2 - 2 * cosine)
    depth = len(RADII)
    child_x = [_children(tree_x[k]["parent"], len(tree_x[k - 1]["centre"])) for k in range(1, depth)]
    child_y = [_children(tree_y[k]["parent"], len(tree_y[k - 1]["centre"])) for k in range(1, depth)]
    leaf_x = _children(tree_x[depth]["leaf"], len(tree_x[depth - 1]["centre"]))
    leaf_y = _children(tree_y[depth]["leaf"], len(tree_y[depth - 1]["centre"]))

    def prune(a, b, k):
        if k == depth:
            keep = _dots(x, a, y, b) >= cosine
        else:
            nx, ny = tree_x[k], tree_y[k]
            bound = np.minimum(2.0, nx["radius"][a] + ny["radius"][b] + far + SLACK)
            keep = _dots(x, nx["centre"][a], y, ny["centre"][b]) >= 1 - bound * bound / 2 - SLACK
        return a[keep], b[keep]

    def below(a, b, k):
        if k == depth:
            if len(a):
                yield a, b
            return
        of_a, of_b = (child_x[k], child_y[k]) if k + 1 < depth else (leaf_x, leaf_y)
        made = np.cumsum(of_a[2][a] * of_b[2][b])
        first = 0
        while first < len(a):
            base = made[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(made, base + step, "right")))
            yield from below(*prune(*_pairs(a[first:last], b[first:last], of_a, of_b), k + 1), k + 1)
            first = last

    # the top level by matrix products in single precision, a few rows at a time; what they leave open is measured
    nx, ny = tree_x[0], tree_y[0]
    if not len(nx["centre"]) or not len(ny["centre"]):
        return
    widest, single = ny["radius"].max(), y[ny["centre"]].astype(np.float32).T
    rows = max(1, step // len(ny["centre"]))
    for at in range(0, len(nx["centre"]), rows):
        dots = x[nx["centre"][at : at + rows]].astype(np.float32) @ single
        bound = np.minimum(2.0, nx["radius"][at : at + rows] + widest + far + SLACK)
        least = (1 - bound * bound / 2 - SLACK - ROUGH).astype(np.float32)
        a, b = np.nonzero(dots >= least[:, None])
        yield from below(*prune(a + at, b, 0), 0)


def _valid(vector):
    number = F.transform(vector, lambda v: v.cast("double"))
    finite = F.forall(number, lambda v: F.coalesce((F.abs(v) <= 1.7976931348623157e308) & ~F.isnan(v), F.lit(False)))
    nonzero = F.exists(number, lambda v: F.coalesce(v != 0, F.lit(False)))
    return F.coalesce(vector.isNotNull() & finite & nonzero, F.lit(False))


def _units(column, size: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return _normal(flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), size))


def _normal(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=1e-300)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _number(vectors: DataFrame, name: str) -> str:
    """The type that holds the numbers of the array ``name`` wholly, as far as double does."""
    return "float" if vectors.schema[name].dataType.simpleString() == "array<float>" else "double"


def _names(vector) -> list:
    """128 bits that tell vectors apart, as two columns, so that joins need not shuffle the vectors."""
    return [F.xxhash64(vector).alias("name_1"), F.xxhash64(F.lit(1), vector).alias("name_2")]


def pivots_of(points: DataFrame, count: int) -> np.ndarray:
    """At most ``count`` points far from each other, out of a sample of 32 times as many chosen by hash."""
    sample = [r[0] for r in points.orderBy(F.xxhash64("vector"), "rep").select("vector").limit(32 * count).collect()]
    if not sample:
        return np.zeros((0, 0))
    x = _units(pa.array(sample, pa.list_(pa.float64())), len(sample[0]))
    chosen = [0]
    nearest = x @ x[0]
    while len(chosen) < min(count, len(x)) and nearest.min() < 1 - 1e-12:
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    return x[chosen]


#: Points without an id are named by a hash of their vector from here on, above all ids.
NAMELESS = 1 << 62


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, group_points: int = GROUP_POINTS) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Links join vectors of cosine ``cosine`` or more in double precision. n_links counts the other rows linked directly,
    copies included. NULL, zero, empty and non-finite vectors link with nothing, nor do vectors of different length
    with each other. component_id is the smallest vec_id of the linked group. Vectors without vec_id are linked as any other;
    a group of these only has a NULL component_id and is kept whole. Ids are below 2^62. Other columns are left out.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    kind = _number(rows, "embedding")
    # adding zero makes one of the two zeros
    vector = F.when(_valid(F.col("embedding")), F.transform("embedding", lambda v: v.cast(kind) + F.lit(0).cast(kind)))
    usable = rows.select("vec_id", vector.alias("vector")).where("vector is not null")
    points = usable.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    points = stored(points.select("vector", F.coalesce("rep", F.pmod(F.xxhash64("vector"), F.lit(1 << 61)) + F.lit(NAMELESS)).alias("rep"), "copies"), "points")
    sizes = [r[0] for r in points.select(F.size("vector")).distinct().collect()]  # as many as the table has vector lengths
    found = [_links(points.where(F.size("vector") == s), s, cosine, group_points) for s in sizes]
    if not found:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    counts, links = found[0]
    for more, others in found[1:]:
        counts, links = counts.union(more), links.union(others)
    groups = components(links)
    counts = counts.groupBy(F.col("rep").alias("_counted")).agg(F.sum("n").alias("n"))
    named = points.select(*_names(F.col("vector")), "rep", "copies")
    summed = named.join(counts, F.col("rep") == F.col("_counted"), "left").join(groups, F.col("rep") == groups["id"], "left")
    summed = summed.select("name_1", "name_2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce(groups["component_id"], "rep").alias("_group"))
    named = rows.select("vec_id", vector.alias("vector"))
    named = named.select("vec_id", *[F.when(F.col("vector").isNotNull(), n).alias(f"_{i}") for i, n in enumerate(_names(F.col("vector")))])
    out = named.join(summed, (F.col("_0") == F.col("name_1")) & (F.col("_1") == F.col("name_2")), "left")
    group = F.coalesce("_group", "vec_id")
    group = F.when(group < NAMELESS, group)
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), group.alias("component_id"), F.coalesce(group == F.col("vec_id"), group.isNull()).alias("kept"))


_TREE_SQL = "part int, n bigint, reps binary, copies binary, points binary, tree binary, nearest array<double>, farthest array<double>, cells array<int>, aways array<double>"


def _read_group(folder: str, part: int, size: int, kind: str) -> tuple:
    """Unit vectors, tree, reps and copies of a written group."""
    import pickle

    import pyarrow.parquet as pq
    from pyarrow import fs

    uri = folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder
    system, name = fs.FileSystem.from_uri(f"{uri}/part={part}")
    path = next(f.path for f in system.get_file_info(fs.FileSelector(name)) if f.base_name.startswith("part-"))
    with system.open_input_file(path) as file:
        row = pq.ParquetFile(file).read(columns=["n", "points", "tree", "reps", "copies"]).to_pylist()[0]
    x = _normal(np.frombuffer(row["points"], kind).reshape(row["n"], size))
    return x, pickle.loads(row["tree"]), np.frombuffer(row["reps"], np.int64), np.frombuffer(row["copies"], np.int64)


def _apart(dots: np.ndarray) -> np.ndarray:
    """Distances of unit vectors."""
    return np.sqrt(np.maximum(0, 2 - 2 * dots))


def open_cells(pivots: np.ndarray, radius: dict[int, float], cosine: float) -> list[tuple[int, int]]:
    """Pairs of cells that may hold a link, either way round: their pivots are no farther apart than both covering radii and
    the threshold's distance together. At most the square of PIVOTS."""
    apart, far = _apart(pivots @ pivots.T), np.sqrt(2 - 2 * cosine)
    return [(c, d) for c in radius for d in radius if c == d or apart[c, d] <= radius[c] + radius[d] + far + ROOT_SLACK]


def open_pairs(roots: DataFrame, cells_of: DataFrame, cells: list[tuple[int, int]], cosine: float) -> DataFrame:
    """(low, high): groups that may hold a link. Of ``roots`` (part, and nearest and farthest distance to each pivot), those
    with cells (part, cell) in an open pair, and no pivot that parts them: by the triangle inequality, two points within the
    threshold are about as far from each pivot."""
    far = float(np.sqrt(2 - 2 * cosine)) + ROOT_SLACK
    opened = roots.sparkSession.createDataFrame(cells, "cell int, facing int")
    low, high = cells_of.select(F.col("part").alias("low"), "cell"), cells_of.select(F.col("part").alias("high"), F.col("cell").alias("facing"))
    pairs = low.join(F.broadcast(opened), "cell").join(high, "facing").where("low <= high").select("low", "high").distinct()
    side = lambda name, mark: roots.select(F.col("part").alias(name), F.col("nearest").alias(f"near_{mark}"), F.col("farthest").alias(f"far_{mark}"))
    reach = lambda a, b: F.forall(F.zip_with(f"near_{a}", f"far_{b}", lambda x, y: x <= y + far), lambda x: x)
    return pairs.join(side("low", "a"), "low").join(side("high", "b"), "high").where(reach("a", "b") & reach("b", "a")).select("low", "high")


def _links(points: DataFrame, size: int, cosine: float, group_points: int) -> tuple[DataFrame, DataFrame]:
    """(rep, n): linked rows counted from other points; (a, b): links that connect every group of linked points."""
    import pickle

    pivots = pivots_of(points, PIVOTS)
    shared = points.sparkSession.sparkContext.broadcast(pivots)  # PIVOTS vectors

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                dots = _units(batch.column(0), size) @ shared.value.T
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(dots.argmax(axis=1).astype(np.int32)), pa.array(_apart(dots.max(axis=1)))], [*batch.schema.names, "cell", "away"])

    kind = _number(points, "vector")
    schema = f"vector array<{kind}>, rep bigint, copies bigint, cell int, away double"
    celled = points.select("vector", "rep", "copies").mapInArrow(assign, schema)
    # cells fill groups of about group_points: small cells share one, and large ones are dealt over several
    cells = celled.groupBy("cell").count().collect()  # PIVOTS rows
    held = {r[0]: r[1] for r in cells}
    first, filled, plan = 0, 0, {}
    for cell in sorted(held):
        if filled and filled + held[cell] > group_points:
            first, filled = first + 1, 0
        spread = -(-held[cell] // group_points)
        plan[cell] = (first, spread)
        filled += held[cell]
        if spread > 1:
            first, filled = first + spread, 0
    start = F.element_at(F.create_map(*[F.lit(x) for c in plan for x in (c, plan[c][0])]), F.col("cell"))
    spread = F.element_at(F.create_map(*[F.lit(x) for c in plan for x in (c, plan[c][1])]), F.col("cell"))
    # vectors are dealt anew here; one that two pivots are as near to may fall to a cell that was empty before
    part = F.coalesce(start + F.pmod(F.xxhash64("rep"), spread), F.lit(0)).cast("int")
    groups = celled.withColumn("part", part)

    def build(key, table):
        x = _units(table.column("vector"), size)
        tree = [{k: v.astype(np.int32) if v.dtype == np.int64 else v for k, v in level.items()} for level in cover_tree(x)]
        apart = _apart(x @ shared.value.T)
        own = table.group_by("cell").aggregate([("away", "max")])
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([key[0].as_py()], pa.int32()),
                "n": [len(x)],
                "reps": [table.column("rep").to_numpy().tobytes()],
                "copies": [table.column("copies").to_numpy().tobytes()],
                "points": [table.column("vector").combine_chunks().flatten().to_numpy().tobytes()],
                "tree": [pickle.dumps(tree)],
                "nearest": [apart.min(axis=0).tolist()],
                "farthest": [apart.max(axis=0).tolist()],
                "cells": pa.array([own.column("cell").to_pylist()], pa.list_(pa.int32())),
                "aways": [own.column("away_max").to_pylist()],
            }
        )

    trees = groups.groupBy("part").applyInArrow(lambda key, table: pa.Table.from_batches(build(key, table)), _TREE_SQL)
    folder = fresh_folder(points.sparkSession, "trees")
    trees.write.partitionBy("part").parquet(folder, compression="zstd")
    trees = points.sparkSession.read.schema(_TREE_SQL).parquet(folder)
    cells_of = trees.select("part", F.explode(F.arrays_zip("cells", "aways")).alias("of")).select("part", F.col("of.cells").alias("cell"), F.col("of.aways").alias("away"))
    radius = {r[0]: r[1] for r in cells_of.groupBy("cell").agg(F.max("away")).collect()}  # PIVOTS rows
    met = open_pairs(trees, cells_of.select("part", "cell"), open_cells(pivots, radius, cosine), cosine)
    # a block of pairs goes to one task, which reads each group of it once
    block = [F.floor(F.col(c) / BLOCK).cast("int").alias(f"{c}_block") for c in ("low", "high")]
    met = stored(met.select("low", "high", *block), "open-pairs")
    blocks = met.select("low_block", "high_block").distinct().count()
    tasks = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(4 * blocks, 10_000))
    met = met.repartition(tasks, "low_block", "high_block").sortWithinPartitions("low_block", "high_block", "low", "high")

    def linked(one: bool, x, tx, rx, cx, y, ty, ry, cy) -> pa.RecordBatch:
        nx, label = np.zeros(len(x), np.int64), np.arange(len(x) + (0 if one else len(y)))
        ny = nx if one else np.zeros(len(y), np.int64)
        for i, j in near_pairs(x, tx, y, ty, cosine):
            if one:
                i, j = i[i < j], j[i < j]
            nx += np.bincount(i, cy[j], len(x)).astype(np.int64)
            ny += np.bincount(j, cx[i], len(y)).astype(np.int64)
            u, v = label[i], label[j if one else j + len(x)]
            label = merged(u, v, len(label))[label]
        reps, n = (rx, nx) if one else (np.r_[rx, ry], np.r_[nx, ny])
        out = pa.RecordBatch.from_pydict({"rep": pa.array(reps), "n": pa.array(n), "a": pa.array(reps[label])})
        return out.filter(pa.array(n > 0))

    def join(batches):
        held: dict[int, tuple] = {}

        def group(part: int) -> tuple:
            held[part] = held.pop(part, None) or _read_group(folder, part, size, f"<f{4 if kind == 'float' else 8}")
            if len(held) > 2 * BLOCK:
                held.pop(next(iter(held)))
            return held[part]

        for batch in batches:
            for low, high in zip(batch.column("low").to_pylist(), batch.column("high").to_pylist(), strict=True):
                yield linked(low == high, *group(low), *group(high))

    made = stored(met.select("low", "high").mapInArrow(join, "rep bigint, n bigint, a bigint"), "vector-links")
    return made.select("rep", "n"), made.where("rep <> a").select("a", F.col("rep").alias("b"))
