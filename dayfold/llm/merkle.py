"""A Merkle manifest of a table: a hash for every row, a tree over them for each part, one root for all, and proofs.

Digests are lower-case hex of SHA-256; those of several inputs are taken of the inputs end to end. A row's leaf is the
digest of its fields, each as ``-`` where it is NULL, else as the bytes of its UTF-8 text, ``:``, and the text. The leaves
of a part stand in the order of ``order_by`` (NULL first, ties by digest), and every two neighbours become the digest of
both; one that is left over at the end becomes the digest of itself. The roots of the parts, NULL first and then by the
bytes of their names, make one more tree in the same way, whose root is that of the table.

Levels are built eight at a time: ``STRIDE`` levels above up to 256 neighbours are the work of one row, so that a tree of
n leaves takes log256(n) passes, each over a 256th of the one before. A stored node knows its parent eight levels up and
the siblings on the way there. A proof is read by a recursive query that climbs these links from every leaf.

Defined cases: an empty table has no leaves and no root. Rows that repeat each other wholly are leaves of their own. A
part of one leaf has this leaf as its root, and a table of one part has the root of this part.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayfold.llm.common import attached, stored

#: Levels that one pass builds and one step of a proof climbs.
STRIDE = 8

#: The tree over the parts' roots. The names of the parts' own trees are empty or begin with another sign.
TOP = "*"

PATH = "array<struct<is_left: boolean, digest: string>>"


@dataclass(frozen=True)
class Manifest:
    """``leaves``: key, leaf, claimed, tree, path, parent; ``nodes``: id, path, parent; ``roots``: tree, subroot;
    ``root``: of the table, NULL for an empty one.

    ``path`` holds the siblings up to the parent, with the side they stand on, and an empty text where there is none.
    """

    leaves: DataFrame
    nodes: DataFrame
    roots: DataFrame
    root: str | None


def leaf_digest(fields: Sequence[Column]) -> Column:
    """The leaf of a row with these fields."""
    texts = [f.cast("string") for f in fields]
    written = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*written), 256)


def build(rows: DataFrame, key: str, part: str, fields: Sequence[Column], claimed: Sequence[Column] | None = None) -> Manifest:
    """The manifest of ``rows``, with a tree for each value of ``part`` over its rows in the order of ``key``.

    ``claimed`` are the fields as someone else has them; a proof starts from their digest.
    """
    leaf = leaf_digest(fields)
    tree = F.coalesce(F.concat(F.lit("="), F.col(part).cast("string")), F.lit(""))
    bare = rows.select(
        F.col(key).alias("key"),
        tree.alias("tree"),
        leaf.alias("digest"),
        (leaf_digest(claimed) if claimed else leaf).alias("claimed"),
    )
    strata = _strata(_placed(bare, ["tree"], ["key", "digest", "claimed"]), "parts")
    roots = stored(_roots(strata).select("tree", F.col("digest").alias("subroot")), "merkle-roots")
    up = F.concat(F.lit("top/"), F.col("tree"))
    first = _linked(strata[0], 0, up).select("key", F.col("digest").alias("leaf"), "claimed", "tree", "path", "parent")
    nodes = [_linked(s, i, up).select("id", "path", "parent") for i, s in enumerate(strata) if i]

    parts = roots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("key"), F.col("subroot").alias("digest"))
    top = _strata(_placed(parts, ["tree"], ["key"]), "top")
    name = F.concat(F.lit("top/"), F.col("key"))
    for i, s in enumerate(top):
        nodes.append(_linked(s, i, F.lit(None).cast("string"), None if i else name).select("id", "path", "parent"))
    found = _roots(top).select("digest").first()
    joined = nodes[0]
    for more in nodes[1:]:
        joined = joined.union(more)
    return Manifest(first, stored(joined, "merkle-nodes"), roots, found.digest if found else None)


def _placed(rows: DataFrame, groups: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, their place within their group from 0, and ``size``, the rows of the group.

    Rows are dealt out in ranges, so a group may take any number of tasks: places are counted within these, and the
    counts of the tasks before are added, of which there are as many as tasks and groups at most.
    """
    by = [*groups, *order]
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    dealt = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), "merkle-sorted")
    dealt = dealt.withColumn("_task", F.shiftright("_at", 33))
    counts = dealt.groupBy(*groups, "_task").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    group = Window.partitionBy(*groups)
    before = F.sum("_rows").over(group.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(
        *groups,
        "_task",
        (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(group).alias("size"),
    )
    placed = attached(dealt, stored(counts, "merkle-counts"), [*groups, "_task"], "inner")
    return placed.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_task", "_shift")


def _strata(leaves: DataFrame, purpose: str) -> list[DataFrame]:
    """Nodes of every eighth level from the leaves up: the columns of ``leaves``, ``path``, and ``above``, the digest of
    the node eight levels up or of the tree's root."""
    strata = []
    while True:
        rows = stored(_stratum(leaves), f"merkle-{purpose}")
        strata.append(rows)
        if (rows.agg(F.max("size")).first()[0] or 0) <= 1 << STRIDE:
            return strata
        leaves = rows.where(F.col("size") > 1 << STRIDE).where(F.col("pos") % (1 << STRIDE) == 0).select(
            "tree",
            F.shiftright("pos", STRIDE).alias("pos"),
            F.shiftright(F.col("size") + ((1 << STRIDE) - 1), STRIDE).alias("size"),
            F.col("above").alias("digest"),
        )


def _stratum(leaves: DataFrame) -> DataFrame:
    """One pass: up to 256 neighbours become one row, the levels above are made in it, and they become rows again."""
    own = [c for c in leaves.columns if c not in ("tree", "size")]
    blocks = leaves.groupBy("tree", "size", F.shiftright("pos", STRIDE).alias("_block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", *(c for c in own if c != "pos")))).alias("_rows")
    )
    height = F.when(F.col("size") <= 1, 0).otherwise(F.length(F.bin(F.col("size") - 1)))
    blocks = blocks.withColumn("_steps", F.least(F.lit(STRIDE), height).cast("int")).withColumn(
        "_levels",
        F.expr(
            """aggregate(
                 if(_steps = 0, cast(array() as array<int>), sequence(1, _steps)),
                 array(transform(_rows, r -> r.digest)),
                 (levels, n) -> concat(levels, array(transform(
                   sequence(0, cast((size(levels[n - 1]) + 1) div 2 as int) - 1),
                   i -> sha2(concat(levels[n - 1][2 * i], coalesce(get(levels[n - 1], 2 * i + 1), '')), 256)))))"""
        ),
    )
    path = F.expr(
        """if(_steps = 0, array(), transform(sequence(0, _steps - 1), n -> named_struct(
             'is_left', shiftright(_i, n) % 2 = 1,
             'digest', coalesce(get(get(_levels, n), shiftright(_i, n) ^ 1), ''))))"""
    ).cast(PATH)
    flat = blocks.select("tree", "size", "_steps", "_levels", F.posexplode("_rows").alias("_i", "_row"))
    return flat.select(
        "tree",
        "size",
        *(F.col(f"_row.{c}").alias(c) for c in own),
        path.alias("path"),
        F.expr("_levels[_steps][0]").alias("above"),
    )


def _linked(stratum: DataFrame, number: int, after_root: Column, name: Column | None = None) -> DataFrame:
    """``stratum`` with the id of each node and that of its parent; ``after_root`` is the parent of a tree's root."""

    def node(level: int, pos: Column) -> Column:
        return F.concat_ws("/", F.lit(str(level)), pos.cast("string"), F.col("tree"))

    own = node(number, F.col("pos")) if name is None else name
    parent = F.when(F.col("size") > 1 << STRIDE, node(number + 1, F.shiftright("pos", STRIDE))).otherwise(after_root)
    return stratum.withColumn("id", own).withColumn("parent", parent)


def _roots(strata: list[DataFrame]) -> DataFrame:
    """(tree, digest) of each tree's root."""
    found = None
    for s in strata:
        here = s.where((F.col("size") <= 1 << STRIDE) & (F.col("pos") == 0)).select("tree", F.col("above").alias("digest"))
        found = here if found is None else found.union(here)
    return found


def proofs(manifest: Manifest) -> DataFrame:
    """For every leaf the siblings on its way to the table's root, and the root that its claimed digest leads to.

    Returns key, leaf, tree, ``proof`` (the siblings' digests as bytes, end to end) and ``folded_root``. The recursive
    query holds one step of every leaf at a time, so its rows are those of the table; it takes one round for every eight
    levels. Node rows are a 256th of the leaves, and Spark chooses how to join them by their size.
    """
    fold = "aggregate({path}, {start}, (h, s) -> sha2(if(s.is_left, concat(s.digest, h), concat(h, s.digest)), 256))"
    seen = "unhex(concat_ws('', transform({path}, s -> s.digest)))"
    climb = f"""
        WITH RECURSIVE climb (key, leaf, tree, at, folded, proof) AS (
          SELECT key, leaf, tree, parent, {fold.format(path='path', start='claimed')}, {seen.format(path='path')}
          FROM {{leaves}}
          UNION ALL
          SELECT c.key, c.leaf, c.tree, n.parent, {fold.format(path='n.path', start='c.folded')},
                 concat(c.proof, {seen.format(path='n.path')})
          FROM climb AS c JOIN {{nodes}} AS n ON c.at = n.id
        )
        SELECT key, leaf, tree, proof, folded AS folded_root FROM climb WHERE at IS NULL LIMIT ALL"""
    return manifest.leaves.sparkSession.sql(climb, leaves=manifest.leaves, nodes=manifest.nodes)


def audit(manifest: Manifest) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root and verified (the folded root is the root) of every leaf."""
    found = attached(proofs(manifest), manifest.roots, "tree", "inner")
    root = F.lit(manifest.root).cast("string")
    return found.select(
        "key",
        "leaf",
        "subroot",
        root.alias("root"),
        F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"),
        "folded_root",
        F.coalesce(F.col("folded_root") == root, F.lit(False)).alias("verified"),
    )
