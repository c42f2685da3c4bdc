"""Merkle dataset manifest: one tree a group, a tree over their roots, and inclusion proofs found by pointer jumping."""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygrid.llm.common import written

# Joins deal leaves out by blocks of so many bits: no key of any join has more rows.
BLOCK_BITS = 6
_ROW_BITS = 33  # of monotonically_increasing_id


def encoded(*columns: Column) -> Column:
    """Columns as one string that can be cut again: ``-`` for null, else byte count, colon and value."""
    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.concat(*map(one, columns))


def digest(text: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def hex_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def height(n: Column | str) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves."""
    n = F.col(n) if isinstance(n, str) else n
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1))).cast("int")


def _by_block(df: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """A row for each number from ``first`` to ``last``, in two steps, so that no array is long."""
    far = df.withColumn("_first", first).withColumn("_last", last)
    far = far.withColumn("_far", F.explode(F.sequence(F.shiftright("_first", 10), F.shiftright("_last", 10))))
    near = F.sequence(F.greatest("_first", F.shiftleft("_far", 10)), F.least("_last", F.shiftleft("_far", 10) + 1023))
    return far.withColumn(name, F.explode(near)).drop("_first", "_last", "_far")


def _numbered(leaves: DataFrame, group_col: str, order_cols: list[str], leaf_col: str) -> tuple[DataFrame, int, int]:
    """tree, n, idx, digest, own of every leaf; the number of trees and the largest height.

    One range sort places all leaves. Each range counts its rows by group, and sums of these counts, as many as there are
    ranges, say where a range begins; no window runs over leaves.
    """
    own = F.struct(*[F.col(c) for c in leaves.columns])
    rows = written(leaves.select(own.alias("own"), F.monotonically_increasing_id().alias("seq")), "leaves")
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())
    keys = [F.col(f"own.`{c}`") for c in [group_col, *order_cols, leaf_col]] + [F.col("seq")]
    at = written(rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select(
        F.col(f"own.`{group_col}`").cast("string").alias("grp"), "own", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1).alias("row")), "sorted-leaves")

    pieces = written(at.groupBy("part", "grp").agg(F.min("row").alias("f"), F.count(F.lit(1)).alias("c")), "pieces")
    groups = pieces.groupBy("grp").agg(F.min("part").alias("part"), F.sum("c").alias("n"))
    begins = (pieces.alias("p").join(groups.alias("g"), F.expr("p.grp <=> g.grp and p.part = g.part"))
              .select("p.part", "p.grp", "f", "n"))
    # A running sum over the ranges: as many rows as partitions, whatever the leaves.
    per_part = (pieces.groupBy("part").agg(F.sum("c").alias("rows"))
                .join(begins.groupBy("part").agg(F.count(F.lit(1)).alias("new")), "part", "left"))
    before = per_part.selectExpr("part", "sum(rows) over (order by part) - rows as rows_before",
                                 "sum(coalesce(new, 0)) over (order by part) - coalesce(new, 0) as groups_before")
    trees = begins.join(before, "part").selectExpr(
        "grp", "n", "rows_before + f as start", "groups_before + row_number() over (partition by part order by f) - 1 as tree")
    where = pieces.join(before, "part").alias("p").join(trees.alias("t"), F.expr("p.grp <=> t.grp"))
    where = written(where.selectExpr("p.part", "p.grp", "f", "c", "tree", "n", "rows_before - start as shift"), "places")
    facts = where.agg(F.max("tree"), F.max(height("n"))).first()

    spread = _by_block(where, F.shiftright(F.col("f"), BLOCK_BITS), F.shiftright(F.col("f") + F.col("c") - 1, BLOCK_BITS), "block")
    met = (at.withColumn("block", F.shiftright("row", BLOCK_BITS)).alias("a")
           .join(spread.alias("w"), F.expr("a.part = w.part and a.block = w.block and a.grp <=> w.grp")))
    found = met.select("tree", "n", (F.col("row") + F.col("shift")).alias("idx"), F.col(f"own.`{leaf_col}`").alias("digest"), "own")
    return (found, 0, 0) if facts[0] is None else (found, facts[0] + 1, facts[1])


def _climb(base: int, span: int):
    """Of one block of nodes on level ``base``: the siblings of each on the next ``span`` levels, and the node on top."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        n, first = table["n"][0].as_py(), table["idx"][0].as_py()
        top = min(base + span, (n - 1).bit_length())
        nodes = [table["digest"].to_pylist()]
        for _ in range(top - base):
            low = [d.hex().encode() for d in nodes[-1]]
            nodes.append([sha256(b"".join(low[k:k + 2])).digest() for k in range(0, len(low), 2)])
        siblings = [[level[(k >> up) ^ 1] if (k >> up) ^ 1 < len(level) else None for up, level in enumerate(nodes[:-1])]
                    for k in range(len(nodes[0]))]
        size, own = table.num_rows, table["own"].combine_chunks()
        own = pa.concat_arrays([own, pa.nulls(1, own.type)])
        return pa.table({
            "tree": pa.concat_arrays([table["tree"].combine_chunks(), table["tree"].combine_chunks()[:1]]),
            "n": pa.array([n] * (size + 1), pa.int64()),
            "level": pa.array([base] * size + [top], pa.int32()),
            "idx": pa.array(table["idx"].to_pylist() + [first >> (top - base)], pa.int64()),
            "digest": pa.array([None] * size + [nodes[-1][0]], pa.binary()),
            "siblings": pa.array(siblings + [None], pa.list_(pa.binary())),
            "own": own})
    return run


def _grown(leaves: DataFrame, tallest: int, span: int) -> tuple[DataFrame, DataFrame]:
    """Nodes on every ``span``-th level with their first ``span`` siblings, and the roots (tree, n, digest)."""
    fields = [f if f.name != "own" else T.StructField("own", f.dataType, True) for f in leaves.schema.fields]
    by = {f.name: f for f in fields}
    out = T.StructType([by["tree"], by["n"], T.StructField("level", T.IntegerType()), by["idx"], T.StructField("digest", T.BinaryType()),
                        T.StructField("siblings", T.ArrayType(T.BinaryType())), by["own"]])
    nodes, tops, at, base = None, None, leaves, 0
    while nodes is None or base < tallest:
        step = written(at.groupBy("tree", F.shiftright("idx", span)).applyInArrow(_climb(base, span), out), "tree-levels")
        here = step.where("digest is null").drop("digest")
        done = step.where("digest is not null")
        nodes, tops = (here, done) if nodes is None else (nodes.union(here), tops.union(done))
        base += span
        at = done.where(F.col("level") < height("n")).drop("level", "siblings")
    return nodes, tops.where(F.col("level") == height("n")).select("tree", "n", "digest")


def _jumped(nodes: DataFrame, tallest: int, span: int) -> DataFrame:
    """Leaves with their siblings up to the root.

    Every node holds the siblings on its way to the ancestor ``reach`` levels up. A self-join appends the ancestor's own
    segment, which doubles the reach. Levels that are no multiple of the new reach are never asked again and go.
    An ancestor is copied for each block of the nodes below it, so a key never has more than a block of them.
    """
    reach = span
    while reach < tallest:
        bits = min(reach, BLOCK_BITS)
        asks = nodes.where(F.col("level") % (2 * reach) == 0)
        gives = nodes.where(F.col("level") % (2 * reach) == reach).select("tree", "n", "level", "idx", F.col("siblings").alias("more"))
        last = F.shiftright(F.expr(f"shiftright(n - 1, level - {reach})"), bits)
        gives = _by_block(gives, F.shiftleft("idx", reach - bits),
                          F.least(F.shiftleft(F.col("idx") + 1, reach - bits) - 1, last), "block")
        gives = gives.select("tree", (F.col("level") - reach).alias("level"), "block", "more")
        met = asks.withColumn("block", F.shiftright("idx", bits)).join(gives, ["tree", "level", "block"], "left")
        nodes = met.select("tree", "n", "level", "idx",
                           F.concat("siblings", F.coalesce("more", F.array().cast("array<binary>"))).alias("siblings"), "own")
        reach *= 2
        if reach < tallest:
            nodes = written(nodes, "segments")
    return nodes.where("level = 0")


def merkle_manifest(leaves: DataFrame, *, group_col: str, order_cols: list[str], leaf_col: str = "leaf", span: int = 8) -> DataFrame:
    """``leaves`` with subroot, root, siblings and path: a proof that each leaf belongs to the manifest.

    ``leaf_col`` holds digests of 32 bytes. The leaves of a group, in the order of ``order_cols`` (nulls first; ties by
    digest), are hashed in runs of two, level by level, until one node is left; a last run may be a single node. These
    subroots, by group (null first, bytewise), are hashed alike. ``siblings`` lists the other node of each run from the leaf
    upwards, null where there is none, through the subroot to the root; bit k of ``path`` says whether the node is the right one there.

    1. A range sort numbers the leaves of each group. 2. Blocks of 2**span nodes are hashed, each a small group of its own, and
    their tops are the leaves of the next step; each node starts with its siblings inside the block. 3. Pointer jumping doubles
    the distance to the known ancestor by self-joins until every leaf holds its way to the root of its tree. 4. The way from
    the subroot to the root is found likewise and appended.

    Any number of groups, one group of all rows, groups of one leaf, repeated rows and null ids are fine; equal leaves are
    leaves of their own. An empty table gives an empty one. Input columns of the added names are replaced.
    """
    added = ("subroot", "root", "siblings", "path")
    given = leaves.drop(*[c for c in leaves.columns if c.lower() in added])
    numbered, n_trees, tallest = _numbered(given, group_col, order_cols, leaf_col)
    nodes, roots = _grown(numbered, tallest, span)
    above = roots.select(F.lit(-1).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("n"), F.col("tree").cast("long").alias("idx"), "digest",
                         F.lit(None).cast("struct<unused:int>").alias("own"))
    over = (n_trees - 1).bit_length() if n_trees else 0
    top_nodes, top = _grown(above, over, span)
    found = top.first()
    root = F.lit(None if found is None else bytes(found["digest"])).cast("binary")
    ways = (_jumped(top_nodes, over, span).select(F.col("idx").alias("tree"), F.col("siblings").alias("more"))
            .join(roots.withColumnRenamed("digest", "subroot"), "tree"))
    ways = _by_block(ways, F.lit(0).cast("long"), F.shiftright(F.col("n") - 1, BLOCK_BITS), "block").drop("n")
    paths = _jumped(nodes, tallest, span).withColumn("block", F.shiftright("idx", BLOCK_BITS)).join(ways, ["tree", "block"])
    return paths.select("own.*", "subroot", root.alias("root"), F.concat("siblings", "more").alias("siblings"),
                        F.col("idx").bitwiseOR(F.call_function("shiftleft", F.col("tree").cast("long"), height("n"))).alias("path"))


def folded(leaf: Column, siblings: Column, path: Column) -> Column:
    """The root as hex that a leaf's digest gives with the siblings of a proof."""
    turns = F.transform(siblings, lambda s, k: F.struct(hex_text(s).alias("s"), (F.call_function("shiftright", path, k) % 2 == 1).alias("right")))
    return F.aggregate(turns, hex_text(leaf), lambda now, x: F.sha2(
        F.when(x["s"].isNull(), now).when(x["right"], F.concat(x["s"], now)).otherwise(F.concat(now, x["s"])), 256))


def proof_digest(siblings: Column) -> Column:
    """SHA-256, as hex, of the siblings' hex digests in a row."""
    return F.sha2(F.array_join(F.transform(siblings, hex_text), ""), 256)
