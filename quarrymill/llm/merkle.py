"""A manifest of a dataset: Merkle trees over its rows, kept as a table of nodes, with a proof for each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.operators.lineage import Scratch

#: Binary levels from one stored level of the node store to the next; a stored row is a run of 2 ** BAND nodes.
BAND = 10


def hashed(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(*values: Column) -> Column:
    """Each value as its number of UTF-8 bytes, a colon and the value, null as a dash."""
    texts = [v.cast("string") for v in values]
    return hashed(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def tree_key(group: Column) -> Column:
    """A key without nulls, in the order of the groups: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def positioned(rows: DataFrame, scratch: Scratch, *order: Column) -> DataFrame:
    """The rows with ``pos``, their place within ``tree`` from 0, and ``n``, the tree's rows.

    The rows are written as sorted runs, a file each; a row's place is that in its file and the sizes of the tree's runs before it.
    Equal rows are told apart by where they were read, so that many of them don't stand in one run.
    """
    runs = scratch.keep(rows.withColumn("_from", F.monotonically_increasing_id()).orderBy("tree", *order, "_from").drop("_from"))
    placed = runs.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    sizes = placed.groupBy("tree", "_file").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    by_run = Window.partitionBy("tree").orderBy(F.regexp_extract("_file", r"part-(\d+)", 1).cast("long"), "_file")
    before = F.coalesce(F.sum("_n").over(by_run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = sizes.select("tree", "_file", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(Window.partitionBy("tree")).alias("n"))
    return placed.join(shifts, ["tree", "_file"]).select(*runs.columns, (F.col("_at") + F.col("_shift")).alias("pos"), "n")


def binary_levels(n: Column) -> Column:
    """Binary levels above n nodes, BAND at most."""
    return F.when(n > 1, F.least(F.length(F.bin(n - 1)), F.lit(BAND))).otherwise(0)


def parents(nodes: Column) -> Column:
    """Two neighbours become the digest of both, one that is left over the digest of itself."""
    pairs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int"))
    return F.transform(pairs, lambda i: hashed(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit(""))))


def with_levels(runs: DataFrame) -> DataFrame:
    """Adds ``up``, the binary levels above this run in its tree, and the run's nodes on each as v0 to vBAND; after ``up`` levels they stay."""
    out = runs.withColumn("up", binary_levels(F.col("n"))).withColumn("v0", F.transform("members", lambda m: m["digest"]))
    for k in range(BAND):
        out = out.withColumn(f"v{k + 1}", F.when(F.col("up") > k, parents(F.col(f"v{k}"))).otherwise(F.col(f"v{k}")))
    return out


def build(nodes: DataFrame, scratch: Scratch) -> tuple[list[DataFrame], DataFrame]:
    """The node store's levels, and the top of each tree (tree, digest).

    ``nodes`` has tree, pos, n, digest and row. A level is written as runs of 2 ** BAND nodes by coordinate (tree, block) and read again for
    the next, which has a node for each run. The rounds are the logarithm of the largest tree; a run is all that a task holds.
    """
    levels, most = [], None
    while True:
        members = F.array_sort(F.collect_list(F.struct("pos", "digest", "row"))).alias("members")
        level = scratch.keep(nodes.groupBy("tree", F.shiftright("pos", BAND).alias("block")).agg(F.max("n").alias("n"), members))
        levels.append(level)
        if most is None:
            most = level.agg(F.max("n")).first()[0] or 0
        top = with_levels(level).select("tree", F.col("block").alias("pos"), F.ceil(F.col("n") / 2 ** F.lit(BAND)).cast("long").alias("n"), F.get(f"v{BAND}", F.lit(0)).alias("digest"))
        if most <= 1 << BAND:
            return levels, top.select("tree", "digest")
        most = -(-most // (1 << BAND))
        nodes = top.withColumn("row", F.lit(None).cast("boolean"))


def steps(i: Column) -> Column:
    """Of the i-th node of a run, within the run: < or > and the sibling to the left or right, or empty where the node has none."""
    stored = F.array(*[F.col(f"v{k}") for k in range(BAND)])

    def step(k: Column) -> Column:
        at = F.floor(i / F.pow(F.lit(2), k)).cast("int")
        sibling = F.get(F.get(stored, k), at.bitwiseXOR(F.lit(1)))
        return F.coalesce(F.concat(F.when(at % 2 == 1, "<").otherwise(">"), sibling), F.lit(""))

    return F.slice(F.transform(F.sequence(F.lit(0), F.lit(BAND - 1)), step), F.lit(1), F.col("up"))


def proofs(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The members of the lowest level (tree, pos, digest, row) with ``proof`` and the further columns of ``above``.

    ``above`` has tree, the proof of the tree's top, and columns that all its members get. From the highest level down, runs meet the
    proofs of their tops by coordinate; the steps within a run come from its own nodes.
    """
    carried = [c for c in above.columns if c not in ("tree", "proof")]
    above = above.withColumn("block", F.lit(0).cast("long"))
    for level in reversed(levels):
        held = with_levels(level).join(above, ["tree", "block"])
        members = F.transform("members", lambda m, i: F.struct(m["pos"].alias("pos"), m["digest"].alias("digest"), m["row"].alias("row"), F.concat(steps(i), F.col("proof")).alias("proof")))
        out = held.select("tree", F.explode(members).alias("m"), *carried).select("tree", "m.*", *carried)
        above = out.select("tree", F.col("pos").alias("block"), "proof", *carried)
    return out


def merkle_manifest(rows: DataFrame, group: Column, order: Column, digest: Column) -> DataFrame:
    """The rows with ``leaf``, ``subroot`` (of their group's tree), ``root`` (of the tree over the subroots) and ``proof``.

    A group's leaves ascend by ``order`` (nulls first), then by digest; while there are several nodes, each two neighbours become the SHA-256 of
    both, and one left over that of itself, all as lowercase hex. Subroots ascend by group, null first. ``digest`` is a row's leaf.

    Repeated rows have a leaf each. A null group is a group, a null order comes first; empty tables give no rows. Input columns
    of the new names are replaced. A group of any size is cut into runs; a few bytes a row are shuffled, not the whole rows unless the
    caller keeps them: choose the columns before.
    """
    scratch = Scratch(rows.sparkSession)
    kept = F.struct(*[rows[f"`{c}`"] for c in rows.columns])
    leaves = positioned(rows.select(tree_key(group).alias("tree"), order.alias("_order"), digest.alias("digest"), kept.alias("row")), scratch, F.col("_order"), F.col("digest"))
    levels, tops = build(leaves.drop("_order"), scratch)
    tops = tops.select(F.lit("").alias("tree"), F.col("tree").alias("_of"), "digest").withColumn("row", F.struct("_of")).drop("_of")
    over, root = build(positioned(tops, scratch, F.col("row._of")), scratch)
    above = root.select("tree", F.array().cast("array<string>").alias("proof"), F.col("digest").alias("root"))
    subroots = proofs(over, above).select(F.col("row._of").alias("tree"), "proof", F.col("digest").alias("subroot"), "root")
    out = proofs(levels, subroots)
    new = {"leaf": F.col("digest"), "subroot": F.col("subroot"), "root": F.col("root"), "proof": F.col("proof")}
    return out.select(*[F.col("row").getField(c).alias(c) for c in rows.columns if c not in new], *[v.alias(k) for k, v in new.items()])


def siblings(proof: Column) -> Column:
    """The digests of a proof, in order."""
    return F.transform(F.filter(proof, lambda s: s != ""), lambda s: F.substring(s, 2, 64))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that leaf and proof give."""

    def step(node: Column, s: Column) -> Column:
        other = F.substring(s, 2, 64)
        return hashed(F.when(F.startswith(s, F.lit("<")), other).otherwise(F.lit("")), node, F.when(F.startswith(s, F.lit(">")), other).otherwise(F.lit("")))

    return F.aggregate(proof, leaf, step)
