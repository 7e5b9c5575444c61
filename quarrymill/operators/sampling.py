"""Weights, batches and shares of samples."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.operators.lineage import Scratch
from quarrymill.operators.ranks import placed
from quarrymill.sources.ship import ship

#: Rows of a block of prefix sums, and draws that a task looks up in one.
BLOCK = 1 << 16
#: Weights are whole numbers of this part, so that sums are exact in any order.
UNIT = 1 << 20


def sample_weights(df: DataFrame, task: str, family: str, task_weight: Column) -> DataFrame:
    """``weight``: the task's, divided by the number of rows of the family in it; a family weighs the same whatever its size."""
    sizes = df.groupBy(task, family).agg(F.count("*").alias("_n"))
    return df.join(sizes, [task, family]).withColumn("weight", task_weight / F.col("_n")).drop("_n")


def weighted_sample(df: DataFrame, ident: str, weight: str, n: int, seed: int = 0) -> DataFrame:
    """n rows without replacement, by the largest of u ** (1 / weight), u from a hash of id and seed: the same rows in any plan."""
    u = (F.xxhash64(F.lit(seed), F.col(ident)).bitwiseAND(F.lit(2**52 - 1)) + 1) / float(2**52 + 1)
    return df.where(F.col(weight) > 0).withColumn("_key", F.log(u) / F.col(weight)).orderBy(F.desc("_key"), ident).limit(n).drop("_key")


def weighted_draws(df: DataFrame, ident: str, weight: str, n: int, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """n rows ``draw`` (0 to n - 1) and ident: draws with replacement, each row as likely as its weight; the same in any plan.

    Rows stand in the order of their ids on a line of whole numbers, each as long as its weight; draw k is the row at a place that a hash of
    seed and k picks. Blocks of rows are found by their first places, a number a block, which all tasks get: eight bytes for each ``block`` rows.
    A block's draws go to as many tasks as they need, each with the block's rows, so that a row with a third of all weight is no bottleneck.

    Weights that are null, not finite or under half of 1 / UNIT count as none; without any weight there are no draws. Weights may sum to 2 ** 42, at 60 bits of hash.
    Repeated ids are rows of their own.
    """
    spark, scratch = df.sparkSession, Scratch(df.sparkSession)
    w = F.col(weight).cast("double")
    units = F.when(w.isNotNull() & ~F.isnan(w) & (w < float("inf")), F.round(w * UNIT)).otherwise(0.0).cast("long")
    rows = df.select(F.col(ident), units.alias("_w"), F.lit(0).alias("_all")).where("_w > 0")
    line = scratch.keep(placed(rows, scratch, "_all", [F.col(ident)], "_w").select(ident, "_w", "before", F.floor(F.col("pos") / block).cast("long").alias("_block")))
    total, blocks = line.agg(F.sum("_w"), F.max("_block")).first()
    firsts = [r[0] for r in line.groupBy("_block").agg(F.min("before").alias("b")).orderBy("_block").select("b").collect()]  # a number a block
    kind = df.schema[ident].dataType.simpleString()
    if not total or n <= 0:
        return df.select(F.lit(0).cast("long").alias("draw"), ident).limit(0)
    ship(spark)

    def locate(batches):
        for b in batches:
            found = np.searchsorted(np.array(firsts, np.int64), b.column("at").to_numpy(), side="right") - 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.int64())], names=[*b.schema.names, "_block"])

    places = spark.range(n).select(F.col("id").alias("draw"), F.expr(f"(CAST(conv(substring(md5(CAST('{int(seed)}:' || id AS BINARY)), 1, 15), 16, 10) AS DECIMAL(19, 0)) * CAST({total} AS DECIMAL(19, 0))) div {1 << 60}L").alias("at"))
    draws = scratch.keep(places.mapInArrow(locate, "draw long, at long, _block long").withColumn("_part", F.pmod(F.xxhash64("draw"), F.lit(2**31))))
    parts = draws.groupBy("_block").agg(F.ceil(F.count("*") / block).cast("long").alias("_parts"))
    dealt = draws.join(parts, "_block").withColumn("_part", F.pmod(F.col("_part"), F.col("_parts"))).drop("_parts")
    held = line.join(parts, "_block").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).drop("_parts")

    def look_up(rows: pa.Table, asked: pa.Table) -> pa.Table:
        rows = rows.sort_by("before")
        at = np.searchsorted(rows["before"].to_numpy(), asked["at"].to_numpy(), side="right") - 1
        return pa.table({"draw": asked["draw"], ident: rows[ident].take(pa.array(at, pa.int64()))})

    keys = ["_block", "_part"]
    return held.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(look_up, f"draw long, `{ident}` {kind}")


def claimed_negatives(df: DataFrame, ident: str, negatives: str, most: int, seed: int = 0) -> DataFrame:
    """Columns ident, anchor, place: each row once, with the anchor that it stands with (itself at place 0).

    In the order of a hash of seed and id, a row that none has claimed becomes an anchor and claims its ``negatives`` (an array of ids) that are
    still free, in their order, ``most`` of them at most. That is settled in rounds: a row acts as soon as no undecided row before it could claim
    it or one of its negatives, and all such rows act at once. As the order is random, a chain of n claims takes a number of
    rounds in proportion to the square of log n, not n. Negatives that are null, unknown, repeated or the row itself count as none; null ids have
    no part in it, and repeated ids are an error.
    """
    scratch = Scratch(df.sparkSession)
    known = df.where(F.col(ident).isNotNull()).select(F.col(ident).alias("a"), negatives)
    order = lambda c: F.struct(F.xxhash64(F.lit(seed), c), c)
    listed = known.select("a", F.posexplode(negatives).alias("rank", "x")).where("x is not null and x <> a").groupBy("a", "x").agg(F.min("rank").alias("rank"))
    edges = scratch.keep(listed.join(known.select(F.col("a").alias("x")), "x", "left_semi").withColumn("o", order(F.col("a"))))
    settled = None
    while not edges.isEmpty():
        ends = edges.select("x", "o").unionAll(edges.select("x", order(F.col("x")))).unionAll(edges.select("a", "o"))
        first = ends.groupBy("x").agg(F.min("o").alias("m"))
        waiting = edges.join(first, "x").where("m <> o").select("a").distinct()
        acting = scratch.keep(first.select(F.col("x").alias("a"), "m").where(F.col("m") == order(F.col("a"))).select("a").join(waiting, "a", "left_anti"))
        rank = F.row_number().over(Window.partitionBy("a").orderBy("rank"))
        claims = edges.join(acting, "a", "left_semi").withColumn("place", rank).where(F.col("place") <= most)
        part = scratch.keep(claims.select(F.col("x").alias(ident), F.col("a").alias("anchor"), "place").unionAll(acting.select(F.col("a").alias(ident), F.col("a").alias("anchor"), F.lit(0).alias("place"))))
        settled = part if settled is None else settled.unionAll(part)
        gone = part.select(F.col(ident).alias("x"))
        done, edges = edges, scratch.keep(edges.join(gone, "x", "left_anti").join(gone.select(F.col("x").alias("a")), "a", "left_anti"))
        scratch.drop(done, acting)
    alone = known.select(F.col("a").alias(ident))
    if settled is not None:
        alone = alone.join(settled.select(ident), ident, "left_anti")
    singles = alone.select(ident, F.col(ident).alias("anchor"), F.lit(0).alias("place"))
    return singles if settled is None else settled.unionAll(singles)


def hard_negative_batches(df: DataFrame, ident: str, negatives: str, size: int, seed: int = 0) -> DataFrame:
    """Columns ident, anchor, place, batch: anchors with the negatives that they have claimed, in batches of ``size`` rows at most, filled in the
    order of the anchors' hashes; an anchor and its negatives are never divided."""
    from quarrymill.sources.sinks import filled_shards

    rows = claimed_negatives(df, ident, negatives, size - 1, seed)
    units = rows.groupBy("anchor").agg(F.count("*").alias("n")).withColumn("_all", F.lit("all"))
    filled = filled_shards(units, "_all", [F.xxhash64(F.lit(seed), F.col("anchor")), F.col("anchor")], "n", size, size)
    return rows.join(filled.select("anchor", F.col("shard").alias("batch")), "anchor").select(ident, "anchor", "place", "batch")


def batches(df: DataFrame, keys: list[str], order: list[Column], size: int) -> DataFrame:
    """``batch``: rows of equal keys, numbered in this order, by ``size``."""
    return df.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1) / size).cast("long"))


def worker_share(ident: Column, workers: int) -> Column:
    """The worker that gets the row, by a hash of its id: even, and the same in every run, without numbering all rows."""
    return F.pmod(F.conv(F.substring(F.sha2(ident.cast("string"), 256), 1, 8), 16, 10).cast("long"), F.lit(workers)).cast("int")
