"""Pairs of texts with similar sets of shingles, between classes of equal texts: what copies and rare shingles leave to be compared."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.functions.text import shingles, space_tokens
from quarrymill.operators.lineage import Scratch
from quarrymill.sources.ship import ship

#: Cells of the tables that count shingles by their hashes. They order shingles by rarity and show which ones the other side can't have, so their fixed
#: size bounds what the driver and each task hold and costs no pair.
CELLS = 1 << 20
#: Rows that a task sorts at once.
SLICE = 512


def shingle_sets(texts: DataFrame, ident: str, text: str, width: int, by_set: bool = False) -> DataFrame:
    """Columns id, k, s: hashes of the distinct shingles, and the class: a 64-bit hash of the words in order, or of the set alone."""
    worded = texts.select(F.col(ident).alias("id"), space_tokens(F.lower(F.coalesce(text, F.lit("")))).alias("_w"))
    k = F.lit(0).cast("long") if by_set else F.xxhash64(F.array_join("_w", " "))
    sets = worded.select("id", k.alias("k"), shingles("_w", width).alias("_s")).select("id", "k", F.transform("_s", lambda s: F.xxhash64(s)).alias("s"))
    return sets.withColumn("k", F.xxhash64(F.sort_array("s"))) if by_set else sets


def cell_counts(sets: DataFrame) -> np.ndarray:
    """How many of all shingles fall in each of CELLS cells. Each task adds up its own table; at most CELLS rows reach the driver.

    The arrays are not exploded by Spark, which would first ask for their sizes and make each set's words anew for each shingle."""
    ship(sets.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(CELLS, dtype=np.int64)
        for batch in batches:
            table += np.bincount((batch.column(0).flatten().to_numpy() >> 20) & (CELLS - 1), minlength=CELLS)
        cells = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(table[cells])], names=["cell", "n"])

    counted = sets.select("s").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CELLS, dtype=np.int64)
    out[counted.column("cell").to_numpy()] = counted.column("n").to_numpy()
    return out


def rarest(sets: DataFrame, counts: np.ndarray, shared: np.ndarray, least: float) -> DataFrame:
    """Columns s, k, n, room of each set's first n - ceil(least n) + 1 shingles, those first that only this set has, then by counts; the
    former are left out, as they meet none. Room is the number of shingles from this one on."""
    ship(sets.sparkSession)
    held = sets.sparkSession.sparkContext.broadcast((counts, shared))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = held.value
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                sizes = batch.column(1).value_lengths().to_numpy().astype(np.int64)
                flat, rows = batch.column(1).flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
                cells = (flat >> 20) & (CELLS - 1)
                order = np.lexsort((flat, table[cells], known[cells], rows))
                n, room = sizes[rows], (np.cumsum(sizes)[rows] - np.arange(len(flat)))
                taken = (n - room < n - np.ceil(n * least - 1e-9) + 1) & known[cells[order]]
                keys = batch.column(0).to_numpy()[rows[taken]]
                yield pa.RecordBatch.from_arrays([pa.array(flat[order][taken]), pa.array(keys), pa.array(n[taken].astype(np.int32)), pa.array(room[taken].astype(np.int32))], names=["s", "k", "n", "room"])

    return sets.select("k", "s").mapInArrow(run, "s long, k long, n int, room int")


def class_pairs(sides: list[DataFrame], least: float, width: int, scratch: Scratch, by_set: bool = False) -> tuple[DataFrame, list[DataFrame]]:
    """Pairs of classes with a Jaccard similarity of ``least`` or more (columns a, b, n_both, similarity), and the members of each side (id, k, n).

    ``sides`` have columns id and text: one for pairs a < b among its classes, or two for pairs between theirs, where a class that both have
    meets itself. Prefix filter: of two sets that are so similar, the first n - ceil(least n) + 1 shingles by a fixed order hold a
    common one, the first that they share; from there on both must have as many as such a pair shares. Only shingles of prefixes are
    shuffled, once. Then the full sets decide, read again from the texts concerned.
    """
    sets = [shingle_sets(d, "id", "text", width, by_set) for d in sides]
    members = [scratch.keep(x.select("id", "k", F.size("s").alias("n"))) for x in sets]
    counts = [cell_counts(x) for x in sets]
    total = sum(counts)
    keys = None
    for side, x in enumerate(sets):
        shared = counts[1 - side] > 0 if len(sides) > 1 else total > 1
        first = rarest(x, total, shared, least).withColumn("side", F.lit(side))
        keys = first if keys is None else keys.unionAll(first)
    same = Window.partitionBy("s")
    told = "side" if len(sides) > 1 else "k"
    keys = scratch.keep(keys.repartition("s").withColumns({"_low": F.min(told).over(same), "_high": F.max(told).over(same)}).where("_low < _high").drop("_low", "_high").distinct())
    x = keys.where("side = 0").select("s", F.col("k").alias("a"), F.col("n").alias("na"), F.col("room").alias("ra"))
    y = keys.where(F.col("side") == len(sides) - 1).select("s", F.col("k").alias("b"), F.col("n").alias("nb"), F.col("room").alias("rb"))
    met = x.join(y, "s").where(F.least("ra", "rb") * (1 + least) >= least * (F.col("na") + F.col("nb")) - 1e-6)
    met = scratch.keep((met if len(sides) > 1 else met.where("a < b")).select("a", "b").distinct())
    scratch.drop(keys)
    asked = [met.select(F.col("a").alias("k")), met.select(F.col("b").alias("k"))]
    asked = asked if len(sides) > 1 else [asked[0].union(asked[1])]
    found = [scratch.keep(full_sets(*x, width, by_set, scratch)) for x in zip(sides, members, asked, strict=True)]
    a, b = (found[i].select(F.col("k").alias(c), F.col("s").alias(f"_{c}")) for i, c in ((0, "a"), (len(found) - 1, "b")))
    both = met.join(a, "a").join(b, "b").select("a", "b", F.size("_a").alias("_n"), F.size("_b").alias("_m"), F.size(F.array_intersect("_a", "_b")).cast("long").alias("n_both"))
    pairs = scratch.keep(both.withColumn("similarity", F.col("n_both") / (F.col("_n") + F.col("_m") - F.col("n_both"))).where(F.col("similarity") >= least).drop("_n", "_m"))
    scratch.drop(met, *found)
    return pairs, members


def full_sets(texts: DataFrame, members: DataFrame, classes: DataFrame, width: int, by_set: bool, scratch: Scratch) -> DataFrame:
    """Columns k, s of these classes, from the text of one member each."""
    one = scratch.keep(members.join(classes.distinct(), "k", "left_semi").groupBy("k").agg(F.min("id").alias("id")))
    sets = shingle_sets(texts.join(one.select("id"), "id", "left_semi"), "id", "text", width, by_set)
    return sets.join(one, ["id", "k"], "left_semi").select("k", "s").dropDuplicates(["k"])
