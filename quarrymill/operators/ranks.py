"""Places and running sums over all rows of a key, without a window over them."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.operators.lineage import Scratch


def placed(rows: DataFrame, scratch: Scratch, key: str, order: list[Column], size: str | None = None) -> DataFrame:
    """The rows with ``pos``, their place among the rows of ``key`` in this order, from 0, and ``before``, the sum of ``size`` over the rows
    before (with ``size`` given).

    The rows are written as sorted runs, one for each file. Places and sums within a run come from a window over that run alone, those of the
    runs before from their totals, a row a run and key. Equal rows are told apart by where they were read, so that many of them spread over runs.
    """
    runs = scratch.keep(rows.withColumn("_from", F.monotonically_increasing_id()).orderBy(key, *order, "_from").drop("_from"))
    held = runs.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    amount = F.col(size) if size else F.lit(0)
    totals = held.groupBy(key, "_file").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"), F.sum(amount).alias("_size"))
    ahead = Window.partitionBy(key).orderBy(F.regexp_extract("_file", r"part-(\d+)", 1).cast("long"), "_file").rowsBetween(Window.unboundedPreceding, -1)
    earlier = totals.select(key, "_file", (F.coalesce(F.sum("_n").over(ahead), F.lit(0)) - F.col("_first")).alias("_shift"), F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_sum"))
    joined = held.join(earlier.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key")) & (held["_file"] == earlier["_file"])).drop(earlier["_file"])
    out = joined.withColumn("pos", F.col("_at") + F.col("_shift"))
    if size:
        inside = Window.partitionBy(key, "_file").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn("before", F.col("_sum") + F.coalesce(F.sum(size).over(inside), F.lit(0)))
    return out.drop("_file", "_at", "_shift", "_sum", "_key")


def each_block(queries: DataFrame, ident: str, size: int, work: Callable[[pd.DataFrame], DataFrame]) -> DataFrame:
    """What ``work`` gives for all blocks of ``size`` queries. The driver holds one block at a time, and each block's rows are written before
    the next one, so that neither the plan nor what is held grows with the queries; a single block is left to be computed when it is read.
    """
    scratch = Scratch(queries.sparkSession)
    held = scratch.keep(placed(queries.withColumn("_all", F.lit(0)), scratch, "_all", [F.col(ident)]).withColumn("_block", F.floor(F.col("pos") / size).cast("long")).drop("_all", "pos"))
    last = held.agg(F.max("_block")).first()[0] or 0
    block = lambda b: held.where(F.col("_block") == b).drop("_block").toPandas()
    if not last:
        return work(block(0))
    folder = f"{scratch.folder}/blocks"
    for b in range(last + 1):
        out = work(block(b))
        out.write.mode("append").parquet(folder)
    return queries.sparkSession.read.schema(out.schema).parquet(folder)
