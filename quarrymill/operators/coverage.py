"""Counts against limits, orphans and duplicate ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of child with a key that parent has not."""
    return child.where(F.col(child_key).isNotNull()).join(parent.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_anti")


def duplicate_ids(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def limit_gaps(counts: DataFrame, limits: DataFrame, key: str) -> DataFrame:
    """For each limit (key, minimum) what is missing, and a code; a key without rows counts 0."""
    joined = limits.join(counts, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    missing = F.greatest(F.lit(0), F.col("minimum") - F.col("n"))
    return joined.select(key, "minimum", F.col("n").cast("long").alias("n"), missing.cast("long").alias("missing"), F.when(missing > 0, F.concat(F.lit("below_minimum:"), key)).otherwise("ok").alias("code"))
