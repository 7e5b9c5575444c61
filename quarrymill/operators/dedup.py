"""Duplicates, best and latest rows by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_per_key(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each key in this order. Only one row a key leaves each task: Spark stops a window's rank at 1 before the shuffle."""
    named = df.withColumns({f"_k{i}": k for i, k in enumerate(keys)})
    w = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy(*order)
    return named.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", *[f"_k{i}" for i in range(len(keys))])


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """At most n rows of each key; 0 keeps all."""
    if not n:
        return df
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")


def dedupe_candidates(df: DataFrame, url: str, exact: str, ident: str, order: list[Column]) -> DataFrame:
    """Best row of each URL, then best of each exact key; a blank key stands for the row's own id."""
    own = lambda c: F.coalesce(F.when(F.trim(c) != "", F.trim(c)), F.col(ident).cast("string"))
    return best_per_key(best_per_key(df, [own(F.col(url))], order), [own(F.col(exact))], order)


def record_versions(df: DataFrame, key: list[str], order: list[str], content: str) -> DataFrame:
    """``version`` counts changes of content along the order, and ``decision`` is insert, update or duplicate."""
    w = Window.partitionBy(*key).orderBy(*order)
    before = F.lag(content).over(w)
    decided = df.withColumn("decision", F.when(F.row_number().over(w) == 1, "insert").when(before.eqNullSafe(F.col(content)), "duplicate").otherwise("update"))
    return decided.withColumn("version", F.sum((F.col("decision") != "duplicate").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def latest(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key; the maximum of a struct is kept in every task, without a sort."""
    rest = [c for c in df.columns if c not in key and c not in order]
    return df.groupBy(*key).agg(F.max(F.struct(*order, *rest)).alias("_r")).select(*key, *[F.col("_r")[c].alias(c) for c in (*order, *rest)])
