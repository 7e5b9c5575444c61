"""A stated set of query vectors against all vectors, in blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.operators.ranks import each_block
from quarrymill.sources.ship import ship

#: Queries of one block: what a task holds of them.
BLOCK = 2048


def nearest(queries: DataFrame, items: DataFrame, ident: str, vector: str, most: int, same: str | None = None, other: str | None = None) -> DataFrame:
    """Columns query, item, similarity, rank: the ``most`` items of highest dot product (rounded to nine digits, ties to the smallest id) for
    each query, itself left out; in the same ``same`` and with another ``other`` where these columns are named.

    Queries are a stated set, taken in blocks of BLOCK; each block goes to all tasks, which keep its best items of their own rows, so
    that the shuffle has ``most`` rows a query and task. The driver holds a block at a time. The search is exact: recall is 1.
    """
    ship(items.sparkSession)
    columns = [c for c in (same, other) if c]
    shape = [F.col(ident).cast("long").alias(ident), vector, *[F.col(c).cast("string").alias(c) for c in columns]]
    rows = items.where(F.col(vector).isNotNull()).select(*shape)

    def among_all(block: pd.DataFrame) -> DataFrame:
        held = items.sparkSession.sparkContext.broadcast((block[ident].to_numpy(), np.array(block[vector].tolist(), dtype=np.float64), [block[c].to_numpy(object) for c in columns]))

        def search(batches):
            ids, vectors, keys = held.value
            item, score = np.zeros((len(ids), 0), np.int64), np.zeros((len(ids), 0))
            for whole in batches if len(ids) else ():
                for start in range(0, len(whole), BLOCK):
                    part = whole.iloc[start : start + BLOCK]
                    own = part[ident].to_numpy()
                    found = np.round(vectors @ np.array(part[vector].tolist(), dtype=np.float64).T, 9)
                    found[ids[:, None] == own[None, :]] = -np.inf
                    for c, k in zip(columns, keys, strict=True):
                        equal = k[:, None] == part[c].to_numpy(object)[None, :]
                        found[~equal if c == same else equal] = -np.inf
                    item, score = np.hstack([item, np.broadcast_to(own, found.shape)]), np.hstack([score, found])
                    order = np.lexsort((item, -score), axis=1)[:, :most]
                    item, score = np.take_along_axis(item, order, axis=1), np.take_along_axis(score, order, axis=1)
            q, r = np.nonzero(score > -np.inf)
            yield pd.DataFrame({"query": ids[q], "item": item[q, r], "similarity": score[q, r]})

        rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("similarity"), "item"))
        return rows.mapInPandas(search, "query long, item long, similarity double").withColumn("rank", rank.cast("long")).where(F.col("rank") <= most)

    return each_block(queries.where(F.col(vector).isNotNull()).select(*shape), ident, BLOCK, among_all)


def hard_negatives(queries: DataFrame, items: DataFrame, ident: str, vector: str, split: str, family: str, most: int = 4) -> DataFrame:
    """Columns ident, negative_id, rank."""
    return nearest(queries, items, ident, vector, most, split, family).select(F.col("query").alias(ident), F.col("item").alias("negative_id"), "rank")


def recall_summary(queries: DataFrame, items: DataFrame, ident: str, vector: str, label: str) -> DataFrame:
    """One row: n_queries, recall_at_1, recall_at_5 (an item of the query's label is among the first) and mean_similarity of the first."""
    labels = items.select(F.col(ident).alias("item"), F.col(label).alias("_label"))
    met = nearest(queries, items, ident, vector, 5).join(labels, "item").join(queries.select(F.col(ident).alias("query"), F.col(label).alias("_own")), "query")
    same = F.col("_label") == F.col("_own")
    each = met.groupBy("query").agg(F.max((same & (F.col("rank") == 1)).cast("int")).alias("hit1"), F.max(same.cast("int")).alias("hit5"), F.max("similarity").alias("s"))
    return each.agg(F.count("*").alias("n_queries"), F.round(F.avg("hit1"), 6).alias("recall_at_1"), F.round(F.avg("hit5"), 6).alias("recall_at_5"), F.round(F.avg("s"), 4).alias("mean_similarity"))
