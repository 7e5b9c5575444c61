"""Evaluation metrics as aggregates."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.operators.ranks import each_block
from quarrymill.sources.ship import ship


def wilson(hits: Column, n: Column, z: float = 1.96) -> Column:
    """Struct low, high: the score interval of a share; 0 and 0 without cases."""
    p, zz = hits / n, z * z
    centre = (p + zz / (2 * n)) / (1 + zz / n)
    half = z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n)) / (1 + zz / n)
    return F.struct(F.when(n > 0, F.greatest(F.lit(0.0), centre - half)).otherwise(0.0).alias("low"), F.when(n > 0, F.least(F.lit(1.0), centre + half)).otherwise(0.0).alias("high"))


def token_f1(left: Column, right: Column) -> Column:
    """Of two arrays of tokens as multisets, in time that is in proportion to them; both empty 1, one empty 0, null for a null array."""

    @F.pandas_udf("double")
    def run(lefts: pd.Series, rights: pd.Series) -> pd.Series:
        def one(a: object, b: object) -> float | None:
            if a is None or b is None:
                return None
            common = sum((Counter(a) & Counter(b)).values())
            return 1.0 if not len(a) and not len(b) else 2.0 * common / (len(a) + len(b)) if common else 0.0

        return pd.Series([one(a, b) for a, b in zip(lefts, rights, strict=True)], dtype=float)

    return run(left, right)


def word_edits(left: Column, right: Column) -> Column:
    """Levenshtein distance of two arrays of words: each distinct word of the pair becomes a character."""
    words = F.array_distinct(F.concat(left, right))
    as_text = lambda a, words: F.array_join(F.transform(a, lambda w: F.decode(F.unhex(F.lpad(F.hex(F.array_position(words, w) + 65536), 8, "0")), "UTF-32")), "")
    return F.transform(F.array(words), lambda d: F.levenshtein(as_text(left, d), as_text(right, d)))[0]


def error_rate(df: DataFrame, edits: Column, length: Column) -> DataFrame:
    """Sum of edits by sum of reference lengths, each one at least."""
    return df.agg(F.sum(edits).cast("long").alias("edits"), F.sum(F.greatest(length, F.lit(1))).cast("long").alias("length")).select("edits", "length", (F.col("edits") / F.col("length")).alias("rate"))


#: Query vectors that are compared at once, and with how many items: what a task holds of products.
QUERY_BLOCK, ITEM_BLOCK = 2048, 512


def retrieval_best(queries: DataFrame, items: DataFrame, ident: str, vector: str, label: str) -> DataFrame:
    """For each query (a stated set; ident, vector, label) the best dot product with items of its label and of others, itself left
    out: ident, best_same, best_other (null without such items).

    The queries go to all tasks in blocks of QUERY_BLOCK at most, and each task gives one row for each query, so neither pairs nor all
    queries at once are held, on the driver neither.
    """
    ship(items.sparkSession)
    shape = [ident, vector, label]
    rows = items.select(shape)

    def among_all(block: pd.DataFrame) -> DataFrame:
        ids, labels = block[ident].to_numpy(), block[label].to_numpy()
        matrix = np.array(block[vector].tolist(), dtype=np.float32)

        def run(batches):
            same, other = np.full(len(ids), -np.inf), np.full(len(ids), -np.inf)
            for batch in (whole.slice(at, ITEM_BLOCK) for whole in batches for at in range(0, whole.num_rows, ITEM_BLOCK)):
                if len(ids):
                    x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                    dots = (matrix.astype(np.float64) @ x.astype(np.float64).T).round(6)
                    dots[ids[:, None] == batch.column(0).to_numpy()[None, :]] = -np.inf
                    alike = labels[:, None] == batch.column(2).to_numpy()[None, :]
                    same = np.maximum(same, np.where(alike, dots, -np.inf).max(axis=1))
                    other = np.maximum(other, np.where(alike, -np.inf, dots).max(axis=1))
            null = lambda v: pa.array(v, mask=~np.isfinite(v))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), null(same), null(other)], names=["q", "same", "other"])

        best = rows.mapInArrow(run, "q long, same double, other double")
        return best.groupBy(F.col("q").alias(ident)).agg(F.max("same").alias("best_same"), F.max("other").alias("best_other"))

    return each_block(queries.select(shape), ident, QUERY_BLOCK, among_all)


def right_in_place(prediction: Column, target: Column) -> Column:
    """Tokens of the target that the prediction has at the same place."""
    n = F.least(F.size(prediction), F.size(target))
    same = F.zip_with(F.slice(prediction, 1, n), F.slice(target, 1, n), lambda a, b: a == b)
    return F.size(F.filter(same, lambda x: x))


def common_subsequence(left: list, right: list) -> int:
    """Length of the longest common subsequence; one bit of a whole number for each item of ``right`` (Hyyrö, 2004)."""
    places: dict = {}
    for i, x in enumerate(right):
        places[x] = places.get(x, 0) | 1 << i
    mask = (1 << len(right)) - 1
    row = mask
    for x in left:
        met = row & places.get(x, 0)
        row = ((row + met) | (row - met)) & mask
    return len(right) - row.bit_count()


def rouge_l(pairs: DataFrame, prediction: str, target: str) -> DataFrame:
    """Adds lcs and f1: the longest common subsequence of two arrays of words, and the harmonic mean of its shares of both; 1 for two
    empty arrays, 0 for one. Whole arrays are compared, a pair at a time."""
    ship(pairs.sparkSession)

    @F.pandas_udf("long")
    def lcs(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([common_subsequence(list(a), list(b)) for a, b in zip(left, right, strict=True)], dtype="int64")

    n, m = F.size(prediction), F.size(target)
    scored = pairs.withColumn("lcs", lcs(prediction, target))
    return scored.withColumn("f1", F.when((n == 0) & (m == 0), 1.0).when((n == 0) | (m == 0) | (F.col("lcs") == 0), 0.0).otherwise(2 * F.col("lcs") / (n + m)))


#: Distribution of the number of times that one row of many is drawn in a sample of their number: Poisson with mean 1, up to 12.
POISSON = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(12)]


def unit(seed: int, *keys: Column) -> Column:
    """A number from 0 to 1, the same for the same keys in any plan and in any engine that has MD5."""
    return F.conv(unit_digits(seed, *keys), 16, 10).cast("double") / float(2**48)


def unit_digits(seed: int, *keys: Column) -> Column:
    """The number of ``unit`` as 12 hexadecimal digits behind the point; strings of them compare as the numbers do."""
    return F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]).cast("binary")), 1, 12)


def poisson_times(digits: Column) -> Column:
    """How many of POISSON the number with these digits reaches. The first comparisons decide nearly always, so that the others are seldom made."""
    out = F.when(digits < F.lit(f"{math.ceil(POISSON[0] * 2**48):012x}"), 0)
    for n, p in enumerate(POISSON[1:], 1):
        out = out.when(digits < F.lit(f"{math.ceil(p * 2**48):012x}"), n)
    return out.otherwise(len(POISSON))


def bootstrap_mean(df: DataFrame, ident: str, value: str, *by: str, replicates: int = 200, level: float = 0.95, seed: int = 0) -> DataFrame:
    """Columns by, n, mean, low, high: the mean of a value and its interval over ``replicates`` resampled means, in one pass.

    In a replicate a row counts as often as a hash of its id and the replicate says, by a Poisson distribution with mean 1. Each task adds up a
    sum and a count for each replicate, which is all that is shuffled. Low and high are the replicates at the level's ends, by rank. Null values are passed
    over; a group without values has no row. Repeated ids count alike. Rows with a null id count alike, too.
    """
    rows = df.where(F.col(value).isNotNull()).select(*by, F.coalesce(F.col(ident).cast("string"), F.lit("")).alias("_id"), F.col(value).cast("double").alias("_x"))
    each = rows.select(*by, "_x", "_id", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("_r")).withColumn("_u", unit_digits(seed, F.col("_id"), F.col("_r")))
    sums = each.withColumn("_w", poisson_times(F.col("_u"))).groupBy(*by, "_r").agg(F.sum("_w").alias("_n"), F.sum(F.col("_w") * F.col("_x")).alias("_s"))
    means = sums.groupBy(*by).agg(F.array_sort(F.collect_list(F.when(F.col("_n") > 0, F.col("_s") / F.col("_n")))).alias("_m"))
    at = lambda share: F.get("_m", F.floor(F.size("_m") * F.lit(share)).cast("int"))
    low, high = at((1 - level) / 2), F.get("_m", F.ceil(F.size("_m") * F.lit((1 + level) / 2)).cast("int") - 1)
    whole = rows.groupBy(*by).agg(F.count("*").alias("n"), F.avg("_x").alias("mean"))
    joined = whole.join(means, list(by)) if by else whole.where("n > 0").crossJoin(F.broadcast(means))  # one row each
    return joined.select(*by, "n", "mean", low.alias("low"), high.alias("high"))
