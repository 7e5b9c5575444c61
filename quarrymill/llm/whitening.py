"""Whitening of embeddings: covariance from one aggregation over the upper triangle, eigenvectors from LAPACK."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import map_batches, packed, unpacked

#: An entry c becomes the whole number floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Whole numbers stop here on either side, so that sums of their halves stay exact over 2 ** 30 rows.
FARTHEST = 2.0**53
#: Sums are taken of a number's upper part and its lower LOW bits apart.
LOW = 20
COMPONENTS = 32


@dataclass(frozen=True)
class Whitening:
    """What a fit has found. Components stand in order of falling eigenvalue; those without variance have a weight of nan."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    explained: np.ndarray
    #: dims x components: entry of the unit eigenvector over the root of its eigenvalue.
    weights: np.ndarray
    identity_error: float | None

    @property
    def dims(self) -> int:
        return len(self.sums)


def sound(vectors: Column) -> Column:
    """Neither null nor with a null or non-finite entry."""
    return vectors.isNotNull() & F.forall(vectors, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def quantised(vectors: Column) -> Column:
    """The entries' whole numbers."""
    limit = F.lit(FARTHEST)
    return F.transform(vectors, lambda c: F.floor(F.greatest(-limit, F.least(limit, c * SCALE))).cast("long") + SHIFT)


def number(x: float) -> str:
    return f"({float(x)!r}D)"


def array(parts: list[str]) -> str:
    return f"array({', '.join(parts)})"


def centred(n: int, sums: tuple[int, ...]) -> str:
    """SQL of x - S / n: the whole part of the mean is taken off in whole numbers, the rest as a double."""
    whole, rest = array([f"{s // n}L" for s in sums]), array([number((s % n) / n) for s in sums])
    return f"zip_with(zip_with(x, {whole}, (a, m) -> CAST(a - m AS DOUBLE)), {rest}, (a, m) -> a - m)"


def projected(df: DataFrame, kind: str, weights: np.ndarray, less: np.ndarray | None = None) -> DataFrame:
    """The columns kept (schema ``kind``) and, from the array ``c`` that follows them, the array ``w`` of its components, a product of
    matrices for each batch; null where a component has no variance. ``less`` is taken off the components."""
    dims, wide = weights.shape
    less = np.zeros(wide) if less is None else less

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            c = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            w = pa.ListArray.from_arrays(pa.array(np.arange(len(c) + 1) * wide, pa.int32()), pa.array((c @ weights - less).ravel(), from_pandas=True))
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], w], names=[*batch.schema.names[:-1], "w"])

        return step

    return map_batches(df, f"{kind}w array<double>", start)


def covariance(df: DataFrame, dims: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Covariance and means of the array ``c``, which is centred, in one aggregation.

    For each dimension i a sum of its products with i, i + 1, ... up to half way around: every pair of the upper triangle. A row for each i
    keeps the sums few enough for compiled code; all in one row of dims * (dims + 1) / 2 sums took over a hundred times as long.
    """
    steps = range(dims // 2 + 1)
    at = [f"c[(i + {k}) % {dims}]" for k in steps]
    sums = df.selectExpr("c", "posexplode(c) AS (i, a)").groupBy("i").agg(F.sum("a"), *[F.expr(f"sum(a * {x})") for x in at])
    out, mean = np.zeros((dims, dims)), np.zeros(dims)
    for i, total, *products in sums.collect():  # dims rows
        mean[i] = total / n
        for k, v in zip(steps, products, strict=True):
            j = (i + k) % dims
            out[i, j] = out[j, i] = v / n
    return out, mean


def common_length(rows: DataFrame) -> int:
    """The number of entries that most sound vectors have; of several, the largest. 0 if there are none."""
    found = rows.where(sound(F.col("vec"))).groupBy(F.size("vec").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    return found[0]["dims"] if found else 0


def kept(rows: DataFrame, dims: int) -> DataFrame:
    return rows.where(sound(F.col("vec")) & (F.size("vec") == dims))


def fit_whitening(vectors: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Four aggregations over all vectors: their length, sums, products, and products of the whitened components. None without vectors.

    Only sums of fixed size reach the driver: dims * (dims + 1) / 2 of them. A task adds up its own rows before anything is shuffled.
    """
    rows = vectors.select(vectors[f"`{vec_col}`"].cast("array<double>").alias("vec"))
    dims = common_length(rows)
    if not dims:
        return None
    whole = kept(rows, dims).select(quantised(F.col("vec")).alias("x"))
    halves = whole.select(F.posexplode("x").alias("i", "a")).groupBy("i").agg(F.count("*"), F.sum(F.shiftright("a", LOW)), F.sum(F.col("a").bitwiseAND(F.lit((1 << LOW) - 1)))).orderBy("i").collect()
    n, total = halves[0][1], tuple((high << LOW) + low for _, _, high, low in halves)
    deviations = whole.selectExpr(centred(n, total) + " AS c")
    v, rest = covariance(deviations, dims, n)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    u = u * np.where(u[np.abs(u).argmax(0), np.arange(u.shape[1])] < 0, -1.0, 1.0)
    found = e > 8 * dims * np.finfo(float).eps * max(e[0], 0.0)
    weights = np.where(found, u, np.nan) / np.sqrt(np.where(found, e, 1.0))
    error, live = None, weights[:, found]
    if live.shape[1]:
        w, _ = covariance(projected(deviations, "", live, rest @ live).withColumnRenamed("w", "c"), live.shape[1], n)
        error = float(np.abs(w - np.eye(live.shape[1])).max())
    trace = float(np.trace(v))
    return Whitening(n, total, e, e / trace if trace > 0 else np.full(len(e), np.nan), weights, error)


def deviation(fit: Whitening) -> str:
    """SQL of the sum over dimensions of (n * x - S) ** 2 in whole numbers; null where it doesn't fit a long."""
    if max(map(abs, fit.sums)) >= 2**63:
        return "CAST(NULL AS BIGINT)"
    parts = [f"try_subtract(try_multiply({fit.n}L, x[{i}]), {s}L)" for i, s in enumerate(fit.sums)]
    out = "0L"
    for p in parts:
        out = f"try_add({out}, try_multiply({p}, {p}))"
    return out


def whiten(vectors: DataFrame, fit: Whitening | None, vec_col: str = "embedding") -> DataFrame:
    """The rows of ``vectors`` that have a sound vector, with ``deviation`` (long) and ``whitened`` (array of doubles, by component).

    Vectors that are null, or hold null or non-finite entries, go, and so do those whose number of entries is not that of the fit: of most
    vectors. Entries beyond 1.4e14 count as that. A deviation that no long can hold is null, and so are components without variance.
    Empty tables, and tables without a sound vector, give no rows. Repeated rows and ties get equal results; rows without an id stay. Input
    columns named deviation or whitened are replaced. No shuffle.
    """
    rows = packed(vectors, vec=vectors[f"`{vec_col}`"].cast("array<double>"))
    if fit is None:
        return unpacked(rows.where("false"), vectors.columns, deviation=F.lit(None).cast("long"), whitened=F.array().cast("array<double>"))
    whole = kept(rows, fit.dims).select("row", quantised(F.col("vec")).alias("x"))
    parts = whole.selectExpr("row", f"{deviation(fit)} AS deviation", centred(fit.n, fit.sums) + " AS c")
    out = projected(parts, f"row {rows.schema['row'].dataType.simpleString()}, deviation long, ", fit.weights)
    return unpacked(out, vectors.columns, deviation=F.col("deviation"), whitened=F.col("w"))
