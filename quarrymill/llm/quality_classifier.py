"""Quality scores: ridge regression on random Fourier features of document statistics, calibrated by isotonic regression."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import SPACES, cut, map_batches, packed
from quarrymill.sources.ship import ship

STATISTICS = (
    "log_chars", "log_words", "word_length", "upper", "digits", "non_ascii", "symbols", "pipes", "bangs", "stops", "commas", "other_marks",
    "spaces", "log_lines", "distinct_words", "top_word", "copied_lines", "distinct_pairs", "ends_marked", "capital_words",
)
FEATURES, SEED, RIDGE = 192, 20240229, 1e-3
#: Steps of the raw score for which labels are counted before the isotonic fit.
STEPS = 400


def statistics(text: bytes | None) -> list[float]:
    """Of one whole text, by name in STATISTICS; all finite, and 0 for shares of nothing."""
    text = text or b""
    n = max(1, len(text))
    byte = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    words = text.split()
    w = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    share = lambda chars: float(byte[list(chars)].sum()) / n
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        min(50.0, sum(map(len, words)) / w),
        float(byte[65:91].sum()) / n,
        float(byte[48:58].sum()) / n,
        float(byte[128:].sum()) / n,
        share(b"#$%&*<>^~@=+\\"),
        share(b"|"),
        share(b"!?"),
        share(b"."),
        share(b","),
        share(b":;'\"()[]{}/-_"),
        share(b" \t\r\x0b\x0c"),
        np.log1p(len(lines)),
        len(counts) / w,
        max(counts.values(), default=0) / w,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        len(set(zip(words, words[1:], strict=False))) / max(1, len(words) - 1),
        sum(x.rstrip(SPACES)[-1:] in b".!?" for x in lines) / max(1, len(lines)),
        sum(x[:1].isupper() for x in words) / w,
    ]


def with_statistics(rows: DataFrame) -> DataFrame:
    """Columns row and x (array of float64, by STATISTICS) from columns row and text."""
    kind = rows.schema["row"].dataType.simpleString()

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = np.array([statistics(t) for t in batch.column(1).to_pylist()], dtype=np.float64)
            offsets = pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32())
            return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], names=["row", "x"])

        return step

    return map_batches(rows.select("row", F.col("text").cast("binary")), f"row {kind}, x array<double>", start)


@dataclass(frozen=True)
class Classifier:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        """Products of two rows approximate a Gaussian kernel of their standardised statistics; the last feature is 1."""
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.steps, self.values), 0.0, 1.0)


def random_features(count: int, features: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed by the seed. The kernel's width is the root of twice the number of statistics."""
    rng = np.random.default_rng(seed)
    return rng.normal(size=(count, features)) / np.sqrt(2 * count), rng.uniform(0, 2 * np.pi, features)


#: Tasks that add up the labelled rows' numbers, so that what they shuffle doesn't grow with the number of partitions.
SUM_TASKS = 256


def sums(labelled: DataFrame, make, width: int) -> np.ndarray:
    """``make(x, y)`` gives a matrix for each Arrow batch; their sum over all rows, added in each of SUM_TASKS tasks at most and then by
    cell of the matrix."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                part = make(x, batch.column(1).to_numpy().astype(np.float64))
                total = part if total is None else total + part
        if total is not None:
            i, j = np.indices(total.shape).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], names=["i", "j", "v"])

    ship(labelled.sparkSession)
    cells = labelled.select("x", F.col("y").cast("double")).coalesce(SUM_TASKS).mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((1 + max((c["i"] for c in cells), default=0), width))
    for c in cells:
        out[c["i"], c["j"]] = c["v"]
    return out


def pool_adjacent(weight: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """The non-decreasing means that fit best; steps without rows take the mean of the block before, the first ones of the block after."""
    blocks: list[list[float]] = []
    for i, (w, h) in enumerate(zip(weight, hits, strict=True)):
        if w:
            blocks.append([h, w, i])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                h, w, _ = blocks.pop()
                blocks[-1][0] += h
                blocks[-1][1] += w
    out = np.full(len(weight), np.nan)
    for h, w, i in blocks:
        out[i:] = h / w
    if blocks:
        out[np.isnan(out)] = blocks[0][0] / blocks[0][1]
    return np.nan_to_num(out, nan=0.5)


def fit(measured: DataFrame, calibrates: Column, features: int = FEATURES, seed: int = SEED, ridge: float = RIDGE) -> Classifier:
    """From columns x, y (0 or 1): the normal equations from rows outside ``calibrates``, the isotonic fit from those inside.

    To the driver go sums of a fixed size alone. Without labels, or with one label only, the score is a constant.
    """
    count = len(STATISTICS)
    train, held = measured.where(~calibrates), measured.where(calibrates)
    moments = sums(train, lambda x, y: np.vstack([np.append(x.sum(0), len(x)), np.append((x * x).sum(0), y.sum())]), count + 1)
    if len(moments) < 2 or not moments[0, -1]:
        moments = np.vstack([np.append(np.zeros(count), 1.0), np.append(np.ones(count), 0.5)])
    n = moments[0, -1]
    mean = moments[0, :-1] / n
    scale = np.sqrt(np.maximum(moments[1, :-1] / n - mean**2, 1e-12))
    scale[scale < 1e-5] = 1.0
    directions, phases = random_features(count, features, seed)
    blank = Classifier(mean, scale, directions, phases, np.zeros(features + 1), np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = blank.features(x)
        return np.hstack([z.T @ z, (z.T @ y)[:, None]])

    width = features + 1
    ab = sums(train, equations, width + 1)
    if len(ab) < width:
        ab = np.zeros((width, width + 1))
    a, b = ab[:, :width], ab[:, width]
    weights = np.linalg.solve(a + ridge * max(n, 1.0) / features * np.eye(width), b)
    edges = np.linspace(-0.5, 1.5, STEPS + 1)
    model = Classifier(mean, scale, directions, phases, weights, edges, edges)

    def counted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = np.clip(np.rint((model.raw(x) - edges[0]) / (edges[1] - edges[0])), 0, STEPS).astype(int)
        return np.vstack([np.bincount(at, minlength=STEPS + 1), np.bincount(at, weights=y, minlength=STEPS + 1)]).astype(float)

    counts = sums(held, counted, STEPS + 1)
    if len(counts) < 2:
        counts = np.vstack([np.ones(STEPS + 1), np.clip(edges, 0, 1)])
    return Classifier(mean, scale, directions, phases, weights, edges, pool_adjacent(*counts))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", held_out: Column | None = None, cutoff: float = 0.3) -> DataFrame:
    """The rows of ``docs`` with ``held_out``, ``score`` and ``predicted`` (1 from ``cutoff`` on).

    Held out, and never learnt from, are rows whose crc32(id as text) mod 5 is 0. Rows of remainder 1 calibrate, the others fit the
    ridge regression. Only statistics of the text enter a score. The texts are read once; their statistics (20 numbers each) are
    checkpointed, and only these are joined with the labels.

    Null and empty texts have statistics and get a score. Rows without an id are held out. Labels other than 0 and 1, null or without a
    document, are not used; repeated rows are learnt from as often as they occur. Ties in the score get equal predictions. Input columns
    of the same names are replaced. Without any labels the scores are constant.
    """
    group = F.crc32(docs[f"`{id_col}`"].cast("string").cast("binary")) % 5
    rows = packed(docs, id=docs[f"`{id_col}`"], text=docs[f"`{text_col}`"], group=F.coalesce(group, F.lit(0)).cast("int"))
    columns = [c for c in docs.columns if c != text_col]
    slim = rows.select(F.struct(F.col("id").alias("id"), F.col("group").alias("group"), *([F.col("row").dropFields(text_col).alias("rest")] if columns else [])).alias("row"), "text")
    measured = cut(with_statistics(slim))
    usable = labels.select(labels[f"`{id_col}`"].alias("labelled"), labels[f"`{label_col}`"].cast("int").alias("y")).where("y in (0, 1)")
    held = F.col("row.group") == 0 if held_out is None else held_out
    known = cut(measured.where(~held).select(F.col("row.id").alias("labelled"), F.col("row.group").alias("part"), "x").join(usable, "labelled").select("part", "x", "y"))
    model = fit(known, F.col("part") == 1)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = measured.schema["row"].dataType.simpleString()

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(x))], names=["row", "score"])

        return step

    scored = map_batches(measured, f"row {kind}, score double", start)
    new = {"held_out": held, "score": F.col("score"), "predicted": (F.col("score") >= cutoff).cast("int")}
    return scored.select(*[F.col("row.rest").getField(c).alias(c) for c in columns if c not in new], *[v.alias(k) for k, v in new.items()])
