"""Lines that several documents hold stay only in the document with the smallest id."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import LAST_ID, SPACES, map_batches, packed, unpacked


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The line without white space at its ends and with A-Z in lower case; None if it is too short to count."""
    key = line.strip(SPACES).lower()
    if len(key) < min_chars or not key.isascii() and len(key.decode(errors="replace")) < min_chars:
        return None
    return key


#: So many of the most common line keys are broadcast.
HOT = 4096


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """Columns doc, part, h1, h2: one row for each row's distinct line keys, as two halves of a 128-bit hash."""

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out, counts = [], []
            for text in batch.column(2).to_pylist():
                keys = {line_key(x, min_chars) for x in (text or b"").split(b"\n")}
                keys.discard(None)
                out.extend(map(xxhash.xxh3_128_digest, keys))
                counts.append(len(keys))
            halves = np.frombuffer(b"".join(out), dtype="<i8").reshape(-1, 2)
            columns = [np.repeat(batch.column(0).to_numpy(), counts), np.repeat(batch.column(1).to_numpy(), counts), halves[:, 0].copy(), halves[:, 1].copy()]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["doc", "part", "h1", "h2"])

        return step

    return map_batches(docs.select("doc", "part", F.col("text").cast("binary")), "doc long, part long, h1 long, h2 long", start)


def lines_to_drop(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """Columns doc, part, drops (array of struct h1, h2): the keys that the row loses.

    The HOT most common keys, a fixed number, are broadcast. Rows with one of them meet it where they are and are then dealt at
    random, as they have nothing more to meet; only the others are dealt by key.
    """
    keys = line_keys(docs, min_chars)
    if min_docs == 2:  # two documents at least, without holding the distinct ids of a hot line
        common = keys.groupBy("h1", "h2").agg(F.min("doc").alias("keeper"), F.max("doc").alias("last"), F.count("*").alias("n")).where("keeper < last")
    else:
        common = keys.select("doc", "h1", "h2").distinct().groupBy("h1", "h2").agg(F.min("doc").alias("keeper"), F.count("*").alias("n")).where(F.col("n") >= min_docs)
    hot = common.orderBy(F.desc("n"), "h1", "h2").limit(HOT).select("h1", "h2", F.col("keeper").alias("met"))
    found = keys.join(F.broadcast(hot), ["h1", "h2"], "left")
    dealt = found.withColumn("k1", F.when(F.col("met").isNull(), F.col("h1")).otherwise(F.xxhash64("doc", "part", "h2")))
    kept = dealt.join(common.select(F.col("h1").alias("k1"), "h2", "keeper"), ["k1", "h2"], "left")
    lost = kept.select("doc", "part", "h1", "h2", F.coalesce("met", "keeper").alias("keeper")).where("doc <> keeper")
    return lost.groupBy("doc", "part").agg(F.collect_list(F.struct("h1", "h2")).alias("drops"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """The rows of ``docs`` with the kept lines as text, and ``n_lines`` (before), ``n_dropped``.

    Lines are split at \\n. A line whose key (see line_key) has min_chars code points and occurs in min_docs documents stays
    only in the document with the smallest id, there as often as it occurs.

    Null or empty texts have one empty line, which stays; the text returned is then empty, not null. Rows with the same id are
    one document: each keeps or loses the line. Rows without an id are one document, after all others, but their texts are dealt
    each by itself. Ties cannot arise, as ids are unique per document. Input columns named n_lines or n_dropped are replaced, all
    others are returned as they are. An empty table gives an empty result. Each hot line is first reduced to the smallest and
    largest id in every task, and each document gets the keys that it loses.
    """
    columns = docs.columns
    rows = packed(docs, doc=F.coalesce(docs[f"`{id_col}`"].cast("long"), F.lit(LAST_ID)), text=docs[f"`{text_col}`"])
    rows = rows.withColumn("part", F.when(F.col("doc") == LAST_ID, F.xxhash64("text")).otherwise(F.lit(0).cast("long")))
    drops = lines_to_drop(rows.select("doc", "part", "text"), min_chars, min_docs)
    kept = F.col("row").dropFields(text_col) if len(columns) > 1 else F.lit(0)
    joined = rows.select(kept.alias("row"), "doc", "part", "text").join(drops, ["doc", "part"], "left").select("row", F.col("text").cast("binary").alias("text"), "drops")
    kind = joined.schema["row"].dataType.simpleString()

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            kept, lines_in, dropped = [], [], []
            lost = batch.column(2)
            flat = lost.flatten()
            halves = np.stack([flat.field(0).to_numpy(zero_copy_only=False), flat.field(1).to_numpy(zero_copy_only=False)], axis=1).astype("<i8").tobytes() if len(flat) else b""
            sizes, at = lost.value_lengths().fill_null(0).to_pylist(), 0
            for text, n in zip(batch.column(1).to_pylist(), sizes, strict=True):
                lines = (text or b"").split(b"\n")
                lines_in.append(len(lines))
                if n:
                    gone = {halves[16 * i : 16 * i + 16] for i in range(at, at + n)}
                    at += n
                    lines = [x for x in lines if (k := line_key(x, min_chars)) is None or xxhash.xxh3_128_digest(k) not in gone]
                dropped.append(lines_in[-1] - len(lines))
                kept.append(b"\n".join(lines))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(lines_in, pa.int64()), pa.array(dropped, pa.int64())], names=["row", "kept", "n_lines", "n_dropped"])

        return step

    done = map_batches(joined, f"row {kind}, kept string, n_lines long, n_dropped long", start)
    new = {text_col: F.col("kept"), "n_lines": F.col("n_lines"), "n_dropped": F.col("n_dropped")}
    return unpacked(done, columns, **new)
