"""What is written: JSON lines, split tables, tar shards with an index, new payloads only."""

from __future__ import annotations

import io
import tarfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.functions.canonical import canonical_json
from quarrymill.operators.lineage import Scratch
from quarrymill.operators.ranks import placed
from quarrymill.operators.split import ranked_keys
from quarrymill.sources.ship import ship

SHARD_SCHEMA = "split string, shard long, name string, n_samples long, n_bytes long, sha256 string, body binary"


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object a line with sorted keys; Spark's commit makes it whole or absent."""
    df.select(*sorted(df.columns)).write.mode("errorifexists").json(path)


def write_splits(df: DataFrame, path: str, *by: str) -> None:
    """One folder for each split and view; rows of one folder are spread over tasks by Spark's rebalancing."""
    df.hint("rebalance", *by).write.mode("errorifexists").partitionBy(*by).parquet(path)


def new_payloads(df: DataFrame, stored: DataFrame, key: str = "content_sha256") -> DataFrame:
    """One row of each content that is not stored yet."""
    return df.dropDuplicates([key]).join(stored.select(key), key, "left_anti")


def numbered_shards(df: DataFrame, ident: str, split: str, per_shard: int) -> DataFrame:
    """``shard`` for each row: by the rank of its id's hash in the split, ``per_shard`` rows each."""
    parts = [r[0] for r in df.select(split).distinct().collect()]  # a few names
    out = None
    for name in sorted(parts):
        rows = df.where(F.col(split) == name).withColumn("_id", F.col(ident).cast("string"))
        ranks = ranked_keys(rows, "_id")[0].select("_id", F.floor((F.col("rank") - 1) / per_shard).cast("long").alias("shard"))
        part = rows.join(ranks, "_id").drop("_id")
        out = part if out is None else out.union(part)
    return df.withColumn("shard", F.lit(0).cast("long")).limit(0) if out is None else out


def tar_bytes(payload: Column) -> Column:
    """What a member with this payload takes in a tar file: its header and its content in whole blocks."""
    return F.lit(tarfile.BLOCKSIZE) + F.ceil(F.octet_length(payload) / tarfile.BLOCKSIZE).cast("long") * tarfile.BLOCKSIZE


def room_for(most_bytes: int) -> int:
    """Bytes of members that a tar file of ``most_bytes`` has room for beside its end, as files are whole records."""
    return most_bytes // tarfile.RECORDSIZE * tarfile.RECORDSIZE - 2 * tarfile.BLOCKSIZE


def exits(before: np.ndarray, size: np.ndarray, inside: int, per_shard: int, room: int) -> np.ndarray:
    """For each of the first ``inside`` rows, as a shard's start, the first start of a shard from row ``inside`` on; rows as places in the arrays.

    A start's next one is where either limit would be passed; the arrays reach ``per_shard`` rows beyond ``inside``, or to the end."""
    ends = np.append(before, before[-1] + size[-1]) if len(before) else np.zeros(1, np.int64)
    nexts = np.minimum(np.searchsorted(ends, before[:inside] + room, side="right") - 1, np.arange(min(inside, len(before))) + per_shard)
    out = nexts.copy()
    for i in range(len(out) - 1, -1, -1):
        if out[i] < inside and out[i] < len(out):
            out[i] = out[out[i]]
    return out


def starts_from(entry: int, before: np.ndarray, size: np.ndarray, inside: int, per_shard: int, room: int) -> list[int]:
    """Starts of shards within the first ``inside`` rows, from the first one on."""
    ends, out = np.append(before, before[-1] + size[-1]), []
    while entry < min(inside, len(before)):
        out.append(entry)
        entry = min(int(np.searchsorted(ends, before[entry] + room, side="right")) - 1, entry + per_shard)
    return out


def filled_shards(rows: DataFrame, split: str, order: list[Column], size: str, per_shard: int, room: int, blocks: int = 16) -> DataFrame:
    """The rows with ``shard``: each split is filled in this order; a shard ends before the row that would be its ``per_shard`` + 1st or would
    bring the sum of ``size`` over ``room``. The limits are those of one pass over the split, yet no task sees more than a block.

    A block has ``blocks`` x ``per_shard`` rows, and sees ``per_shard`` of the next one. From each row on which a shard may
    enter it, its first ``per_shard``, a task finds where the next block is entered. These pointers, a sixteenth of the rows, are doubled until
    the first row's are known for all blocks; then each block is filled from its entry. A row larger than ``room`` is an error that
    names it.
    """
    spark, scratch, wide = rows.sparkSession, Scratch(rows.sparkSession), blocks * per_shard
    named = rows.withColumn("_split", F.coalesce(F.col(split).cast("string"), F.lit("")))
    checked = named.withColumn("_size", F.when(F.col(size) <= room, F.col(size)).otherwise(F.raise_error(F.concat(F.lit("a sample of "), F.col(size).cast("string"), F.lit(f" bytes exceeds a shard of {room}")))))
    held = scratch.keep(placed(checked, scratch, "_split", order, "_size"))
    at = held.select("_split", F.floor(F.col("pos") / wide).cast("long").alias("block"), "pos", "before", "_size")
    more = at.where((F.col("block") > 0) & (F.col("pos") % wide < per_shard)).withColumn("block", F.col("block") - 1)
    seen = scratch.keep(at.unionAll(more))
    ship(spark)

    def sorted_block(group: pa.Table) -> tuple[str, int, np.ndarray, np.ndarray]:
        group = group.sort_by("pos")
        return group["_split"][0].as_py(), group["block"][0].as_py(), group["before"].to_numpy(), group["_size"].to_numpy()

    def enter(group: pa.Table) -> pa.Table:
        name, block, before, size = sorted_block(group)
        found = exits(before, size, wide, per_shard, room)[: per_shard if block else 1]
        to = [block * wide + int(e) if e < len(before) else None for e in found]
        return pa.table({"_split": pa.array([name] * len(found), pa.string()), "at": pa.array(block * wide + np.arange(len(found)), pa.int64()), "to": pa.array(to, pa.int64())})

    jumps = scratch.keep(seen.groupBy("_split", "block").applyInArrow(enter, "_split string, at long, to long").where("to is not null"))
    reached = scratch.keep(held.select("_split").distinct().withColumn("at", F.lit(0).cast("long")))
    while not jumps.isEmpty():
        last = (jumps, reached)
        ends = reached.join(jumps, ["_split", "at"]).select("_split", F.col("to").alias("at"))
        reached = scratch.keep(reached.unionAll(ends))
        jumps = scratch.keep(jumps.join(jumps.select("_split", F.col("at").alias("to"), F.col("to").alias("_to")), ["_split", "to"]).select("_split", "at", F.col("_to").alias("to")))
        scratch.drop(*last)

    def fill(group: pa.Table) -> pa.Table:
        name, block, before, size = sorted_block(group)
        entry = group["entry"][0].as_py()
        inside = min(wide, len(before))
        first = inside if entry is None else entry - block * wide
        starts = starts_from(first, before, size, inside, per_shard, room)
        number = np.searchsorted(starts, np.arange(inside), side="right") - 1
        return pa.table({"_split": pa.array([name] * inside, pa.string()), "block": pa.array([block] * inside, pa.int64()), "pos": pa.array(block * wide + np.arange(inside), pa.int64()), "nth": pa.array(number, pa.int64()), "starts": pa.array([len(starts)] * inside, pa.int64())})

    entries = reached.select("_split", F.floor(F.col("at") / wide).cast("long").alias("block"), F.col("at").alias("entry"))
    numbered = scratch.keep(seen.join(entries, ["_split", "block"], "left").groupBy("_split", "block").applyInArrow(fill, "_split string, block long, pos long, nth long, starts long"))
    ahead = Window.partitionBy("_split").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = numbered.groupBy("_split", "block").agg(F.max("starts").alias("_n")).select("_split", "block", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    shard = numbered.join(counts, ["_split", "block"]).select("_split", "pos", (F.col("_ahead") + F.col("nth")).alias("shard"))
    return held.join(shard, ["_split", "pos"]).select(*rows.columns, "shard", "pos")


def tar_shards(df: DataFrame, ident: str, split: str, per_shard: int = 1000, most_bytes: int | None = None) -> DataFrame:
    """One row a shard, with the bytes of a tar file: a JSON member for each sample, sorted by id, all times 0.

    A shard has ``per_shard`` samples at most, and ``most_bytes`` bytes where given, which bounds what a task holds; with a byte limit, the
    samples are filled in by the order of their ids' hashes, as one pass over a split would. Null splits are named by an empty string.
    """
    ship(df.sparkSession)
    body = canonical_json(F.to_json(F.struct(*sorted(df.columns))))
    if most_bytes is None:
        numbered = numbered_shards(df, ident, split, per_shard)
        samples = numbered.select(F.col(split).alias("split"), "shard", F.col(ident).cast("string").alias("member"), body.alias("body"))
    else:
        samples = df.select(F.col(split).cast("string").alias("split"), F.col(ident).cast("string").alias("member"), body.alias("body")).withColumn("_bytes", tar_bytes(F.col("body")))
        samples = filled_shards(samples, "split", [F.sha2("member", 256), F.col("member")], "_bytes", per_shard, room_for(most_bytes)).select("split", "shard", "member", "body")

    def pack(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group["member"].to_pylist(), group["body"].to_pylist(), strict=True), key=lambda r: (r[0] is not None, r))
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w", format=tarfile.USTAR_FORMAT) as tar:
            for member, text in rows:
                data = text.encode()
                info = tarfile.TarInfo(f"{member}.json")
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
        s, k = group["split"][0].as_py() or "", group["shard"][0].as_py()
        return pa.table({"split": pa.array([s], pa.string()), "shard": pa.array([k], pa.int64()), "name": [f"{s}-{k:06d}.tar"], "n_samples": pa.array([len(rows)], pa.int64()), "body": pa.array([out.getvalue()], pa.binary())})

    packed = samples.groupBy("split", "shard").applyInArrow(pack, "split string, shard long, name string, n_samples long, body binary")
    return packed.select("split", "shard", "name", "n_samples", F.octet_length("body").cast("long").alias("n_bytes"), F.sha2("body", 256).alias("sha256"), "body")


def write_shards(shards: DataFrame, folder: str) -> DataFrame:
    """Writes each shard's bytes as a file of its name in ``folder``, and the index of names, sizes and digests as JSON lines beside them,
    after all files. A file is written under another name and renamed, so that it is whole or absent, also if its task runs twice. Returns the index.
    """
    ship(shards.sparkSession)

    def put(batches):
        for batch in batches:
            fs, base = pyarrow.fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
            fs.create_dir(base, recursive=True)
            for name, body in zip(batch.column("name").to_pylist(), batch.column("body").to_pylist(), strict=True):
                part = f"{base}/.{name}.{uuid.uuid4().hex}"
                with fs.open_output_stream(part) as f:
                    f.write(body)
                fs.move(part, f"{base}/{name}")
            yield batch.select(["split", "shard", "name", "n_samples", "n_bytes", "sha256"])

    index = shards.mapInArrow(put, SHARD_SCHEMA.removesuffix(", body binary"))
    index.write.mode("errorifexists").json(f"{folder}/index")
    return shards.sparkSession.read.schema(SHARD_SCHEMA.removesuffix(", body binary")).json(f"{folder}/index")


def shard_index(shards: DataFrame) -> DataFrame:
    """The shards' names, sizes and digests without their bytes."""
    return shards.drop("body")


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other: side and row count; none if the tables are equal."""
    gone = left.exceptAll(right).agg(F.count("*").alias("n")).withColumn("side", F.lit("left_only"))
    new = right.exceptAll(left).agg(F.count("*").alias("n")).withColumn("side", F.lit("right_only"))
    return gone.union(new).where("n > 0").select("side", "n")
