"""Samples read from tar shards, a partition a shard, and snapshots of typed entities."""

from __future__ import annotations

import hashlib
import io
import json
import tarfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quarrymill.sources.ship import ship
from quarrymill.sources.tables import read_jsonl, require_version

READ_SCHEMA = "split string, shard long, name string, member string, body string"


def opened(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder, and the folder there; a folder without a scheme is one that all executors have."""
    return pyarrow.fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


@dataclass
class Shard(InputPartition):
    split: str
    shard: int
    name: str
    n_samples: int
    sha256: str


class ShardReader(DataSourceReader):
    def __init__(self, folder: str, splits: list[str] | None, first: int, last: int | None):
        self.folder, self.splits, self.first, self.last = folder, splits, first, last

    def wanted(self, s: Shard) -> bool:
        return (self.splits is None or s.split in self.splits) and self.first <= s.shard and (self.last is None or s.shard <= self.last)

    def partitions(self) -> Sequence[InputPartition]:
        fs, base = opened(self.folder)
        rows = []
        for info in fs.get_file_info(pyarrow.fs.FileSelector(f"{base}/index")):
            if info.is_file and info.base_name.endswith(".json"):
                with fs.open_input_stream(info.path) as f:
                    rows += [json.loads(line) for line in f.read().splitlines() if line.strip()]
        shards = [Shard(r.get("split") or "", r["shard"], r["name"], r["n_samples"], r["sha256"]) for r in rows]
        return sorted(filter(self.wanted, shards), key=lambda s: s.name)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        fs, base = opened(self.folder)
        with fs.open_input_stream(f"{base}/{partition.name}") as f:
            whole = f.read()
        if hashlib.sha256(whole).hexdigest() != partition.sha256:
            raise ValueError(f"shard {partition.name} is damaged: its digest is not that of the index")
        members, bodies = [], []
        with tarfile.open(fileobj=io.BytesIO(whole)) as tar:
            for info in tar:
                members.append(info.name.removesuffix(".json"))
                bodies.append(tar.extractfile(info).read().decode())
        if len(members) != partition.n_samples:
            raise ValueError(f"shard {partition.name} has {len(members)} samples, the index says {partition.n_samples}")
        n = len(members)
        yield pa.RecordBatch.from_arrays(
            [pa.array([partition.split] * n, pa.string()), pa.array([partition.shard] * n, pa.int64()), pa.array([partition.name] * n, pa.string()), pa.array(members, pa.string()), pa.array(bodies, pa.string())],
            names=[x.split()[0] for x in READ_SCHEMA.split(", ")],
        )


class ShardSource(DataSource):
    """Format ``tar_shards``: a folder with tar files of JSON members and their index. Options splits (a JSON list), first and last (shard numbers)
    leave other shards unopened. They are options, not pushed filters, as Spark 4.1 keeps a filter pushed by one query for later
    ones on the same DataFrame, which would then miss rows."""

    @classmethod
    def name(cls) -> str:
        return "tar_shards"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        o = self.options
        return ShardReader(o["path"], json.loads(o["splits"]) if "splits" in o else None, int(o.get("first", 0)), int(o["last"]) if "last" in o else None)


def read_shards(spark: SparkSession, folder: str, schema: T.StructType | None = None, splits: list[str] | None = None, first: int = 0, last: int | None = None) -> DataFrame:
    """Samples of a folder that ``write_shards`` has written, typed by ``schema`` where given (split, shard, name, member, then its fields).

    A shard is a partition; shards of other ``splits``, and those before ``first`` or after ``last``, aren't opened. The digest and number of
    samples are checked before a shard's first row, and what differs fails with the shard's name. The driver reads the index, a row a shard.
    """
    ship(spark)
    spark.dataSource.register(ShardSource)
    chosen = {"first": first} | ({"splits": json.dumps(splits)} if splits is not None else {}) | ({"last": last} if last is not None else {})
    rows = spark.read.format("tar_shards").options(**chosen).load(folder)
    if schema is None:
        return rows
    parsed = rows.withColumn("_r", F.from_json("body", schema))
    clash = {"split", "shard", "name", "member"}
    return parsed.select("split", "shard", "name", "member", *[F.col("_r")[f.name].alias(f.name) for f in schema.fields if f.name not in clash])


def contract_digest(schema: T.StructType) -> str:
    return hashlib.sha256(schema.json().encode()).hexdigest()


def write_snapshot(entities: dict[str, DataFrame], folder: str, version: str) -> None:
    """Each entity as JSON lines in a folder of its name with its schema_version, and, after all of them, the manifest of versions and contracts."""
    for name, df in entities.items():
        df.withColumn("schema_version", F.lit(version)).write.mode("errorifexists").json(f"{folder}/{name}")
    spark = next(iter(entities.values())).sparkSession
    manifest = [(json.dumps({"schema_version": version, "contracts": {name: contract_digest(df.schema) for name, df in entities.items()}}, sort_keys=True),)]
    spark.createDataFrame(manifest, "value string").coalesce(1).write.mode("errorifexists").text(f"{folder}/manifest")


def read_snapshot(spark: SparkSession, folder: str, schemas: dict[str, T.StructType], version: str) -> dict[str, DataFrame]:
    """All entities of a snapshot, typed, or an error: without a manifest, with another version or contract, and, when they are read, for rows
    that aren't of their types or of another version. No part of a bad snapshot is returned."""
    lines = spark.read.text(f"{folder}/manifest").collect()  # one line
    manifest = json.loads(lines[0]["value"]) if lines else {}
    if manifest.get("schema_version") != version:
        raise ValueError(f"snapshot {folder} has version {manifest.get('schema_version')!r}, not {version!r}")
    out = {}
    for name, schema in schemas.items():
        if manifest.get("contracts", {}).get(name) != contract_digest(schema):
            raise ValueError(f"snapshot {folder}: the contract of {name} is not the manifest's")
        good, bad = read_jsonl(spark, f"{folder}/{name}", T.StructType([*schema.fields, T.StructField("schema_version", T.StringType())]))
        message = F.concat(F.lit(f"snapshot {folder}: {name} has a row that is "), F.col("reason"))
        failed = bad.where(F.when(F.col("reason").isNotNull(), F.raise_error(message).cast("string")).isNotNull())
        rows = require_version(good.drop("source_file"), "schema_version", (version,)).where("schema_version is not null").drop("schema_version")
        out[name] = rows.unionByName(failed.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]))
    return out
