"""A stored table that takes batches of records: new ones are inserted, changed ones replaced, and a batch that comes twice changes nothing."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class StoredTable:
    """Rows by key, in ``buckets`` parts by the key's hash, each a folder of Parquet files that never changes.

    A version is a manifest: where each bucket's rows are, and the id of the batch that made it. A batch reads and writes only the buckets
    that it has rows for, in a folder of its own, and publishes its manifest last, under a name that can be taken once. So what a failed
    batch has left is never read, and of two writers one gets an error. Rows get ``version`` (1, 2, ... for each key) and ``content`` (the digest
    of their other columns).
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, key: str, buckets: int = 64):
        self.spark, self.folder, self.key, self.buckets = spark, folder, key, buckets
        self.columns = [f.name for f in schema.fields]
        self.schema = T.StructType([*schema.fields, T.StructField("content", T.StringType()), T.StructField("version", T.LongType())])

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def manifests(self) -> list[dict]:
        """All published versions, oldest first: a line each."""
        path, fs = self._path("manifests")
        if not fs.exists(path):
            return []
        rows = self.spark.read.text(f"{self.folder}/manifests", pathGlobFilter="v*.json").collect()  # one line a batch
        return sorted((json.loads(r["value"]) for r in rows), key=lambda m: m["number"])

    def _publish(self, manifest: dict) -> None:
        name = f"v{manifest['number']:09d}.json"
        part, fs = self._path(f"manifests/.{name}.{uuid.uuid4().hex}")
        out = fs.create(part)
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()
        final, _ = self._path(f"manifests/{name}")
        if fs.exists(final) or not fs.rename(part, final):
            fs.delete(part, False)
            raise RuntimeError(f"version {manifest['number']} of {self.folder} was published by another writer")

    def _rows(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of the last version, or of an earlier one."""
        found = [m for m in self.manifests() if number is None or m["number"] <= number]
        return self._rows(sorted(found[-1]["buckets"].values()) if found else [])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def decide(self, batch: DataFrame, order: str) -> tuple[DataFrame, dict]:
        """One row for each key of the batch (its last by ``order``) with ``decision``: insert, update, or duplicate where the content is the
        stored one; and the manifest that this is decided by. Rows without a key go."""
        published = self.manifests()
        last = published[-1] if published else {"number": 0, "buckets": {}}
        value = lambda c: F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
        content = F.sha2(F.concat_ws("|", *[value(c) for c in self.columns if c not in (self.key, order)]), 256)
        rows = batch.select(*self.columns).where(F.col(self.key).isNotNull()).withColumn("content", content)
        newest = rows.groupBy(self.key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != self.key]), F.struct(order, "content")).alias("r")).select(self.key, "r.*")
        newest = newest.withColumn("_bucket", self.bucket())
        touched = {str(r[0]) for r in newest.select("_bucket").distinct().collect()}  # as many as there are buckets
        held = self._rows([p for b, p in sorted(last["buckets"].items()) if b in touched])
        stored = held.select(F.col(self.key).alias("_key"), F.col("content").alias("_content"), F.col("version").alias("_version"))
        joined = newest.join(stored, F.col(self.key) == F.col("_key"), "left")
        decision = F.when(F.col("_key").isNull(), "insert").when(F.col("_content") == F.col("content"), "duplicate").otherwise("update")
        return joined.withColumn("decision", decision).withColumn("version", F.coalesce("_version", F.lit(0)) + (F.col("decision") != "duplicate").cast("long")), last

    def apply(self, batch: DataFrame, batch_id: str, order: str) -> dict[str, int]:
        """Takes a batch; counts of its decisions. A batch whose id is already published changes nothing and counts nothing."""
        if any(m["batch"] == batch_id for m in self.manifests()):
            return {}
        decided, last = self.decide(batch, order)
        place = f"{self.folder}/rows/{last['number'] + 1:09d}-{uuid.uuid4().hex}"
        decided.write.parquet(f"{place}/decided")  # so that counts and rows come from one evaluation
        kept = self.spark.read.schema(decided.schema).parquet(f"{place}/decided")
        counts = {r["decision"]: r["count"] for r in kept.groupBy("decision").count().collect()}
        changed = kept.where("decision <> 'duplicate'")
        touched = sorted(str(r[0]) for r in changed.select("_bucket").distinct().collect())
        held = self._rows([last["buckets"][b] for b in touched if b in last["buckets"]])
        rest = held.join(changed.select(self.key), self.key, "left_anti").select(*self.schema.names).withColumn("_bucket", self.bucket())
        whole = rest.unionByName(changed.select(*self.schema.names, "_bucket"))
        if touched:
            whole.repartition(F.col("_bucket")).write.partitionBy("_bucket").parquet(f"{place}/buckets")
        self._publish({"number": last["number"] + 1, "batch": batch_id, "buckets": last["buckets"] | {b: f"{place}/buckets/_bucket={b}" for b in touched}})
        return counts
