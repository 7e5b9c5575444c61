"""Shards bounded by bytes against one pass over a split; their reader; canonical JSON; snapshots."""

import io
import json
import random
import tarfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.functions.canonical import canonical_json, fingerprint
from quarrymill.sources import shards, sinks


def one_pass(sizes, per_shard, room):
    """The number of each row's shard."""
    out, shard, n, total = [], 0, 0, 0
    for s in sizes:
        if n and (n + 1 > per_shard or total + s > room):
            shard, n, total = shard + 1, 0, 0
        out.append(shard)
        n, total = n + 1, total + s
    return out


@pytest.mark.parametrize(("n", "per_shard", "room", "blocks", "most"), [(1000, 7, 100, 3, 100), (997, 50, 60, 1, 20), (300, 4, 10**9, 2, 9), (500, 100, 30, 1, 30), (5, 9, 50, 16, 9)])
def test_filled_like_one_pass(spark, n, per_shard, room, blocks, most):
    rng = random.Random(n)
    rows = [(i, rng.choice(["a", "b", None]) if n != 5 else "a", rng.randint(1, most), -1) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, split string, bytes long, _mine int").repartition(3)
    found = {r["id"]: r["shard"] for r in sinks.filled_shards(df, "split", [F.col("id")], "bytes", per_shard, room, blocks).collect()}
    for name in ("a", "b", None):
        part = [r for r in rows if r[1] == name]
        assert [found[r[0]] for r in part] == one_pass([r[2] for r in part], per_shard, room)


def test_a_hundred_thousand_rows(spark):
    df = spark.range(100_000).select("id", F.lit("train").alias("split"), (F.pmod(F.xxhash64("id"), F.lit(900)) + 1).alias("bytes"))
    found = sinks.filled_shards(df, "split", [F.col("id")], "bytes", 100, 20_000)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan or "windowspecdefinition(_split#" not in plan or "block#" in plan
    rows = sorted((r["id"], r["bytes"], r["shard"]) for r in found.collect())
    assert [r[2] for r in rows] == one_pass([r[1] for r in rows], 100, 20_000)


def test_too_large_and_nothing(spark):
    df = spark.createDataFrame([(1, "a", 11)], "id long, split string, bytes long")
    with pytest.raises(Exception, match="11 bytes exceeds"):
        sinks.filled_shards(df, "split", [F.col("id")], "bytes", 4, 10).collect()
    assert sinks.filled_shards(df.limit(0), "split", [F.col("id")], "bytes", 4, 10).count() == 0


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('shards')}/out"
    index = sinks.write_shards(sinks.tar_shards(samples(spark), "id", "split", 40, 3 * 10240), path)
    return path, index.collect()


def samples(spark):
    rows = [(i, ["train", "val", "test"][i % 5 % 3], "tä\"xt\n" * (i % 90), None if i % 7 else 1.5) for i in range(300)]
    return spark.createDataFrame(rows, "id long, split string, text string, score double")


def test_shards_keep_both_limits(spark, folder):
    path, index = folder
    assert sum(r["n_samples"] for r in index) == 300 and max(r["n_samples"] for r in index) <= 40
    assert max(r["n_bytes"] for r in index) <= 3 * 10240 and {r["n_bytes"] for r in index} > {3 * 10240}
    with tarfile.open(f"{path}/{index[0]['name']}") as tar:
        info = tar.getmembers()[0]
        assert info.mtime == 0 and json.dumps(body := json.loads(tar.extractfile(info).read()), sort_keys=True) and str(body["id"]) + ".json" == info.name


def test_round_trip_and_pruning(spark, folder):
    path, index = folder
    schema = T.StructType.fromDDL("id long, text string, score double")
    read = shards.read_shards(spark, path, schema)
    expected = sorted(map(tuple, samples(spark).select("split", "id", "text", "score").collect()), key=str)
    assert sorted(map(tuple, read.select("split", "id", "text", "score").collect()), key=str) == expected
    one = next(r for r in index if r["split"] == "val")
    with open(f"{path}/{one['name']}", "r+b") as f:  # damage one shard
        f.seek(600)
        byte = f.read(1)
        f.seek(600)
        f.write(bytes([byte[0] ^ 1]))
    try:
        with pytest.raises(Exception, match=f"{one['name']} is damaged"):
            read.count()
        assert shards.read_shards(spark, path, splits=["train"]).count() == sum(r["n_samples"] for r in index if r["split"] == "train")
        assert shards.read_shards(spark, path, splits=["val"], first=one["shard"] + 1).count() == sum(r["n_samples"] for r in index if r["split"] == "val" and r["shard"] > one["shard"])
    finally:
        with open(f"{path}/{one['name']}", "r+b") as f:
            f.seek(600)
            f.write(byte)
    assert read.count() == 300 and shards.read_shards(spark, path, last=0).select("split").distinct().count() == 3
    assert read.where("split = 'test' and id < 30").count() < read.count() == 300


def test_canonical_json(spark):
    values = ['{"b":"x y","a":1}', '{"a":null}', '{"z":[1,{"y":"\\u00e9\\"\\n","x":[]}],"a":{"c":true,"b":-0.5}}', '"\\u001f/"', "[1e5, 12345678901234567890, 1.0]", '{"a":1,"a":2}', "{", "", None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", canonical_json(F.col("v")).alias("c"), fingerprint(F.col("v")).alias("f")).orderBy("i").collect()
    for v, r in zip(values, rows, strict=True):
        expected = json.dumps(json.loads(v), sort_keys=True, separators=(",", ":"), ensure_ascii=False) if v and v != "{" else None
        assert r["c"] == expected and (r["f"] is None) == (expected is None)


def test_snapshot(spark, tmp_path):
    docs, chunks = spark.createDataFrame([(1, "a"), (2, None)], "id long, text string"), spark.createDataFrame([(1, 2)], "doc long, at int")
    schemas = {"documents": docs.schema, "chunks": chunks.schema}
    shards.write_snapshot({"documents": docs, "chunks": chunks}, f"{tmp_path}/s", "v2")
    read = shards.read_snapshot(spark, f"{tmp_path}/s", schemas, "v2")
    assert sorted(map(tuple, read["documents"].collect())) == [(1, "a"), (2, None)] and read["chunks"].count() == 1
    with pytest.raises(ValueError, match="version"):
        shards.read_snapshot(spark, f"{tmp_path}/s", schemas, "v3")
    with pytest.raises(ValueError, match="contract of chunks"):
        shards.read_snapshot(spark, f"{tmp_path}/s", {"chunks": docs.schema}, "v2")
    (tmp_path / "s" / "documents" / "extra.json").write_text('{"id":"no number","text":"x","schema_version":"v2"}\n')
    with pytest.raises(Exception, match="malformed"):
        shards.read_snapshot(spark, f"{tmp_path}/s", schemas, "v2")["documents"].collect()
