"""State and upserts: a registry over a table, a stream that is stopped and restarted, a stored table with replayed and broken batches, splits."""

import random
from collections import OrderedDict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.operators import split as splits
from quarrymill.sources.store import StoredTable
from quarrymill.streaming.registry import registry, sight, stream_registry

START = datetime(2024, 1, 1)
KIND = "id long, url string, at timestamp"


def rows_of(n, seed):
    rng = random.Random(seed)
    return [(i, rng.choice(["a", "b", "c", "d", " e ", "f"]) + "x" * rng.randrange(2), START + timedelta(seconds=i * 3)) for i in range(n)]


def plain(rows, capacity, ttl):
    seen, out = OrderedDict(), {}
    for i, url, at in sorted(rows, key=lambda r: (r[2], r[0])):
        out[i] = sight(seen, at.timestamp(), url.strip(), capacity, ttl)
    return out


@pytest.mark.parametrize(("capacity", "ttl"), [(3, 1e9), (100, 10), (4, 20), (1, 5)])
def test_registry(spark, capacity, ttl):
    rows = rows_of(200, capacity)
    df = spark.createDataFrame(rows + [(900, None, START), (901, "  ", START), (902, "q", None)], KIND).repartition(3)
    got = {r["id"]: r["state_out"] for r in registry(df, "url", "at", "id", capacity, ttl, buckets=1).collect()}
    assert got == plain(rows, capacity, ttl) and set(got.values()) <= {"new", "seen"}


def test_oldest_goes_first():
    seen = OrderedDict()
    assert [sight(seen, t, k, 2, 100) for t, k in enumerate("abacb")] == ["new", "new", "seen", "new", "new"] and list(seen) == ["c", "b"]


def test_stream_restarts(spark, tmp_path):
    """Files one by one, a stop after two, a restart from the checkpoint; a row far behind is left out."""
    rows = rows_of(120, 5)
    source, sink, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")

    def put(part):
        spark.createDataFrame(part, KIND).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(KIND).option("maxFilesPerTrigger", 1).parquet(source)
        out = stream_registry(stream, "url", "at", "id", 4, 30, "10 seconds", buckets=1)
        out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination(120)

    put(rows[:40])
    put(rows[40:80])
    run()
    put([(999, "late", START - timedelta(hours=5))])
    run()
    put(rows[80:])
    run()
    run()
    got = {r["id"]: r["state_out"] for r in spark.read.parquet(sink).collect()}
    assert 999 not in got and got == plain(rows, 4, 30)


SCHEMA = T.StructType([T.StructField("url", T.StringType()), T.StructField("body", T.StringType()), T.StructField("at", T.LongType())])


def test_upserts(spark, tmp_path, monkeypatch):
    table = StoredTable(spark, f"file://{tmp_path}/t", SCHEMA, "url", buckets=4)
    batch = lambda *rows: spark.createDataFrame(list(rows), SCHEMA)
    assert table.read().count() == 0
    assert table.apply(batch(("a", "1", 1), ("b", "1", 1), ("b", "2", 2), (None, "x", 1)), "one", "at") == {"insert": 2}
    assert table.apply(batch(("a", "1", 9), ("b", "3", 3), ("c", None, 3)), "two", "at") == {"duplicate": 1, "update": 1, "insert": 1}
    state = lambda: sorted((r["url"], r["body"], r["at"], r["version"]) for r in table.read().collect())
    expected = [("a", "1", 1, 1), ("b", "3", 3, 2), ("c", None, 3, 1)]
    assert state() == expected
    assert table.apply(batch(("a", "other", 99)), "two", "at") == {} and state() == expected  # replayed
    with monkeypatch.context() as m:  # broken off before it is published
        m.setattr(StoredTable, "_publish", lambda self, manifest: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError, match="gone"):
            table.apply(batch(("a", "4", 4), ("d", "1", 4)), "three", "at")
    assert state() == expected
    assert table.apply(batch(("a", "4", 4), ("d", "1", 4)), "three", "at") == {"update": 1, "insert": 1}
    assert state() == [("a", "4", 4, 2), ("b", "3", 3, 2), ("c", None, 3, 1), ("d", "1", 4, 1)]
    assert sorted(r["url"] for r in table.read(1).collect()) == ["a", "b"]
    assert table.apply(batch(("a", "4", 5)), "four", "at") == {"duplicate": 1} and table.apply(batch(), "five", "at") == {}
    with pytest.raises(RuntimeError, match="another writer"):
        table._publish({"number": 2, "batch": "x", "buckets": {}})


def plain_represented(rows):
    """rows: id, group, split, kind; by one pass."""
    rows = [list(r) for r in rows]
    for kind in sorted({r[3] for r in rows}):
        for target, least in (("val", 2), ("test", 3)):
            mine = [r for r in rows if r[3] == kind]
            if len(mine) < least or any(r[2] == target for r in mine):
                continue
            train = {}
            for r in sorted(rows):
                if r[2] == "train":
                    train.setdefault(r[1], []).append(r)
            found = next((g for g, held in train.items() if any(r[3] == kind for r in held)), None)
            if found is not None and len(train) > 1:
                for r in train[found]:
                    r[2] = target
    return sorted(map(tuple, rows))


@pytest.mark.parametrize("seed", range(6))
def test_represented(spark, seed):
    rng = random.Random(seed)
    of_group = {g: rng.choice(["train"] * 6 + ["val", "test"]) for g in range(12)}
    rows = [(i, str(g := rng.randrange(12)), of_group[g], rng.choice("tiav")) for i in range(rng.choice([4, 15, 40]))]
    df = spark.createDataFrame(rows, "id long, g string, split string, kind string").repartition(3)
    got = splits.represented(df, "g", "split", "kind", "id")
    assert sorted(map(tuple, got.collect())) == plain_represented(rows)
    assert splits.crossing_groups(got, "g").count() == 0


def test_leaks_and_minimums(spark):
    df = spark.createDataFrame([(1, "g", "train", "a"), (2, "g", "val", "a"), (3, "h", "train", "b")], "id long, g string, split string, kind string")
    with pytest.raises(Exception, match="group in two splits: g"):
        splits.represented(df, "g", "split", "kind", "id").collect()
    good = spark.createDataFrame([(i, f"g{i}", "train", "ab"[i % 2]) for i in range(12)], "id long, g string, split string, kind string")
    out = splits.rebalanced_fully(good, "g", "split", "kind", "kind", "id", minimum=3, strict=True)
    assert {r["split"]: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 6, "val": 3, "test": 3}
    with pytest.raises(ValueError, match="too few"):
        splits.rebalanced_fully(good, "g", "split", "kind", "kind", "id", minimum=50, strict=True)
    assert splits.represented(good.where(F.lit(False)), "g", "split", "kind", "id").count() == 0
