"""The manifest against trees built in plain Python, also with runs of a few nodes so that there are several stored levels."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quarrymill.llm import merkle
from quarrymill.llm.merkle import folded, leaf_digest, merkle_manifest, siblings

KIND = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, i):
    out = []
    for nodes in levels[:-1]:
        other = i ^ 1
        out.append(("", None) if other >= len(nodes) else (nodes[other], other < i))
        i //= 2
    return out


def refolded(node, steps):
    for sibling, left in steps:
        node = H(sibling, node) if left else H(node, sibling)
    return node


def brute(docs):
    """Rows of the query, sorted by text."""
    groups = sorted({d[2] for d in docs}, key=lambda g: (g is not None, (g or "").encode()))
    rows = {g: sorted([(d[0] is not None, d[0] or 0, leaf(d), d) for d in docs if d[2] == g], key=lambda r: r[:3]) for g in groups}
    trees = {g: tree([r[2] for r in rows[g]]) for g in groups}
    over = tree([trees[g][-1][0] for g in groups]) if groups else []
    out = []
    for k, g in enumerate(groups):
        for i, (_, _, own, d) in enumerate(rows[g]):
            steps = path(trees[g], i) + path(over, k)
            tampered = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0
            used = leaf((d[0], d[1], d[2], d[3] + 1, d[4])) if tampered and d[3] is not None else own
            top = refolded(used, steps)
            out.append((d[0], own, trees[g][-1][0], over[-1][0], H(*[s for s, _ in steps]), top, top == over[-1][0]))
    return sorted(out, key=str)


def manifest(spark, docs):
    """As the query does, from rows of KIND and columns whose names clash."""
    df = spark.createDataFrame(docs, KIND).repartition(3)
    own = lambda n: leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text"))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, own(F.col("n_chars") + 1))
    rows = df.select("doc_id", "lang", own(F.col("n_chars")).alias("own"), tampered.alias("pos"), F.lit(1).alias("tree"), F.lit("x").alias("proof"))
    found = merkle_manifest(rows, F.col("lang"), F.col("doc_id"), F.col("own"))
    assert set(found.columns) == {"doc_id", "lang", "own", "pos", "tree", "leaf", "subroot", "root", "proof"}
    found = found.withColumn("top", folded(F.coalesce("pos", "leaf"), F.col("proof")))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(siblings(F.col("proof")), ""), 256), "top", F.col("top") == F.col("root"))


def documents(n, groups, seed):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(n)]) if seed % 2 else i, rng.choice([None, "s", ""]), rng.choice(groups), rng.choice([None, i]), rng.choice([None, "", "é 😀", "x" * 5000])) for i in range(n)]


@pytest.mark.parametrize(("n", "groups", "band"), [(1, ["a"], 10), (1, [None], 1), (7, ["a"], 1), (40, ["a", None, "", "é", "zz"], 2), (33, ["a"], 2), (129, ["a", "b"], 10), (30, [str(i) for i in range(9)], 2)])
def test_against_plain_trees(spark, monkeypatch, n, groups, band):
    monkeypatch.setattr(merkle, "BAND", band)
    docs = documents(n, groups, n)
    assert sorted(map(tuple, manifest(spark, docs).collect()), key=str) == brute(docs)


def test_repeated_rows_and_nothing(spark):
    docs = [(5, "s", "a", 1, "t")] * 9 + [(5, "s", "a", 1, "u")] * 3 + [(None, None, None, None, None)] * 2
    assert sorted(map(tuple, manifest(spark, docs).collect()), key=str) == brute(docs)
    assert manifest(spark, []).count() == 0


def test_query(spark):
    from quarrymill.llm.queries import op13_merkle_manifest
    from tests.test_queries import SF

    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert sorted(map(tuple, op13_merkle_manifest(spark, SF).collect()), key=str) == brute(docs)
