"""Draws with replacement, bootstrap intervals and headings in order, each against a plain version."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrymill.functions.wording import headings_in_order
from quarrymill.operators.metrics import POISSON, bootstrap_mean
from quarrymill.operators.sampling import UNIT, claimed_negatives, hard_negative_batches, weighted_draws


def plain_draws(rows, n, seed):
    units = [(i, round(w * UNIT)) for i, w in sorted(rows) if w and w > 0 and math.isfinite(w)]
    ends = np.cumsum([u for _, u in units])
    place = lambda k: int(hashlib.md5(f"{seed}:{k}".encode()).hexdigest()[:15], 16) * int(ends[-1]) >> 60
    return [(k, units[int(np.searchsorted(ends, place(k), side="right"))][0]) for k in range(n)]


@pytest.mark.parametrize("block", [1 << 16, 7])
def test_draws(spark, block):
    rng = random.Random(block)
    rows = [(i, rng.choice([0.0, 0.5, 1.0, 3.25, None, float("nan"), float("inf"), -1.0])) for i in range(200)] + [(999, 500.0)]
    df = spark.createDataFrame(rows, "id long, w double")
    got = sorted(map(tuple, weighted_draws(df.repartition(5), "id", "w", 3000, 11, block).collect()))
    assert got == plain_draws(rows, 3000, 11) == sorted(map(tuple, weighted_draws(df.coalesce(1), "id", "w", 3000, 11, block).collect()))
    share = sum(i == 999 for _, i in got) / 3000
    expected = 500 / sum(w for _, w in rows if w and w > 0 and math.isfinite(w))
    assert abs(share - expected) < 5 * math.sqrt(expected * (1 - expected) / 3000)


def test_no_draws(spark):
    df = spark.createDataFrame([(1, 0.0), (2, None)], "id long, w double")
    assert weighted_draws(df, "id", "w", 9).count() == 0 and weighted_draws(df.limit(0), "id", "w", 9).count() == 0


def test_bootstrap_equals_numpy(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "ab"[i % 2], float(x)) for i, x in enumerate(rng.exponential(size=300))] + [(400, "c", 2.0), (401, "d", None)]
    got = {r["g"]: r for r in bootstrap_mean(spark.createDataFrame(rows, "id long, g string, x double"), "id", "x", "g", replicates=80).collect()}
    assert set(got) == {"a", "b", "c"}
    unit = lambda i, r: int(hashlib.md5(f"0:{i}:{r}".encode()).hexdigest()[:12], 16) / 2**48
    for g in "abc":
        mine = [(i, x) for i, k, x in rows if k == g and x is not None]
        means = []
        for r in range(80):
            w = np.array([sum(unit(i, r) >= p for p in POISSON) for i, _ in mine])
            if w.sum():
                means.append(float((w * np.array([x for _, x in mine])).sum() / w.sum()))
        means.sort()
        assert got[g]["n"] == len(mine) and got[g]["low"] == pytest.approx(means[int(len(means) * 0.025)]) and got[g]["high"] == pytest.approx(means[math.ceil(len(means) * 0.975) - 1])


def test_bootstrap_covers_the_true_mean(spark):
    """Of 60 samples of a known mean, nearly all intervals at 95 % hold it."""
    rng = np.random.default_rng(9)
    rows = [(s * 1000 + i, s, float(x)) for s in range(60) for i, x in enumerate(rng.normal(5, 2, size=80))]
    found = bootstrap_mean(spark.createDataFrame(rows, "id long, s long, x double"), "id", "x", "s", replicates=200)
    assert found.where("low <= 5 and high >= 5").count() >= 51
    assert bootstrap_mean(spark.createDataFrame(rows[:80], "id long, s long, x double"), "id", "x").count() == 1


def plain_headings(headings, text):
    kept, used, cursor = [], set(), 0
    for h in headings:
        if not h:
            continue
        at = text.find(h, cursor)
        at = text.find(h) if at < 0 else at
        if at < 0 or (at, at + len(h)) in used:
            continue
        used.add((at, at + len(h)))
        kept.append(h)
        cursor = at + len(h)
    return kept


def test_headings(spark):
    rng = random.Random(8)
    rows = [([rng.choice(["ab", "a", "b", "abc", "c a", "", None, "zz"]) for _ in range(rng.randrange(7))], "".join(rng.choice("abc ") for _ in range(rng.randrange(25)))) for _ in range(300)]
    df = spark.createDataFrame([(i, h, t) for i, (h, t) in enumerate(rows)] + [(900, None, "x"), (901, ["x"], None)], "i int, h array<string>, t string")
    got = {r["i"]: r["k"] for r in df.select("i", headings_in_order(F.col("h"), F.col("t")).alias("k")).collect()}
    assert got.pop(900) == [] and got.pop(901) == []
    assert all(got[i] == plain_headings(h, t) for i, (h, t) in enumerate(rows))


def plain_claims(rows, order, most):
    used, out = set(), {}
    for a in order:
        if a in used:
            continue
        used.add(a)
        out[a] = (a, 0)
        for x in dict.fromkeys(rows[a] or []):
            if x in rows and x not in used and out and sum(v[0] == a for v in out.values()) <= most:
                used.add(x)
                out[x] = (a, sum(v[0] == a for v in out.values()))
    return out


@pytest.mark.parametrize(("n", "most", "kind"), [(40, 3, "random"), (60, 1, "random"), (30, 7, "hub"), (200, 2, "chain")])
def test_claims_and_batches(spark, n, most, kind):
    rng = random.Random(n)
    lists = {"random": lambda i: [rng.choice([*range(n), 999, None, i]) for _ in range(rng.randrange(6))] or None, "hub": lambda i: [0, 1, (i + 1) % n], "chain": lambda i: [i + 1]}
    rows = {i: lists[kind](i) for i in range(n)}
    df = spark.createDataFrame(list(rows.items()), "id long, negatives array<long>").repartition(3)
    order = [r["id"] for r in df.orderBy(F.xxhash64(F.lit(5), F.col("id")), "id").collect()]
    expected = plain_claims(rows, order, most)
    got = {r["id"]: (r["anchor"], r["place"]) for r in claimed_negatives(df, "id", "negatives", most, 5).collect()}
    members = lambda claims: {a: sorted(x for x, (b, _) in claims.items() if b == a) for a in {b for b, _ in claims.values()}}
    assert members(got) == members(expected)
    batches = {}
    for r in hard_negative_batches(df, "id", "negatives", most + 1, 5).collect():
        batches.setdefault(r["batch"], []).append(r)
    assert sorted(r["id"] for b in batches.values() for r in b) == list(range(n)) and max(map(len, batches.values())) <= most + 1
    assert all(len({r["batch"] for b in batches.values() for r in b if r["anchor"] == a}) == 1 for a in members(got))


def test_poisson_times_of_digits_as_of_numbers(spark):
    """Digits are compared as the numbers that they stand for, at each limit and beside it, and most draws end at the first comparisons."""
    import math

    from quarrymill.operators.metrics import poisson_times

    at = sorted({min(max(math.ceil(p * 2**48) + d, 0), 2**48 - 1) for p in POISSON for d in (-1, 0, 1)} | {0, 2**48 - 1})
    got = spark.createDataFrame([(i, f"{i:012x}") for i in at], "i long, d string").withColumn("n", poisson_times(F.col("d"))).collect()
    assert [(r["i"], r["n"]) for r in got] == [(i, sum(i / 2**48 >= p for p in POISSON)) for i in at]


def test_headings_of_a_long_text_take_no_square_of_it(spark):
    """A text of 40,000 lines, each a heading: looking through all places taken for each would be 800 million steps."""
    import time

    lines = [f"heading number {i} of the text" for i in range(40_000)]
    rows = [(1, lines, " ".join(lines)), (2, [], "x"), (3, None, "x"), (4, ["x", None, "", "x", "x y"], "x y x"), (5, ["x"], None)]
    df = spark.createDataFrame(rows, "id long, h array<string>, t string")
    began = time.time()
    got = {r["id"]: r["kept"] for r in df.select("id", headings_in_order(F.col("h"), F.col("t")).alias("kept")).collect()}
    assert got == {1: lines, 2: [], 3: [], 4: ["x", "x", "x y"], 5: []}
    assert time.time() - began < 20
