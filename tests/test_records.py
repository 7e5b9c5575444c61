"""Selection, retrieval, records and wording against brute force, with nulls, ties and empty tables."""

import random
from urllib.parse import urljoin

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrymill.functions import selection, unicode, url, wording
from quarrymill.operators import leakage, metrics, records, retrieval, select


def sequential(rows, quotas):
    """rows: (id, keys, quota values). One after the other, as the operator's docstring has it."""
    seen, used, out = set(), {}, {}
    for ident, keys, values in sorted(rows):
        if seen & set(keys):
            out[ident] = "duplicate"
        elif any(most and used.get((i, v or ""), 0) >= most for i, (v, most) in enumerate(zip(values, quotas, strict=True))):
            out[ident] = "quota_exceeded"
        else:
            out[ident] = "accepted"
            seen |= set(keys)
            for i, v in enumerate(values):
                used[i, v or ""] = used.get((i, v or ""), 0) + 1
    return out


def test_select_within_quotas(spark):
    rng = random.Random(1)
    rows = [(i, [f"k{rng.randint(0, 25)}" for _ in range(rng.randint(0, 2))], (rng.choice(["a", "a", "b", None]), rng.choice("xyz"))) for i in range(90)]
    df = spark.createDataFrame([(i, k, *v) for i, k, v in rows], "id long, keys array<string>, domain string, topic string")
    got = {r.id: r.verdict for r in select.select_within_quotas(df, "id", "id", "keys", {"domain": 12, "topic": 9}).collect()}
    assert got == sequential(rows, (12, 9))
    assert set(got.values()) == {"accepted", "duplicate", "quota_exceeded"}
    got = {r.id: r.verdict for r in select.select_within_quotas(df, "id", "id", "keys", {"domain": 0}).collect()}
    assert got == sequential([(i, k, v[:1]) for i, k, v in rows], (0,))
    assert select.select_within_quotas(df.limit(0), "id", "id", "keys", {"domain": 1}).count() == 0


def test_permission_reject(spark):
    rows = [(None, "d", "ok", "open", True, "mit"), ("u", " ", "ok", "open", True, "mit"), ("u", "d", "disallowed", "open", True, "mit"), ("u", "d", "ok", "OPT_OUT", True, "mit"), ("u", "d", "ok", None, None, "mit"), ("u", "d", "ok", None, True, None), ("u", "d", "ok", None, True, "mit")]
    df = spark.createDataFrame(rows, "url string, domain string, robots string, usage string, allow boolean, license string")
    reason = selection.permission_reject(*[F.col(c) for c in df.columns])
    assert [r[0] for r in df.select(reason).collect()] == ["no_source", "no_domain", "robots_disallowed", "usage_rules_blocked", "license_missing", "license_missing", None]


def test_scores(spark):
    one = spark.range(1)
    score = selection.pairability(caption=F.lit(True), transcript=F.lit(True), summary=F.lit(True), alt_text=F.lit(True))
    assert one.select(score).first()[0] == 1.0
    assert one.select(selection.alignment_score(F.lit(True), F.lit(0.9), F.lit(0.5), F.lit(None).cast("double"), F.lit(0.25))).first()[0] == 0.25
    assert one.select(selection.alignment_score(F.lit(False), F.lit(0.9), F.lit(0.5), F.lit(None).cast("double"), F.lit(0.25))).first()[0] == 0.9
    captions = spark.createDataFrame([("A fine photo",), ("<img src=x>",), ("a < b and c > d",), ("href src",), ("",), (None,)], "c string")
    assert [r[0] for r in captions.select(selection.caption_garbage(F.col("c"))).collect()] == [False, True, True, True, False, False]


@pytest.mark.parametrize("block", [2048, 2])
def test_nearest(spark, monkeypatch, block):
    monkeypatch.setattr(retrieval, "BLOCK", block)
    monkeypatch.setattr(metrics, "QUERY_BLOCK", block)
    rng = np.random.default_rng(2)
    v = rng.integers(-3, 4, (60, 5)).astype(float)
    rows = [(i, v[i].tolist(), "s" if i % 3 else "t", i % 4) for i in range(60)] + [(100, None, "s", 0)]
    df = spark.createDataFrame(rows, "id long, v array<double>, split string, family int")
    got = {}
    for r in retrieval.hard_negatives(df.where("id % 20 = 0"), df, "id", "v", "split", "family").collect():
        got.setdefault(r.id, []).append((r.rank, r.negative_id))
    for q in (0, 20, 40):
        others = [i for i in range(60) if i != q and rows[i][2] == rows[q][2] and rows[i][3] != rows[q][3]]
        best = sorted(others, key=lambda i: (-float(v[q] @ v[i]), i))[:4]
        assert sorted(got[q]) == list(enumerate(best, 1))
    best = {r["id"]: (r["best_same"], r["best_other"]) for r in metrics.retrieval_best(df.where("id % 20 = 0 and v is not null"), df.where("v is not null"), "id", "v", "family").collect()}
    for q in (0, 20, 40):
        dots = lambda same: max(float(v[q] @ v[i]) for i in range(60) if i != q and (rows[i][3] == rows[q][3]) == same)
        assert best[q] == (dots(True), dots(False))
    assert retrieval.nearest(df.limit(0), df, "id", "v", 3).count() == 0
    assert retrieval.recall_summary(df.where("id = 0"), df, "id", "v", "family").first().n_queries == 1


def test_rouge(spark):
    rng = random.Random(3)

    def lcs(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        return table[-1][-1]

    rows = [([rng.choice("abcd") for _ in range(rng.randint(0, 30))], [rng.choice("abcd") for _ in range(rng.randint(0, 90))]) for _ in range(60)] + [([], []), (["a"] * 3000, ["a"] * 2000)]
    for a, b in rows[:-1]:
        assert metrics.common_subsequence(a, b) == lcs(a, b)
    got = metrics.rouge_l(spark.createDataFrame(rows, "p array<string>, t array<string>"), "p", "t").collect()
    for r in got:
        n = len(r.p) + len(r.t)
        assert r.f1 == pytest.approx(1.0 if n == 0 else 2 * r.lcs / n)
    assert got[-1].lcs == 2000
    pairs = spark.createDataFrame([(["a", "b", "c"], ["a", "x", "c", "d"]), ([], ["a"])], "p array<string>, t array<string>")
    assert [r[0] for r in pairs.select(metrics.right_in_place(F.col("p"), F.col("t"))).collect()] == [2, 0]


def test_resolved_urls(spark):
    base = "http://Host.example/a/b/c.html?q=1#f"
    good = ["/x", "x", "./x", "../x", "../../x", "../../../x", "x/../y", "?z=2", "//other.example/p", "https://other.example/p?x=1#y", "x/", "..", ".", "/a/./b/../c", "a?b#c", "http://h.example"]
    bad = ["#top", "", None, "mailto:a@b.c", "javascript:x", "http://user@h.example/", "a\\b", "a\nb", "x" * 9000]
    df = spark.createDataFrame([(base, r) for r in good + bad], "b string, r string")
    got = [r[0] for r in df.select(url.resolved(F.col("b"), F.col("r"))).collect()]
    assert got[: len(good)] == [urljoin("http://host.example/a/b/c.html?q=1", r).split("#")[0] for r in good]
    assert got[len(good) :] == [None] * len(bad)


def truncated(text, most):
    """The same by hand."""
    if len(text) <= most:
        return text
    cut = text[:most].rstrip()
    if cut.count("```") % 2 and cut.rfind("```") > 0:
        cut = cut[: cut.rfind("```")].rstrip()
    low = max(1, min(len(cut) - 1, int(most * 0.5)))
    for m in wording.BOUNDARIES:
        at = cut.rfind(m)
        if at >= low:
            return cut[: at + len(m.rstrip())].rstrip()
    spaces = [i for i, c in enumerate(cut) if c.isspace()]
    return (cut[: spaces[-1]] if spaces else cut).rstrip()


def test_wording(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice(["word", " ", ". ", "\n", "\n\n", ", ", "```", "é", "x"]) for _ in range(rng.randint(0, 60))) for _ in range(120)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(wording.truncated(F.col("t"), 40)).collect()] == [truncated(t, 40) for t in texts]
    heads = spark.createDataFrame([("\n##\n # Head one \nrest",), ("plain",), ("###\n \n",), ("",), (None,)], "t string")
    assert [r[0] for r in heads.select(wording.first_heading(F.col("t"))).collect()] == ["Head one", "plain", None, None, None]
    scans = spark.createDataFrame([("exam-\n  ple of  a\n scan ",), ("a-\n-b",), (None,)], "t string")
    assert [r[0] for r in scans.select(wording.joined_hyphens(F.col("t"))).collect()] == ["example of a\nscan", "a-\n-b", None]
    found = spark.createDataFrame([("one Two three", "two"), ("one two", "two"), ("one", "two")], "t string, e string")
    assert [r[0] for r in found.select(wording.located(F.col("t"), F.col("e"))).collect()] == [4, 4, None]
    bands = spark.createDataFrame([([5, 1, 9, 7, 3, 2, 8, 4],), ([2, 1],), ([],)], "h array<bigint>")
    assert [r[0] for r in bands.select(wording.band_signals(F.col("h"))).collect()] == [[1, 3, 5, 8], [1, 2], []]


def test_unicode(spark):
    df = spark.createDataFrame([("ﬁne Ⅳ",), ("Straße",), ("plain",), (None,)], "t string")
    assert [r[0] for r in df.select(unicode.nfkc(F.col("t"))).collect()] == ["fine IV", "Straße", "plain", None]
    assert [r[0] for r in df.select(unicode.casefold(F.col("t"))).collect()] == ["ﬁne Ⅳ".casefold(), "strasse", "plain", None]
    same = df.where("t is not null").select(unicode.value_digest(F.concat(F.lit(" "), F.upper("t"))).alias("a"), unicode.value_digest(F.col("t")).alias("b")).collect()
    assert all(r.a == r.b for r in same)


def test_records(spark):
    rows = spark.createDataFrame([(1, 10, "a"), (2, None, "a"), (3, 99, "b"), (4, None, None)], "id long, p long, k string")
    parents = spark.createDataFrame([(10, "a", 7), (11, "a", 5), (None, "c", 1)], "pid long, key string, v long")
    got = {r.id: (r.parent, r.parent_by) for r in records.with_parent(rows, parents, [("p", "pid"), ("k", "key")], "v").collect()}
    assert got == {1: (7, "p"), 2: (5, "k"), 3: (None, None), 4: (None, None)}
    seen = spark.createDataFrame([("a", 2), ("a", 1), (None, 0), (" ", 3)], "k string, at long")
    assert [(r.k, r.at) for r in records.first_seen(seen, "k", "at").collect()] == [("a", 1)]
    ranges = spark.createDataFrame([("x", 0.0, 2.0), ("x", 2.0, 3.0), ("x", 5.0, 6.0), ("x", 1.0, 1.5), ("y", 0.0, 1.0)], "g string, a double, b double")
    assert sorted(map(tuple, records.covered_ranges(ranges, "g", "a", "b").select("g", "a", "b").collect())) == [("x", 0.0, 3.0), ("x", 5.0, 6.0), ("y", 0.0, 1.0)]
    rng = random.Random(5)
    segments = [(i, "g", a, a + rng.uniform(0, 30)) for i in range(30) for a in [rng.uniform(0, 90)]]
    points = [(i, "g", rng.uniform(0, 120)) for i in range(40)] + [(99, "g", segments[0][2])]
    met = records.points_in_segments(spark.createDataFrame(points, "p long, g string, at double"), spark.createDataFrame(segments, "s long, g string, a double, b double"), "g", "at", "a", "b", 7.0)
    assert sorted((r.p, r.s) for r in met.collect()) == sorted((p, s) for p, _, at in points for s, _, a, b in segments if a <= at <= b)
    merged = records.merged_candidates(spark.createDataFrame([("k", 1, 5.0, None, "x"), ("k", 2, 9.0, "c", None), ("k", 3, 1.0, "d", "y")], "k string, id long, s double, c string, a string"), "k", [F.col("s")], "id", ["c", "a"]).first()
    assert (merged.n_merged, merged.id, merged.c, merged.a) == (3, 2, "c", "x")
    gaps = spark.range(1).select(records.merged_gaps(F.create_map(F.lit("a"), F.lit(1).cast("long"), F.lit("b"), F.lit(0).cast("long")), F.create_map(F.lit("a"), F.lit(3).cast("long")))).first()[0]
    assert gaps == {"a": 3}
    runs = spark.createDataFrame([(0.5, 1), (1.0, 3)], "q double, n long")
    assert records.weighted_quality(runs, "q", "n").first().quality == 0.875
    assert records.weighted_quality(runs.union(spark.createDataFrame([(None, 1)], "q double, n long")), "q", "n").first().quality is None


def test_leakage_report(spark):
    rows = [("train", "c", "v1"), ("train", "c", "v1"), ("val", "c", "v1"), ("test", "c", "v2"), ("test", "c", None), ("train", "d", "w"), ("val", "d", "x"), ("test", "d", "y")]
    got = {(r.comparison, r.category): r for r in leakage.leakage_report(spark.createDataFrame(rows, "split string, category string, value string"), 0.9).collect()}
    leak = got["train_vs_holdout", "c"]
    assert (leak.n_left, leak.n_right, leak.left_evidence, leak.right_evidence, leak.n_pairs, leak.passed) == (2, 3, 2, 2, 2, False)
    assert got["train_vs_holdout", "d"].passed and got["val_vs_test", "d"].passed
    assert not got["val_vs_test", "c"].passed and got["val_vs_test", "c"].n_pairs == 0  # too little evidence
    left = spark.createDataFrame([(i, "v") for i in range(5)], "id long, v string")
    assert [tuple(r) for r in leakage.leakage_samples(left, left, "id", "v", 3).collect()] == [(0, 0), (0, 1), (0, 2)]
