"""Each stage of the pipeline on its own input against a brute-force version, and on nulls, repeated rows and empty tables."""

import random
import re

import pytest
import tiktoken
from public_tokenizers import PATTERN, path

import corpus_pipeline
from quarrymill.llm import byte_bpe, quality_rules
from tests.llm.test_exact import brute_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = dict(corpus_pipeline.STAGES)
WORDS = re.compile("[^\x20\x09-\x0d]+")


def lowered(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)


def brute_lines(rows):
    where, keys = {}, lambda t: [lowered(x.strip(" \t\n\x0b\x0c\r")) for x in (t or "").split("\n")]
    for i, t in rows:
        for k in keys(t):
            if len(k) >= 10:
                where.setdefault(k, set()).add(i)
    gone = lambda k, i: len(where.get(k, ())) > 1 and min(where[k]) != i
    return [(i, "\n".join(x for x, k in zip((t or "").split("\n"), keys(t), strict=True) if not gone(k, i))) for i, t in rows]


def brute_near(rows):
    _, component = brute_components(rows)
    return [(i, t) for i, t in rows if component[i] == i]


def brute_benchmark(rows, items):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(t or ""))
    windows = {tuple(w[k : k + 10]) for _, t in items for w in [words(t)] if w for k in range(max(1, len(w) - 9))}
    clean = lambda w: not any(tuple(w[k : k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1))
    return [(i, t) for i, t in rows if clean(words(t))]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 7)))
    prose = lambda n: ". ".join(" ".join(word() for _ in range(8)).capitalize() for _ in range(n // 8)) + "."
    items = [(1, " ".join(word() for _ in range(14))), (2, "Just four words here"), (3, None), (4, "...")]
    shared = [prose(16) for _ in range(3)]
    docs = []
    for _ in range(40):
        parts = [prose(24) for _ in range(rng.randint(2, 4))] + ([rng.choice(shared)] if rng.random() < 0.5 else [])
        rng.shuffle(parts)
        docs.append("\n".join(parts))
    docs += [d.replace(d.split()[5], "edited", 1) for d in docs[:8]] + docs[8:12]
    for _ in range(4):  # one line each, so that near copies share none
        d = prose(160)
        docs += [d, d.replace(d.split()[5], "edited", 1), d.replace(d.split()[90], "edited", 1)]
    docs += [docs[20] + " " + items[0][1], docs[21].replace(".", " just FOUR words, here.", 1), "### " * 90, docs[3].upper().replace(" ", "!! "), "short text", "", None]
    return list(enumerate(docs)), items


def run_stage(spark, name, rows, folder):
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    out = STAGES[name](spark, df, folder)
    return out, sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)


def test_stages_against_brute_force(spark, corpus, tmp_path):
    rows, items = corpus
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    _, kept = run_stage(spark, "quality rules", rows, str(tmp_path))
    signals = spark.createDataFrame(rows, "doc_id long, text string")
    votes = {r[0]: tuple(r[1:]) for r in quality_rules.with_signals(signals).select("doc_id", *quality_rules.votes()).collect()}
    counts = {}
    for v in votes.values():
        counts[v] = counts.get(v, 0) + 1
    model = quality_rules.estimated(sorted(counts.items()))
    fails = lambda t: len(WORDS.findall(t or "")) < 20  # noqa: E731  no text repeats eight words but the marks
    assert {i for i, _ in kept} == {i for i, t in rows if not fails(t) and "###" not in (t or "") and model.odds(votes[i]) >= 0}
    assert {i for i, _ in kept} >= set(range(40))
    for name, brute in (("line dedup", brute_lines), ("MinHash near-dedup", brute_near), ("benchmark decontamination", lambda x: brute_benchmark(x, items))):
        out, got = run_stage(spark, name, kept, str(tmp_path))
        assert got == sorted(brute(kept), key=repr), name
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert got != kept
        kept = got
    out, _ = run_stage(spark, "byte-level BPE", kept, str(tmp_path))
    known = tiktoken.Encoding("x", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    for r in out.collect():
        ids = [int.from_bytes(r.token_ids[k : k + 4], "little") for k in range(0, len(r.token_ids), 4)]
        assert ids == known.encode_ordinary(r.text) and r.n_tokens == len(ids) and r.round_trip


def test_stages_on_awkward_rows(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    long = " ".join(f"word{i}." for i in range(60_000))
    rows = [(None, None), (None, "a text without id, but with enough words " + " ".join(f"w{i}." for i in range(80))), (7, long), (7, long), (8, "")]
    for name, stage in STAGES.items():
        df = spark.createDataFrame([(i, t, None, None, None, "x") for i, t in rows], SCHEMA + ", row string")
        out = stage(spark, df, str(tmp_path))
        assert out.columns[:6] == df.columns
        n = out.count()
        assert n == 3 if name == "quality rules" else n == 5, name
        assert stage(spark, df.limit(0), str(tmp_path)).count() == 0
