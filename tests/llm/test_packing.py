"""Packing against the library's ids and a plain best fit; sequences without padding."""

import random
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarrymill.llm import packing
from quarrymill.llm.packing import Ids, best_fit, filled, pack_documents, powers

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", "a", "<|endoftext|>", "x <|endoftext|>  y<|endoftext|><|endoftext|>\n", "tab\t\n mixed   space  ", "it's we'll DON'T 123 4x ", "é́😀 漢字 ﬁ", "word " * 3000, "z" * 400, " " * 3000 + "end",
    "a\r\n\r\n  b", "​q \x1c\x1d w\x85v", "&&& ### %%%" * 50, "same", "same",
]


LIBRARY = cache(Tokenizer.from_file)


def library_ids(text):
    return LIBRARY(PATH).encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_library_s(monkeypatch):
    rng = random.Random(3)
    parts = ["a", " ", "\n", "\t", "é", "😀", "1", "<|endoftext|>", "<|endof", "'s", " ", "the ", "Word", "##", " ", "ß"]
    texts = TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randrange(200))) for _ in range(300)]
    for stretch in (packing.STRETCH, 7):
        monkeypatch.setattr(packing, "STRETCH", stretch)
        ids = Ids(PATH)
        assert ids.fast is not None
        for x in texts:
            assert np.frombuffer(ids.of(x), "<u4").tolist() == library_ids(x), x


def test_other_files_go_to_their_library():
    other = public_tokenizers.path("word_bpe_49k.json")
    ids = Ids(other)
    assert ids.fast is None
    assert np.frombuffer(ids.of("Hello, wörld"), "<u4").tolist() == Tokenizer.from_file(other).encode("Hello, wörld", add_special_tokens=False).ids


def plain_best_fit(lengths, window):
    """By looking at all windows."""
    rooms, out = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [(r, w) for w, r in enumerate(rooms) if r >= lengths[i]]
        if fits:
            least = min(fits)[0]
            w = next(w for r, w in reversed(fits) if r == least)
        else:
            w = len(rooms)
            rooms.append(window)
            out.append([])
        rooms[w] -= lengths[i]
        out[w].append(i)
    return out


def test_best_fit():
    rng = random.Random(1)
    for _ in range(200):
        window = rng.choice([1, 2, 7, 16, 100])
        lengths = [rng.randint(1, window) for _ in range(rng.randrange(60))]
        got, expected = best_fit(lengths, window), plain_best_fit(lengths, window)
        assert sorted(i for w in got for i in w) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in w) <= window for w in got)
        fill = lambda ws: sorted(sum(lengths[i] for i in w) for w in ws)
        assert fill(got) == fill(expected)


def test_filled_and_powers():
    rng = random.Random(2)
    for _ in range(300):
        window = rng.choice([1, 4, 16, 50])
        windows, left = [], 0
        for row in range(rng.randrange(12)):
            pieces = [(row, 0, bytes(4 * rng.randint(1, max(1, window // 2)))) for _ in range(2)]
            windows.append([p for k, p in enumerate(pieces) if sum(len(x[2]) for x in pieces[: k + 1]) <= 4 * window])
        total = sum(len(p[2]) for w in windows for p in w) // 4
        full, rest = filled([list(w) for w in windows if w], window)
        left = sum(len(p[2]) for p in rest) // 4
        assert left < window and len(full) * window + left == total
        assert all(sum(len(p[2]) for p in w) == 4 * window for w in full)
        sizes = [sum(len(p[2]) for p in w) // 4 for w in powers(rest)]
        assert sum(sizes) == left and all(s & (s - 1) == 0 for s in sizes) and len(set(sizes)) == len(sizes)


@pytest.mark.parametrize(("window", "lot"), [(1024, 1 << 22), (16, 64), (10, 1)])
def test_pieces(spark, window, lot):
    rows = [(i, x, 9, "q") for i, x in enumerate(TEXTS)] + [(None, "no id", 9, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int, sequence_id string").repartition(3)
    pieces = pack_documents(docs, PATH, window=window, lot=lot).collect()
    assert {r["doc_id"] for r in pieces} == {r[0] for r in rows}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, text, *_ in rows:
        ids = library_ids(text) + [0]
        found = sorted(by_doc[i], key=lambda r: r["start"])
        assert [r["start"] for r in found] == list(np.cumsum([0] + [r["length"] for r in found])[:-1])
        assert b"".join(r["token_ids"] for r in found) == np.array(ids, "<u4").tobytes()
        assert {r["doc_tokens"] for r in found} == {len(ids)}
    for held in by_sequence.values():
        held.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in held] == list(np.cumsum([0] + [r["length"] for r in held])[:-1])
        n = sum(r["length"] for r in held)
        assert {r["sequence_tokens"] for r in held} == {n}
        assert n == window or n < window and n & (n - 1) == 0


def test_whole_query(spark):
    from quarrymill.llm.queries import op12_packing
    from tests.test_queries import SF

    rows = op12_packing(spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    assert set(by_doc) == set(docs)
    for i, text in docs.items():
        ids = library_ids(text) + [0]
        for r in by_doc[i]:
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
        assert sum(r["length"] for r in by_doc[i]) == len(ids)


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(docs, PATH).count() == 0
    twice = spark.createDataFrame([(1, "one two three")] * 5, "doc_id long, text string").coalesce(1)
    assert pack_documents(twice, PATH).agg(F.sum("length")).first()[0] == 5 * len(library_ids("one two three") + [0])


def test_broken_ids_of_byte_bpe():
    from quarrymill.llm.byte_bpe import loaded

    bpe = loaded(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    assert bpe.decode(b"") == b"" and bpe.decode(bpe.encode("é x")) == "é x".encode()
    with pytest.raises(ValueError):
        bpe.decode(b"\x01\x02\x03")
    with pytest.raises(KeyError):
        bpe.decode(np.array([2**31], "<u4").tobytes())


def test_token_counts_of_nothing_and_repeats(spark):
    from quarrymill.llm.token_counts import token_counts

    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(1, "Some words here, again"), (1, "Some words here, again"), (2, None), (None, "")], "doc_id long, text string")
    assert token_counts(docs.limit(0), path).count() == 0
    rows = token_counts(docs, path, limit=4).collect()
    n = len(Tokenizer.from_file(path).encode("Some words here, again", add_special_tokens=False).ids)
    assert sorted((r["n_tokens"], r["over_limit"]) for r in rows) == [(0, False), (0, False), (n, n > 4), (n, n > 4)]
