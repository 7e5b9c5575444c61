"""Benchmark passages inside documents, found by one Aho-Corasick automaton that reads each text once."""

from __future__ import annotations

import hashlib
import re
import uuid
from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import SLICE, map_batches, packed, unpacked
from quarrymill.operators.lineage import Scratch
from quarrymill.sources.ship import ship

WINDOW = 10
#: Bytes of passages and items in one automaton, which takes up to 50 times as much memory.
PART_BYTES = 2 << 20
#: Byte for byte: A-Z to lower case; what is no letter, digit or part of a character beyond ASCII becomes a space. Offsets stay.
FOLD = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))
ONE_WORD = re.compile(rb"[^ ]+")


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def windows_of(text: bytes | None, window: int) -> list[bytes]:
    """Each run of ``window`` words; all words where there are fewer."""
    w = words_of(text)
    return [b" ".join(w[i : i + window]) for i in range(max(1, len(w) - window + 1))] if w else []


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """Columns item (string), passage (binary), words (int), distinct."""

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            items, passages = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = set(windows_of(text, window))
                items += [item] * len(found)
                passages += found
            return pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(passages, pa.binary()), pa.array([x.count(b" ") + 1 for x in passages], pa.int32())], names=["item", "passage", "words"])

        return step

    rows = benchmark.select(F.coalesce(benchmark[f"`{id_col}`"].cast("string"), F.lit("")).alias("item"), benchmark[f"`{text_col}`"].cast("binary").alias("text"))
    return map_batches(rows, "item string, passage binary, words int", start).distinct()


def automaton_of(passages: dict[bytes, list[str]]) -> ahocorasick.Automaton:
    """Passages with a space at either end, so that only whole words match; the value is the number of words and the items."""
    a = ahocorasick.Automaton()
    for p, items in passages.items():
        a.add_word(f" {p.decode(errors='replace')} ", (p.count(b" ") + 1, items))
    if passages:
        a.make_automaton()
    return a


def spans_of(text: bytes, hit: list[tuple[int, int]]) -> list[dict]:
    """Places of runs of words in the original text, in code points: start, and end after the last character."""
    places = [m.span() for m in ONE_WORD.finditer(text.translate(FOLD))]
    out, at, chars = [], 0, 0
    for first, end in hit:
        ends = []
        for b in (places[first][0], places[end - 1][1]):
            chars += len(text[at:b].decode(errors="replace"))
            at = b
            ends.append(chars)
        out.append({"start": ends[0], "end": ends[1]})
    return out


def line_of(text: bytes | None) -> tuple[int, str]:
    """Number of words, and the words with a space before, between and behind them."""
    w = words_of(text)
    return len(w), f" {b' '.join(w).decode(errors='replace')} " if w else ""


def matches(automaton: ahocorasick.Automaton, line: str) -> tuple[list[tuple[int, int]], set[str]]:
    """Places of passages (first word, word behind the last) and the items that have them."""
    found, items, starts = [], set(), None
    if not line or not len(automaton):
        return found, items
    for last, (n, whose) in automaton.iter(line):
        if starts is None:  # places of the spaces before each word
            starts = [i for i, c in enumerate(line) if c == " "]
        end = bisect_left(starts, last)
        found.append((end - n, end))
        items.update(whose)
    return found, items


def scan(automaton: ahocorasick.Automaton, text: bytes | None) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, the runs of words that are hit (first, end) in order and apart, and the items."""
    n, line = line_of(text)
    found, items = matches(automaton, line)
    return n, runs(found), items


def runs(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"


#: The automaton that this worker has built last, by its name: later batches and tasks of the worker use it again.
BUILT: dict = {}


def built(name: str, part: Broadcast) -> ahocorasick.Automaton:
    """The automaton of a part of the passages; the one before it and the passages themselves are dropped."""
    if BUILT.get("name") != name:
        BUILT.clear()
        BUILT.update(name=name, automaton=automaton_of(part.value))
        part.__dict__.pop("_value", None)  # is read again from its file if the part comes up once more
    return BUILT["automaton"]


def broadcast_parts(windows: DataFrame, part_bytes: int) -> tuple[str, list[Broadcast]]:
    """The passages with their items in parts of about ``part_bytes``, by hash, and a name for them all. The driver holds a part at a time."""
    scratch = Scratch(windows.sparkSession)
    held = scratch.keep(windows.groupBy("passage").agg(F.array_sort(F.collect_set("item")).alias("items")).withColumn("h", F.pmod(F.xxhash64("passage"), F.lit(1 << 30))))
    size = held.agg(F.coalesce(F.sum(F.octet_length("passage") + F.octet_length(F.array_join("items", ","))), F.lit(0))).first()[0]
    n = max(1, -(-size // part_bytes))
    parts = []
    for k in range(n):
        rows = held.where(F.col("h") % n == k).select("passage", "items").collect()
        parts.append(windows.sparkSession.sparkContext.broadcast({bytes(r["passage"]): list(r["items"]) for r in rows}))
    scratch.drop(held)
    return uuid.uuid4().hex, parts


def scanned(rows: DataFrame, windows: DataFrame, kind: str, part_bytes: int) -> DataFrame:
    """Each Arrow batch of texts goes through the automata of all parts in turn, and what they find is put together."""
    ship(rows.sparkSession)
    name, parts = broadcast_parts(windows, part_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE if len(parts) == 1 else whole.num_rows):
                batch = whole.slice(at, SLICE) if len(parts) == 1 else whole
                texts = batch.column(1).to_pylist()
                lines = [line_of(x) for x in texts]
                found: list[list] = [[] for _ in texts]
                items: list[set] = [set() for _ in texts]
                for k, part in enumerate(parts):
                    automaton = built(f"{name}-{k}", part)
                    for i, (_, line) in enumerate(lines):
                        places, whose = matches(automaton, line)
                        found[i] += places
                        items[i] |= whose
                hits = [runs(x) for x in found]
                spans = [spans_of(x or b"", hit) if hit else [] for x, hit in zip(texts, hits, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([n for n, _ in lines], pa.int64()), pa.array([sum(b - a for a, b in hit) for hit in hits], pa.int64()), pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(spans, place)],
                    names=["row", "n_words", "n_hit", "items", "spans"],
                )

    return rows.select("row", F.col("text").cast("binary")).mapInArrow(run, f"row {kind}, {FOUND}")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of ``docs`` with ``n_words``, ``n_hit``, ``items`` (sorted array of strings) and ``spans`` (code points of the original).

    Words are runs of letters, digits and characters beyond ASCII, with A-Z in lower case. A passage is a run of ``window`` words of an
    item, or all words of a shorter one; a document's word inside any occurrence of a passage is hit. The documents are read once and
    not shuffled. The passages are cut into parts of about ``part_bytes``, by hash; a task builds one part's automaton, passes a batch of texts
    through it, and drops it for the next part's, so that its memory doesn't grow with the test set.

    Null and empty texts have no words and no hits, and items without words match nothing. Items without an id count under the
    empty string; repeated items count once per id. Repeated documents are reported row by row. Input columns of the same names
    are replaced. With an empty test set nothing is hit.
    """
    rows = packed(docs, text=docs[f"`{text_col}`"])
    kind = rows.schema["row"].dataType.simpleString()
    windows = item_windows(benchmark, item_id, item_text, window)
    found = scanned(rows, windows, kind, part_bytes)
    return unpacked(found, docs.columns, n_words=F.col("n_words"), n_hit=F.col("n_hit"), items=F.col("items"), spans=F.col("spans"))


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
