"""Token counts of whole texts by a library's tokenizer, in batches of even size; only lengths leave a task."""

from __future__ import annotations

import os
import re
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import map_batches, packed, unpacked

#: Characters that one call of the library gets together.
BATCH_CHARS = 1 << 16
#: Lengths that a task remembers; the older half goes when there are more.
REMEMBERED = 400_000
#: Neither normaliser nor pattern nor merges of the tokenizers here reach across these; the characters themselves give no token.
BOUNDARY = re.compile(r"[ \t\n\r]+")


@cache
def loaded(path: str):
    """Once in each Python worker; the file is part of the installation, as the library is."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on each core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Counter:
    """Tokens of a text as the sum over its parts between boundaries; a part's length is asked of the library once."""

    def __init__(self, path: str):
        self.tokenizer = loaded(path)
        self.hot: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def lengths(self, parts: list[str]) -> list[int]:
        """Of each part, from batches of about BATCH_CHARS characters, the parts sorted by length so that batches are even."""
        order, out = sorted(range(len(parts)), key=lambda i: len(parts[i])), [0] * len(parts)
        at = 0
        while at < len(order):
            end, chars = at, 0
            while end < len(order) and (end == at or chars + len(parts[order[end]]) <= BATCH_CHARS):
                chars += len(parts[order[end]])
                end += 1
            for i, e in zip(order[at:end], self.tokenizer.encode_batch_fast([parts[i] for i in order[at:end]], add_special_tokens=False), strict=True):
                out[i] = len(e)
            at = end
        return out

    def counts(self, texts: list[str | None]) -> list[int]:
        split = [BOUNDARY.split(x) if x else [] for x in texts]
        hot, old = self.hot, self.old
        new: dict[str, int] = {}
        for parts in split:
            for p in parts:
                if p not in hot and p not in new:
                    if (n := old.get(p)) is None:
                        new[p] = -1
                    else:
                        hot[p] = n
        ask = list(new)
        new.update(zip(ask, self.lengths(ask), strict=True))
        out = [sum([hot[p] if p in hot else new[p] for p in parts]) for parts in split]
        if len(hot) + len(new) > REMEMBERED // 2:
            self.old, self.hot = hot, {}
            hot = self.hot
        hot.update((p, n) for p, n in new.items() if len(p) <= 64)
        return out


def slices(texts: list[str | None], chars: int = 1 << 22) -> list[list[str | None]]:
    """Consecutive texts of about ``chars`` characters together; a longer text alone."""
    out: list[list[str | None]] = []
    size = chars
    for x in texts:
        if size >= chars:
            out.append([])
            size = 0
        out[-1].append(x)
        size += len(x or "")
    return out


def token_counts(docs: DataFrame, path: str, text_col: str = "text", limit: int = 2048) -> DataFrame:
    """The rows of ``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens). No shuffle.

    Texts of any length are split at spaces, tabs and line ends, where the tokenizer's tokens end anyway, and encoded whole.
    No begin, end or added tokens; special strings inside a text count as the library's default has them. Null and empty texts
    have no bytes and no tokens. Repeated rows and ties get equal counts; input columns of the same names are replaced.
    """
    rows = packed(docs, text=docs[f"`{text_col}`"])
    kind = rows.schema["row"].dataType.simpleString()

    def start():
        counter = Counter(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts: list[int] = []
            for part in slices(batch.column(1).to_pylist()):
                counts += counter.counts(part)
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], names=["row", "n_bytes", "n_tokens"])

        return step

    rows = rows.select("row", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = map_batches(rows, f"row {kind}, n_bytes long, n_tokens long", start)
    return unpacked(counted, docs.columns, n_bytes=F.col("n_bytes"), n_tokens=F.col("n_tokens"), over_limit=F.col("n_tokens") > limit)
