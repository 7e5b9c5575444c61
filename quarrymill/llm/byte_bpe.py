"""Byte-level BPE by joining the encodings of halves, and its inverse."""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import map_batches, packed, unpacked

#: Bytes up to which a piece is merged pair by pair; longer ones are halved.
LEAF = 16
#: Chunks of text whose ids a task remembers; the older half goes when there are more.
REMEMBERED = 400_000
#: A chunk is white space and what follows up to the next space or line break; a piece never crosses from no-space to space.
CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: White space other than space and line break, for which CHUNK is not used.
OTHER_SPACE = re.compile(r"[^\S \n]")


class ByteBpe:
    """Encodes as the ranks say: pieces of the pattern, each merged by the lowest rank first.

    A sequence of tokens is the encoding of its bytes if and only if each two neighbours are the encoding of theirs: the first merge
    across a border in the whole would also take place in that pair alone. So when the window around a join, re-encoded, begins
    and ends with the tokens that stood there, its neighbours outside can't change.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.none = max(ranks.values()) + 1
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.hot: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def leaf(self, piece: bytes) -> list[int]:
        get, none = self.ranks.get, self.none
        cuts = list(range(len(piece) + 1))
        pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pairs and (best := min(pairs)) < none:
            i = pairs.index(best)
            del cuts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = get(piece[cuts[i] : cuts[i + 2]], none)
            if i:
                pairs[i - 1] = get(piece[cuts[i - 1] : cuts[i + 1]], none)
        return [get(piece[cuts[i] : cuts[i + 1]]) for i in range(len(cuts) - 1)]

    def merged(self, piece: bytes) -> list[int]:
        """As leaf(), in n log n steps: a heap of the pairs that can be merged, over linked parts."""
        if len(piece) <= 4 * LEAF:
            return self.leaf(piece)
        ranks, n = self.ranks, len(piece)
        end, before, after = [i + 1 for i in range(n)], list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, to = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or end[j] != to or end[i] != j:
                continue
            end[i], alive[j], after[i] = to, False, after[j]
            if after[j] < n:
                before[after[j]] = i
                if (r := ranks.get(piece[i : end[after[j]]])) is not None:
                    heapq.heappush(heap, (r, i, end[after[j]]))
            if before[i] >= 0 and (r := ranks.get(piece[before[i] : to])) is not None:
                heapq.heappush(heap, (r, before[i], to))
        return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of both, from the encodings of each."""
        k = 2
        while True:
            i, j = max(0, len(left) - k), min(len(right), k)
            window = b"".join(map(self.bytes_of.__getitem__, left[i:] + right[:j]))
            middle = self.merged(window)
            if (i == 0 or middle[0] == left[i]) and (j == len(right) or middle[-1] == right[j - 1]):
                return left[:i] + middle + right[j:]
            k *= 2

    def piece(self, piece: bytes) -> list[int]:
        if (rank := self.ranks.get(piece)) is not None:
            return [rank]
        if len(piece) <= LEAF:
            return self.leaf(piece)
        parts = [self.leaf(piece[i : i + LEAF]) for i in range(0, len(piece), LEAF)]
        while len(parts) > 1:  # up the tree, level by level
            parts = [self.join(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0]

    def chunk(self, text: str) -> bytes:
        """The ids of a chunk as little-endian 32-bit integers, remembered."""
        if (ids := self.hot.get(text)) is None:
            if (ids := self.old.get(text)) is None:
                out = array("I")
                for p in self.pattern.findall(text):
                    out.extend(self.piece(p.encode()))
                ids = out.tobytes()
            if len(text) <= 64:
                if len(self.hot) >= REMEMBERED // 2:
                    self.old, self.hot = self.hot, {}
                self.hot[text] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if OTHER_SPACE.search(text):
            return self.chunk(text)
        get, chunk = self.hot.get, self.chunk
        out = []
        for x in CHUNK.findall(text):
            ids = get(x)
            if ids is None:
                ids = chunk(x)
                get = self.hot.get
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, array("I", ids)))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


@cache
def loaded(path: str, pattern: str) -> ByteBpe:
    """Once in each Python worker; the file is part of the installation, as the library is."""
    return ByteBpe(read_ranks(path), pattern)


def bpe_encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``token_ids``: little-endian unsigned 32-bit integers, as binary. No shuffle.

    Every match of the pattern is encoded on its own, without special tokens; bytes outside any match give no token. Null and empty
    texts give an empty value. Repeated rows and ties get equal ids; an input column token_ids is replaced.
    """
    rows = packed(docs, text=docs[f"`{text_col}`"])
    kind = rows.schema["row"].dataType.simpleString()

    def start():
        bpe = loaded(ranks_path, pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [bpe.encode(x) for x in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["row", "ids"])

        return step

    return unpacked(map_batches(rows, f"row {kind}, ids binary", start), docs.columns, token_ids=F.col("ids"))


def bpe_decode(encoded: DataFrame, ranks_path: str, pattern: str, ids_col: str = "token_ids") -> DataFrame:
    """The rows of ``encoded`` with ``decoded``: the bytes of all ids, one after the other. Null and empty values give empty bytes.

    Repeated rows and ties get equal bytes; an input column decoded is replaced. Values that aren't whole 32-bit integers are a ValueError, ids
    that the ranks don't have a KeyError.
    """
    rows = packed(encoded, ids=encoded[f"`{ids_col}`"])
    kind = rows.schema["row"].dataType.simpleString()

    def start():
        bpe = loaded(ranks_path, pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = [bpe.decode(x or b"") for x in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["row", "decoded"])

        return step

    return unpacked(map_batches(rows, f"row {kind}, decoded binary", start), encoded.columns, decoded=F.col("decoded"))
