"""Documents packed into windows of equal length by best fit, longest pieces first."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quarrymill.sources.ship import ship

WINDOW = 1024
#: Tokens of pieces that a task holds while it packs them; what doesn't fill a window goes on to the next lot.
LOT = 1 << 22
#: Characters that are encoded at once; texts are cut between another character and white space, which no piece of the pattern crosses.
STRETCH = 1 << 16
CUT = re.compile(r"[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000](?=[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000])")
#: Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PIECE = "start long, length long, token_ids binary, doc_tokens long, sequence_id long, offset long, sequence_tokens long"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for themselves, the others from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def ranks_of(path: str) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """Ranks by bytes and added tokens, if the file is a plain byte-level BPE whose ids ascend as its merges do, so that the pair of lowest
    id is merged first; else None."""
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    model, before = whole["model"], whole.get("pre_tokenizer") or {}
    added = whole.get("added_tokens") or []
    plain = model.get("type") == "BPE" and not (whole.get("normalizer") or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges"))
    plain = plain and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    if not plain or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
        return None
    vocab, names = model["vocab"], {t["content"] for t in added}
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    letters = byte_letters()
    tokens = {k: v for k, v in vocab.items() if k not in names}
    if merged != sorted(merged) or len(merged) + 256 != len(tokens) or any(c not in letters for k in tokens for c in k):
        return None
    return {bytes(letters[c] for c in k): v for k, v in tokens.items()}, {t["content"]: t["id"] for t in added}


def stretches(text: str) -> Iterator[str]:
    """The text in parts of about STRETCH characters, cut only where no piece of the pattern goes on."""
    at = 0
    while len(text) - at > STRETCH and (m := CUT.search(text, at + STRETCH)):
        yield text[at : m.end()]
        at = m.end()
    yield text[at:]


class Ids:
    """Token ids of whole texts, as little-endian 32-bit integers, without begin or end.

    A byte-level BPE in the order of its ids is encoded by a faster library that takes these ranks, and gives the same ids; any other file, and
    what has no white space over twice STRETCH characters, by the library that the file is for.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on each core
        from tokenizers import Tokenizer

        self.tokenizer, self.fast, self.added, self.split = Tokenizer.from_file(path), None, {}, None
        if (found := ranks_of(path)) is not None:
            import tiktoken

            ranks, self.added = found
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            if self.added:
                self.split = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")")

    def _slow(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _between(self, text: str) -> bytes:
        """Of a part without added tokens."""
        return b"".join(self._slow(x) if len(x) > 2 * STRETCH else self.fast.encode_to_numpy(x).astype("<u4").tobytes() for x in stretches(text))

    def of(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.fast is None:
            return self._slow(text)
        if not any(t in text for t in self.added):
            return self._between(text)
        parts = self.split.split(text)
        return b"".join(np.array([self.added[x]], "<u4").tobytes() if i % 2 else self._between(x) for i, x in enumerate(parts) if x)


@cache
def loaded(path: str) -> Ids:
    """Once in each Python worker; the file is part of the installation, as the library is."""
    return Ids(path)


class OpenWindows:
    """Windows by what room they have left: a segment tree over the sizes of rooms, where a node holds how many windows are below it."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.below, self.windows = [0] * (2 * self.leaves), [[] for _ in range(most + 1)]

    def _count(self, room: int, by: int) -> None:
        i = self.leaves + room
        while i:
            self.below[i] += by
            i >>= 1

    def add(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        self._count(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Room and number of a window with the least room that ``need`` fits in; it is no longer open."""
        i = self.leaves + need
        while not self.below[i]:
            while i & 1:  # up to the next node to the right
                i >>= 1
                if i <= 1:
                    return None
            i += 1
        while i < self.leaves:
            i = 2 * i if self.below[2 * i] else 2 * i + 1
        room = i - self.leaves
        self._count(room, -1)
        return room, self.windows[room].pop()


def best_fit(lengths: list[int], window: int) -> list[list[int]]:
    """Numbers of the pieces in each window: the longest piece first, each where it leaves the least room."""
    packed: list[list[int]] = []
    rooms = OpenWindows(window)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = rooms.take(lengths[i])
        if found is None:
            room, w = window, len(packed)
            packed.append([])
        else:
            room, w = found
        packed[w].append(i)
        if room > lengths[i]:
            rooms.add(room - lengths[i], w)
    return packed


#: Number of a row, place of its first id in the document, its ids.
Piece = tuple[int, int, bytes]


def filled(windows: list[list[Piece]], window: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Windows without room, and the pieces that are left, fewer ids than a window holds. The emptiest windows are cut up to fill the others."""
    size = lambda pieces: sum(len(ids) for _, _, ids in pieces) // 4
    full, rest = [], []
    for pieces in windows:
        (full if size(pieces) == window else rest).append(pieces)
    rest.sort(key=size, reverse=True)
    done, spare = 0, []
    while done + 1 < len(rest) or done < len(rest) and spare:
        room = window - size(rest[done])
        while room and (spare or done + 1 < len(rest)):
            if not spare:
                spare = rest.pop()
                continue
            row, start, ids = spare.pop()
            rest[done].append((row, start, ids[: 4 * room]))
            if len(ids) > 4 * room:
                spare.append((row, start + room, ids[4 * room :]))
            room -= len(rest[done][-1][2]) // 4
        if room:
            break
        full.append(rest[done])
        done += 1
    return full, spare + [p for pieces in rest[done:] for p in pieces]


def powers(pieces: list[Piece]) -> list[list[Piece]]:
    """The pieces in sequences whose lengths are different powers of two, the largest first."""
    left, out = list(reversed(pieces)), []
    total = sum(len(ids) for _, _, ids in pieces) // 4
    for bit in reversed(range(total.bit_length())):
        room = total & 1 << bit
        if room:
            out.append([])
        while room:
            row, start, ids = left.pop()
            if len(ids) > 4 * room:
                left.append((row, start + room, ids[4 * room :]))
                ids = ids[: 4 * room]
            out[-1].append((row, start, ids))
            room -= len(ids) // 4
    return out


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = 0, lot: int = LOT) -> DataFrame:
    """A row for each piece: the document's id, ``start`` (its ids before the piece), ``length``, ``token_ids`` (little-endian unsigned 32-bit
    integers), ``doc_tokens``, ``sequence_id``, ``offset`` and ``sequence_tokens``. No shuffle.

    A document is the library's ids of the whole text, without begin or end, and then ``end_id``. It gives full windows and one shorter
    piece; these are packed by best fit, longest first, in lots of about ``lot`` tokens. Windows with room left are filled from the emptiest,
    whose pieces are cut. What a task has left at its end, less than a window, stands in sequences of powers of two. So no sequence has padding.

    Null and empty texts are one ``end_id``. Each row is a document of its own, also if ids are repeated or null. Only the id and text columns
    are read, so that others can't clash. Empty tables give no rows. A sequence_id names the partition and a number in it: equal if a
    lost task runs again. A task holds a lot, the ids of one document, and one Arrow batch of texts.
    """
    ship(docs.sparkSession)
    rows = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text_col}`"].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = loaded(path), np.array([end_id], "<u4").tobytes()
        sequence, idents, sizes = TaskContext.get().partitionId() << 33, [], []
        wide, held, tails, out = 4 * window, 0, [], []
        id_type = None

        def emit(windows: list[list[Piece]]) -> None:
            nonlocal sequence
            for pieces in windows:
                at, whole = 0, sum(len(x) for _, _, x in pieces) // 4
                for row, start, x in pieces:
                    n = len(x) // 4
                    out.append((idents[row], start, n, x, sizes[row], sequence, at, whole))
                    at += n
                sequence += 1

        def settle() -> None:
            """Packs the lot; rows that nothing is left of are forgotten."""
            nonlocal tails, held
            packed = best_fit([len(x) // 4 for _, _, x in tails], window)
            full, tails = filled([[tails[i] for i in w] for w in packed], window)
            emit(full)
            named = {row: k for k, row in enumerate(dict.fromkeys(row for row, _, _ in tails))}
            idents[:], sizes[:] = [idents[r] for r in named], [sizes[r] for r in named]
            tails = [(named[r], s, x) for r, s, x in tails]
            held = sum(len(x) for _, _, x in tails) // 4

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            types = [id_type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
            names = ["id", *[x.split()[0] for x in PIECE.split(", ")]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for b in batches:
            id_type = b.schema.field(0).type
            for ident, text in zip(b.column(0), b.column(1), strict=True):
                ids = ids_of.of(text.as_py()) + end
                row, n = len(idents), len(ids) // 4
                idents.append(ident.as_py())
                sizes.append(n)
                cut = len(ids) - len(ids) % wide
                for at in range(0, cut, wide):
                    emit([[(row, at // 4, ids[at : at + wide])]])
                    if len(out) >= 1024:
                        yield batch()
                if cut < len(ids):
                    tails.append((row, cut // 4, ids[cut:]))
                    held += (len(ids) - cut) // 4
                if held >= lot:
                    settle()
                if len(out) >= 1024:
                    yield batch()
        if id_type is not None:
            settle()
            emit(powers(tails))
            if out:
                yield batch()

    pieces = rows.mapInArrow(run, f"id {kind}, {PIECE}")
    return pieces.withColumnRenamed("id", id_col)
