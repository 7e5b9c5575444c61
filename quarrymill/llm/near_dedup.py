"""Near-duplicate documents: circulant MinHash, bands, exact Jaccard similarity of the full shingle sets, components.

Exact copies are one class from the start. Of each band's bucket, not all pairs are tested: first, each member meets the one that shares
most with others. Members that this leaves in different components of a bucket are candidates only if they also share one of their rarest
shingles, at places that leave room for enough others (prefix and positional filter, which no similar pair fails). Both steps
are one pass each; there are no rounds over the pairs of a bucket.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import map_batches, packed, unpacked
from quarrymill.operators.lineage import Scratch

WORDS = 5
COORDINATES, ROWS = 128, 4
#: Least similarity in hundredths.
LEAST = 75
#: Least number of equal coordinates for a candidate pair to be counted on the full sets. With independent coordinates, a pair of 0.75 has
#: fewer in 4 of 10^11 cases; those of circulant signatures vary less (Li and Li, C-MinHash, 2022).
AGREE = 64
#: Cells of the table that counts shingles of open documents by their hashes. It only orders shingles by rarity, so its fixed size bounds
#: what the driver and each task hold and costs no pair.
CELLS = 1 << 20
#: Sizes of sets are put in classes that grow by this ratio; a shingle is a candidate key for each class of sizes that the partner may have.
RATIO = 4 / 3
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
EMPTY = np.zeros(0, dtype=np.uint64)


class Shingler:
    """Words to shingle hashes; a task's memory of word hashes is bounded."""

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """The distinct 64-bit hashes of all runs of ``words`` words, sorted; of all words together where there are fewer."""
        if not words:
            return EMPTY
        known = self.known
        if len(known) > 400_000:
            known.clear()
        try:
            hashes = np.array([known[w] for w in words], dtype=np.uint64)
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            hashes = np.array([known[w] for w in words], dtype=np.uint64)
        n = max(1, len(words) - self.words + 1)
        out = np.full(n, len(words) if len(words) < self.words else self.words, dtype=np.uint64)
        for i in range(min(self.words, len(words))):
            out = (out ^ hashes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return np.unique(out)


def circulant_signature(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """Coordinate k is the least value of one permutation of the 32-bit numbers, shifted by k, over the shingles' places, which another
    permutation gives. Both are invertible mixings."""
    places = shingles.copy()
    places ^= places >> np.uint64(31)
    places *= np.uint64(0x7FB5D329728EA185)
    places ^= places >> np.uint64(27)
    places *= np.uint64(0x81DADEF4BC2DD44D)
    places = (places >> np.uint64(32)).astype(np.uint32)
    out = np.full(coordinates, 0xFFFFFFFF, dtype=np.uint32)
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None]
    for at in range(0, len(places), 512):  # keeps the table in the processor's cache
        x = places[None, at : at + 512] + shifts
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        x *= np.uint32(0xC2B2AE35)
        x ^= x >> np.uint32(16)
        np.minimum(out, x.min(axis=1), out=out)
    return out


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(LOWER).split()


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """Columns id, k1, k2 (128-bit hash of the words in order), n_shingles, signature (array of int; null without words)."""

    def start():
        shingler = Shingler(words)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            digests, sizes, signed, rows = [], [], [], []
            for text in batch.column(1).to_pylist():
                w = words_of(text)
                s = shingler(w)
                digests.append(xxhash.xxh3_128_digest(b" ".join(w)))
                sizes.append(len(s))
                rows.append(COORDINATES if len(s) else 0)
                if len(s):
                    signed.append(circulant_signature(s))
            keys = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            flat = np.concatenate(signed).view(np.int32) if signed else np.zeros(0, np.int32)
            offsets = pa.array(np.concatenate([[0], np.cumsum(rows)]), pa.int32())
            arrays = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()), pa.array(sizes, pa.int64()), arrays], names=["id", "k1", "k2", "n_shingles", "signature"])

        return step

    return map_batches(docs.select("id", F.col("text").cast("binary")), "id long, k1 long, k2 long, n_shingles long, signature array<int>", start)


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """Columns id, shingles (array of distinct 64-bit hashes)."""

    def start():
        shingler = Shingler(words)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingler(words_of(text)) for text in batch.column(1).to_pylist()]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in sets])]), pa.int32())
            flat = np.concatenate([EMPTY, *sets]).view(np.int64)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(flat))], names=["id", "shingles"])

        return step

    return map_batches(docs.select("id", F.col("text").cast("binary")), "id long, shingles array<long>", start)


def band_keys() -> Column:
    """One 64-bit key for each band of ROWS coordinates."""
    pick = lambda i: F.get("signature", F.lit(i))
    return F.array(*[F.xxhash64(F.lit(b), *[pick(b * ROWS + r) for r in range(ROWS)]) for b in range(COORDINATES // ROWS)])


def sketch() -> Column:
    """The lowest byte of each coordinate: equal coordinates stay equal, and others are so once in 256 times."""
    return F.transform("signature", lambda x: F.shiftright(F.shiftleft(x, 24), 24).cast("tinyint"))


def linked(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, least: int, scratch: Scratch) -> DataFrame:
    """Of columns a, b those pairs with 100 * intersection >= least * union on the full sets, of those with AGREE equal coordinates.

    The sets meet row by row in the JVM: an Arrow batch of pairs of long texts would have no bound.
    """
    of = lambda df, side, c, name: df.select(F.col("id").alias(side), F.col(c).alias(name))
    near = pairs.join(of(sketches, "b", "sketch", "_y"), "b").join(of(sketches, "a", "sketch", "_x"), "a")
    near = scratch.keep(near.where(F.size(F.filter(F.zip_with("_x", "_y", lambda x, y: x == y), lambda same: same)) >= AGREE).select("a", "b"))
    both = near.join(of(sets, "b", "shingles", "_y"), "b").join(of(sets, "a", "shingles", "_x"), "a")
    n, m = F.size("_x"), F.size("_y")
    alike = F.lit(100) * F.least(n, m) >= F.lit(least) * F.greatest(n, m)
    found = scratch.keep(both.where(alike & (F.lit(100 + least) * F.size(F.array_intersect("_x", "_y")) >= F.lit(least) * (n + m))).select("a", "b"))
    scratch.drop(near)
    return found


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Columns id, component (smallest id reachable) of all ends of the edges a, b; a node's neighbours are never gathered.

    Large-star and small-star (Kiveris and others, Connected components in MapReduce and beyond, 2014) in turn: larger, then smaller
    neighbours of a node are linked with its smallest neighbour instead, until each is linked with its component's smallest id. The rounds
    grow as the square of a logarithm at most.
    """
    star = scratch.keep(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = star.union(star.select("v", "u"))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(lowest.where("m < u").select("u", "m")).distinct()
        large = scratch.keep(large)
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(smallest.select("u", F.col("m").alias("v"))).distinct()
        after = scratch.keep(small)
        scratch.drop(star, large)
        star, now = after, after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            roots = star.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))
            return star.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
        before = now


def joined_labels(labels: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``labels`` after more edges: only the components that these join are looked at."""
    of = lambda side: labels.select(F.col("id").alias(side), F.col("component").alias(f"{side}_of"))
    between = edges.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("a_of", "a").alias("a"), F.coalesce("b_of", "b").alias("b"))
    moved = components(between, scratch).select(F.col("id").alias("component"), F.col("component").alias("lower"))
    old = labels.join(moved, "component", "left").select("id", F.coalesce("lower", "component").alias("component"))
    new = moved.join(labels.select(F.col("id").alias("component")), "component", "left_anti").select(F.col("component").alias("id"), F.col("lower").alias("component"))
    return old.union(new)


def stars(members: DataFrame) -> DataFrame:
    """Pairs a < b of each bucket's leader with its other members. The leader is the member that shares most buckets with most others, as
    the text that others are edits of does; buckets with the same members so have the same leader."""
    sizes = members.groupBy("key").agg(F.count("*").alias("n"))
    shares = members.join(sizes, "key").groupBy("id").agg(F.sum("n").alias("shares"))
    leaders = members.join(shares, "id").groupBy("key").agg(F.min(F.struct((-F.col("shares")).alias("order"), "id")).alias("first"))
    met = members.join(leaders.select("key", F.col("first.id").alias("leader")), "key").where("leader <> id")
    return met.select(F.least("leader", "id").alias("a"), F.greatest("leader", "id").alias("b")).distinct()


def open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Columns id, component, minor of the members of buckets with several components; minor: outside the largest in one of them, as one
    of any two members in different components is."""
    m = members.join(labels, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    parts = m.groupBy("key", "component").agg(F.count("*").alias("n"))
    largest = parts.groupBy("key").agg(F.max(F.struct("n", "component")).alias("l"), F.count("*").alias("parts")).where("parts > 1").select("key", F.col("l.component").alias("main"))
    return m.join(largest, "key").groupBy("id", "component").agg(F.max(F.col("component") != F.col("main")).alias("minor"))


def shingle_counts(sets: DataFrame) -> np.ndarray:
    """How many of all shingles fall in each of CELLS cells; at most CELLS rows reach the driver, whatever the corpus."""
    cells = sets.select(F.explode("shingles").alias("s")).select((F.shiftright("s", 20).bitwiseAND(F.lit(CELLS - 1))).cast("int").alias("cell"))
    counted = cells.groupBy("cell").agg(F.least(F.count("*"), F.lit(2**31 - 1)).cast("int").alias("n")).toArrow()
    out = np.zeros(CELLS, dtype=np.int32)
    out[counted.column("cell").to_numpy()] = counted.column("n").to_numpy()
    return out


def size_classes(largest: int) -> np.ndarray:
    """The least size of each class."""
    bounds = [1]
    while bounds[-1] <= largest:
        bounds.append(max(bounds[-1] + 1, math.ceil(bounds[-1] * RATIO)))
    return np.array(bounds, dtype=np.int64)


def prefix_keys(sets: DataFrame, counts: np.ndarray, least: int) -> DataFrame:
    """Columns key, id, component, packed: for each class of sizes that a partner may have, the rarest shingles of the set of which two
    similar sets must share one. ``packed`` holds the size n, the room (shingles from this one on), the side and whether it is minor.

    Two sets of n and m shingles with a similarity of least / 100 share least * (n + m) / (100 + least) at least; of these the rarest
    is among the first n + 1 less that of either, in any order that is the same for all. The key holds both classes; side is 0, 1 or 2
    where the own class is the lower, the same, or the higher one.
    """
    counted = sets.sparkSession.sparkContext.broadcast(counts)

    def start():
        table, bounds = counted.value, size_classes(1 << 40)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            lists, at = batch.column(3), 0
            flat, ends = lists.flatten().to_numpy().view(np.uint64), np.cumsum(lists.value_lengths().to_numpy())
            minor, keys, packs, rows = batch.column(2).to_pylist(), [], [], []
            for row, end in enumerate(ends.tolist()):
                s, n, at = flat[at:end], end - at, end
                s = s[np.lexsort((s, table[(s >> np.uint64(20)).astype(np.int64) & (CELLS - 1)]))]
                low, high = -(-least * n // 100), 100 * n // least
                own, first, last = np.searchsorted(bounds, [n, low, high], side="right").tolist()
                for c in range(first, last + 1):
                    length = n + 1 + (-least * (n + max(low, int(bounds[c - 1])))) // (100 + least)
                    if length > 0:
                        keys.append((s[:length] ^ np.uint64((min(c, own) << 12 | max(c, own)) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93))
                        side = 1 + (own > c) - (own < c)
                        packs.append((np.int64(n) << 33) | ((n - np.arange(length, dtype=np.int64)) << 3) | (side << 1) | minor[row])
                        rows.append(np.full(length, row))
            merge = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind)
            index = pa.array(merge(rows, np.int64))
            taken = [batch.column(i).take(index) for i in range(2)]
            return pa.RecordBatch.from_arrays([pa.array(merge(keys, np.uint64).view(np.int64)), *taken, pa.array(merge(packs, np.int64))], names=["key", "id", "component", "packed"])

        return step

    return map_batches(sets.select("id", "component", "minor", "shingles"), "key long, id long, component long, packed long", start)


def prefix_pairs(sets: DataFrame, least: int, scratch: Scratch) -> DataFrame:
    """Pairs a < b of different components, one of them minor, that can reach the similarity by a shared rare shingle: as it may be the
    rarest that they share, both must have enough shingles from its place on. ``sets``: id, component, minor, shingles."""
    keys = scratch.keep(prefix_keys(sets, shingle_counts(sets), least))
    x, y = keys.where("packed & 1 = 1").alias("x"), keys.alias("y")
    room = F.expr(f"{100 + least} * least(shiftright(x.packed, 3) & 1073741823, shiftright(y.packed, 3) & 1073741823) >= {least} * (shiftright(x.packed, 33) + shiftright(y.packed, 33))")
    sides = F.expr("(shiftright(x.packed, 1) & 3) + (shiftright(y.packed, 1) & 3) = 2")
    met = x.join(y, F.expr("x.key = y.key and x.component <> y.component and (y.packed & 1 = 0 or x.id < y.id)") & sides & room)
    found = scratch.keep(met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct())
    scratch.drop(keys)
    return found


def shared_keys(banded: DataFrame, scratch: Scratch) -> DataFrame:
    """Columns key, id of the buckets with several members."""
    shared = scratch.keep(banded.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("key"))
    members = scratch.keep(banded.join(shared, "key", "left_semi").select("key", "id"))
    scratch.drop(shared)
    return members


def near_components(signed: DataFrame, docs: DataFrame, words: int, least: int, given: DataFrame, scratch: Scratch) -> DataFrame:
    """Columns id, component of the representatives (rows of ``signed``: id, signature) that are linked with others, also by the
    links ``given`` (a, b). Ids that choose rows of texts, signatures or sets are written first: the planner then knows their size
    and, where they are few, doesn't shuffle the rows."""
    banded = scratch.keep(signed.select("id", F.explode(band_keys()).alias("key")))
    members = shared_keys(banded, scratch)
    scratch.drop(banded)
    needed = scratch.keep(members.select("id").distinct())
    sets = scratch.keep(shingle_sets(docs.join(needed, "id", "left_semi"), words))
    sketches = scratch.keep(signed.join(needed, "id", "left_semi").select("id", sketch().alias("sketch")))
    pairs = scratch.keep(stars(members))
    edges = linked(pairs, sketches, sets, least, scratch)
    labels = scratch.keep(components(given.union(edges), scratch))
    scratch.drop(pairs, edges)
    open_ids = scratch.keep(open_members(members, labels))
    opened = scratch.keep(sets.join(open_ids, "id"))
    pairs = prefix_pairs(opened, least, scratch)
    scratch.drop(opened)
    edges = linked(pairs, sketches, sets, least, scratch)
    out = scratch.keep(joined_labels(labels, edges, scratch))
    scratch.drop(members, needed, sets, sketches, pairs, edges, labels, open_ids)
    return out


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, least: int = LEAST) -> DataFrame:
    """The rows of ``docs`` with ``n_shingles``, ``component_id`` and ``kept`` (the row has its component's smallest id).

    Words are runs without white space, A-Z in lower case. A document's set are its runs of ``words`` words (all its words where
    there are fewer), by 64-bit hashes; documents are linked at a Jaccard similarity of ``least`` hundredths or more, as counted on the
    full sets. With 32 bands of 4 coordinates, a pair of just 0.75 shares no band in 5 of a million cases.

    Null and empty texts have an empty set and are linked with nothing. Rows of the same id are one component, and each of them is
    kept or not as the id is. Rows without an id are linked with nothing, have no component and are kept. Ties go to the smallest
    id. Input columns of the same names are replaced. An empty table gives an empty result.
    """
    rows = packed(docs, id=docs[f"`{id_col}`"].cast("long"), text=docs[f"`{text_col}`"])
    texts = rows.select("id", "text")
    labels = document_components(texts, words, least)
    joined = rows.select("row", "id").join(labels, "id", "left")
    new = {"n_shingles": F.coalesce("n_shingles", F.lit(0).cast("long")), "component_id": F.col("component"), "kept": F.col("id").isNull() | (F.col("id") == F.col("component"))}
    return unpacked(joined, docs.columns, **new)


def document_components(texts: DataFrame, words: int = WORDS, least: int = LEAST) -> DataFrame:
    """Columns id, n_shingles, component: one row for each id of ``texts`` (id, text)."""
    texts = texts.where("id is not null")
    scratch = Scratch(texts.sparkSession)
    signed = scratch.keep(signatures(texts, words))
    classes = signed.where("n_shingles > 0").groupBy("k1", "k2").agg(F.min("id").alias("rep"))
    member = scratch.keep(signed.select("id", "k1", "k2", "n_shingles").join(classes, ["k1", "k2"], "left").select("id", "n_shingles", F.coalesce("rep", "id").alias("rep")))
    leads = scratch.keep(member.where("id = rep and n_shingles > 0").select("id").distinct())
    reps = scratch.keep(signed.where("n_shingles > 0").join(leads, "id", "left_semi").select("id", "signature"))
    scratch.drop(signed, leads)
    first = member.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).where("a < last").select("id", "a")
    given = scratch.keep(member.join(first, "id").where("rep <> a").select("a", F.col("rep").alias("b")))  # rows of one id with different texts
    labels = near_components(reps, texts, words, least, given, scratch).withColumnRenamed("id", "rep")
    found = member.join(labels, "rep", "left").select("id", "n_shingles", F.coalesce("component", "rep").alias("component"))
    return found.groupBy("id").agg(F.max("n_shingles").alias("n_shingles"), F.min("component").alias("component"))
