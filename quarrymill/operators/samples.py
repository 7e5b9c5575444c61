"""Training samples from texts and conversations, and whether they may be used."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
LEAST_CAUSAL, LEAST_INSTRUCTION, LEAST_PROMPT, LEAST_ANSWER = 24, 80, 48, 24
EVIDENCE = ("collection_allowed", "access_decision", "rights_decision", "rights_current", "rights_reserved", "tdm_allowed", "privacy_result", "dedupe_result", "quality_result", "lineage_complete", "activity_allowed", "dpia_approved")


def stripped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\s]+|[\s]+$", "")


def causal_samples(df: DataFrame, ident: str, text: str) -> DataFrame:
    """The stripped text as target where it has LEAST_CAUSAL characters."""
    d = df.select(ident, stripped(F.col(text)).alias("target_text"))
    return d.where(F.length("target_text") >= LEAST_CAUSAL)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once. Where columns of a projection are filtered on or used in a function over array elements, Spark
    computes them anew for each use, or each element."""
    return F.transform(F.array(value), use)[0]


def split_index(text: Column) -> Column:
    """The first end of a sentence from 70 % on, else the last one from 48 characters on, else a space; null if the text can't be divided."""

    def found(t: Column, target: Column) -> Column:
        # over all parts but the last: the place so far, the first end that is late enough, the last that isn't too early
        start = F.struct(F.lit(0).alias("at"), F.lit(None).cast("int").alias("late"), F.lit(None).cast("int").alias("early"))

        def step(s: Column, n: Column) -> Column:
            at = s["at"] + n
            return F.struct(at.alias("at"), F.coalesce(s["late"], F.when(at >= target, at)).alias("late"), F.when(at >= LEAST_PROMPT, at).otherwise(s["early"]).alias("early"))

        parts = F.transform(F.split(t, r"(?<=[.!?])(?=\s)"), lambda p: F.length(p))
        ends = bound(parts, lambda p: F.aggregate(F.slice(p, 1, F.size(p) - 1), start, step))
        back = F.instr(F.reverse(F.substring(t, F.lit(1), target)), " ")
        before = bound(back, lambda i: F.when(i > 0, target - i).otherwise(-1))  # of the last space, from 0
        after = F.call_function("locate", F.lit(" "), t, target + 1) - 1
        space = bound(bound(before, lambda i: F.when(i >= LEAST_PROMPT, i).otherwise(after)), lambda i: F.when((i > 0) & (i < F.length(t) - LEAST_ANSWER), i))
        return bound(ends, lambda e: F.coalesce(e["late"], e["early"], space))

    return bound(text, lambda t: bound(F.greatest(F.lit(LEAST_PROMPT), F.floor(F.length(t) * 0.7).cast("int")), lambda target: found(t, target)))


def with_split_index(df: DataFrame, text: str) -> DataFrame:
    """Adds ``split_index``."""
    return df.withColumn("split_index", split_index(F.col(text)))


def instruction_samples(df: DataFrame, ident: str, text: str) -> DataFrame:
    """Columns ident, prompt, answer: a text and its continuation. Filters don't reach below explode_outer, so that each text is divided once."""
    halves = lambda t, i: F.struct(stripped(F.substring(t, F.lit(1), i)).alias("prompt"), stripped(F.substring(t, i + 1, F.length(t))).alias("answer"))
    pair = bound(stripped(F.col(text)), lambda t: F.when(F.length(t) >= LEAST_INSTRUCTION, bound(split_index(t), lambda i: F.when(i.isNotNull(), halves(t, i)))))
    d = df.select(ident, F.explode_outer(F.array(pair)).alias("_p")).where("_p is not null").select(ident, "_p.prompt", "_p.answer")
    return d.where((F.length("prompt") >= LEAST_PROMPT) & (F.length("answer") >= LEAST_ANSWER))


def permission_violations() -> Column:
    """From the columns EVIDENCE: codes of what forbids training, in this order; what is missing forbids, too."""
    no = lambda c: ~F.coalesce(F.col(c).cast("boolean"), F.lit(False))
    other = lambda c, good: F.coalesce(F.col(c), F.lit("")) != good
    access = F.coalesce(F.col("access_decision"), F.lit("unknown"))
    codes = [
        F.when(no("collection_allowed"), "collection_not_allowed"),
        F.when(access != "allow", F.concat(F.lit("access_"), access)),
        F.when(other("rights_decision", "allow"), "rights_not_allowed").when(no("rights_current"), "rights_review_expired"),
        F.when(F.coalesce("rights_reserved", F.lit(True)), "rights_reserved"),
        F.when(no("tdm_allowed"), "tdm_not_allowed"),
        F.when(other("privacy_result", "pass"), "privacy_not_passed"),
        F.when(other("dedupe_result", "pass"), "dedupe_not_passed"),
        F.when(other("quality_result", "pass"), "quality_not_passed"),
        F.when(no("lineage_complete"), "lineage_incomplete"),
        F.when(no("activity_allowed"), "processing_activity_not_allowed"),
        F.when(no("dpia_approved"), "dpia_not_approved"),
    ]
    return F.filter(F.array(*codes), lambda c: c.isNotNull())


def packed_turns(turns: DataFrame, conv: str, turn: str, tokens: str, budget: int) -> DataFrame:
    """Turns before each conversation's last that fit the budget together with it, latest first: a running sum from the end decides."""
    w = Window.partitionBy(conv).orderBy(F.desc(turn)).rowsBetween(Window.unboundedPreceding, 0)
    return turns.withColumn("_sum", F.sum(tokens).over(w)).where(F.col("_sum") <= budget).drop("_sum")


def signed(n: int) -> int:
    """The long with these 64 bits."""
    return n - (1 << 64) if n >> 63 else n


def hamming_bands(most: int, width: int) -> tuple[list[int], int]:
    """Where bands begin, most // 3 + 1 as even as can be, and in how many bits at most a pair differs in one of them: two or fewer."""
    parts = most // 3 + 1
    return [i * width // parts for i in range(parts + 1)], most // parts


def band_of(value: Column, starts: list[int], i: int) -> Column:
    return F.shiftrightunsigned(value, starts[i]).bitwiseAND(F.lit(signed((1 << (starts[i + 1] - starts[i])) - 1)))


def hamming_keys(nodes: DataFrame, ident: str, bits: str, starts: list[int], turned: bool) -> DataFrame:
    """The nodes with each band's number and value, _i and _v, and if ``turned`` the values with one bit turned over.

    Partitions of a fixed number keep Spark from dealing keys that are few bytes, but meet often, to one task."""
    spark = nodes.sparkSession
    turns = lambda i: [0, *([1 << j for j in range(starts[i + 1] - starts[i])] if turned else [])]
    every = [F.struct(F.lit(i).alias("i"), band_of(F.col(bits), starts, i).bitwiseXOR(F.lit(signed(t))).alias("v")) for i in range(len(starts) - 1) for t in turns(i)]
    spread = nodes.select(ident, bits, F.explode(F.array(*every)).alias("_k")).select(ident, bits, F.col("_k.i").alias("_i"), F.col("_k.v").alias("_v"))
    return spread.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), "_i", "_v")


def hamming_pairs(df: DataFrame, ident: str, bits: str, most: int, width: int = 64) -> DataFrame:
    """Pairs a < b of rows whose hashes (long) differ in at most ``most`` bits.

    Rows with equal hashes are one node, so that copies meet once; pairs are of the smallest ids. In one of the bands a pair differs in two bits at
    most: there a value with at most one bit turned over is the other's, or one of the other's with one turned over. So bands are wide, and few nodes
    meet by chance. A pair is taken from its first such band alone, where the left value has the lowest bit that differs turned over, so that it comes once.
    """
    if not 0 <= most < width <= 64:
        raise ValueError("most must be under width, and width 64 at most")
    nodes = df.where(F.col(bits).isNotNull()).groupBy(F.col(bits).alias("_x")).agg(F.min(ident).alias("a"))
    (starts, radius), differ = hamming_bands(most, width), F.col("_x").bitwiseXOR(F.col("_y"))
    lowest = lambda z: F.when(z == F.lit(signed(1 << 63)), z).otherwise(z.bitwiseAND(F.negative(z)))
    here = F.lit(False)
    for i in range(len(starts) - 1):
        z = band_of(differ, starts, i)
        chosen = (F.col("_i") == i) & (F.bit_count(z) <= radius) & (F.col("_v") == band_of(F.col("_x"), starts, i).bitwiseXOR(lowest(z)))
        for j in range(i):
            chosen = chosen & (F.bit_count(band_of(differ, starts, j)) > radius)
        here = here | chosen
    right = nodes.select(F.col("a").alias("b"), F.col("_x").alias("_y"))
    met = hamming_keys(nodes, "a", "_x", starts, radius > 0).join(hamming_keys(right, "b", "_y", starts, radius > 1), ["_i", "_v"])
    return met.where((F.col("a") < F.col("b")) & (F.bit_count(differ) <= most) & here).select("a", "b", F.bit_count(differ).alias("distance"))


def snapshot_fingerprint(df: DataFrame, ident: str, content: list[str]) -> DataFrame:
    """One row: n_rows and fingerprint, the same for the same rows in any order and partitioning.

    A row's SHA-256 is over its values with their lengths, so that null and empty differ; its four parts of 60 bits are summed over all
    rows in each task, and the sums hashed once more. Sums find changes by accident or damage; they are no proof against an
    author who seeks rows of equal sums.
    """
    value = lambda c: F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
    row = F.sha2(F.concat_ws("|", *[value(c) for c in (ident, *sorted(content))]), 256)
    part = lambda k: F.coalesce(F.sum(F.conv(F.substring("_h", 15 * k + 1, 15), 16, 10).cast("decimal(38,0)")), F.lit(0)).cast("string")
    whole = df.select(row.alias("_h")).agg(F.count("*").alias("n_rows"), *[part(k).alias(f"_s{k}") for k in range(4)])
    return whole.select("n_rows", F.sha2(F.concat_ws(",", F.col("n_rows").cast("string"), *[f"_s{k}" for k in range(4)]), 256).alias("fingerprint"))
