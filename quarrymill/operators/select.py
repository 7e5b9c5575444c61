"""Choices that depend on earlier choices, in rounds: what is first among the undecided is decided for all at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.functions.text import stable_id
from quarrymill.operators import similar
from quarrymill.operators.lineage import Scratch


def select_first(samples: DataFrame, ident: str, order: str, keys: str) -> DataFrame:
    """Columns ident, accepted: taken in ``order`` (distinct), a sample is accepted if no accepted one before it has one of its keys.

    Each round accepts what comes first at all of its keys, and rejects what has a key of an accepted one. Keys are reduced to their
    first sample in every task, so a hot key costs no more than others; the rounds end, as the first undecided sample is accepted.
    """
    cut = Scratch(samples.sparkSession).keep
    undecided = cut(samples.select(ident, order, F.array_distinct(keys).alias("_keys")))
    done = cut(undecided.where(F.size("_keys") <= 0).select(ident, F.lit(True).alias("accepted")))
    undecided = cut(undecided.where(F.size("_keys") > 0))
    while not undecided.isEmpty():
        spread = undecided.select(ident, order, F.size("_keys").alias("_n"), F.explode("_keys").alias("_key"))
        first = spread.groupBy("_key").agg(F.min(order).alias("_first"))
        led = spread.join(first, "_key").where(F.col(order) == F.col("_first"))
        accepted = cut(led.groupBy(ident, order).agg(F.count("*").alias("_led"), F.max("_n").alias("_n")).where("_led = _n").select(ident))
        taken = spread.join(accepted, ident, "left_semi").select("_key").distinct()
        clashed = cut(spread.join(taken, "_key", "left_semi").select(ident).distinct().join(accepted, ident, "left_anti"))
        done = cut(done.union(accepted.withColumn("accepted", F.lit(True))).union(clashed.withColumn("accepted", F.lit(False))))
        undecided = cut(undecided.join(done.select(ident), ident, "left_anti"))
    return done


def select_within_quotas(samples: DataFrame, ident: str, order: str, keys: str, quotas: dict[str, int]) -> DataFrame:
    """Columns ident, verdict: 'accepted', 'duplicate' or 'quota_exceeded'.

    Taken in ``order`` (distinct), a sample is a duplicate if an accepted one before it has one of its ``keys`` (array), and exceeds a
    quota if as many accepted ones before it as that allows have its value in the quota's column (null is a value; 0 is no quota). Only
    accepted samples count, so that neither can be decided without the other.

    Each round accepts what has no undecided sample before it at any of its keys and would fit its quotas even if all undecided ones
    before it did; and it rejects what clashes with accepted ones or comes after a full quota. Of a quota's value only the first
    undecided samples are ranked, as many as it allows, which Spark keeps to that number in every task; so a hot value or key costs
    no more than others. The rounds end, as the first undecided sample is always decided.
    """
    scratch = Scratch(samples.sparkSession)
    quotas = {c: n for c, n in quotas.items() if n}
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_q{i}") for i, c in enumerate(quotas)]
    undecided = scratch.keep(samples.select(F.col(ident).alias("_id"), F.col(order).alias("_at"), F.array_distinct(keys).alias("_keys"), *columns))
    done = scratch.keep(undecided.select("_id", "_at", *[f"_q{i}" for i in range(len(quotas))]).limit(0).withColumn("verdict", F.lit("")))
    while not undecided.isEmpty():
        spread = undecided.select("_id", "_at", F.explode("_keys").alias("_key"))
        later = scratch.keep(spread.join(spread.groupBy("_key").agg(F.min("_at").alias("_first")), "_key").where("_at > _first").select("_id").distinct())
        fits = undecided.join(later, "_id", "left_anti")
        accepted = done.where("verdict = 'accepted'")
        for i, most in enumerate(quotas.values()):
            q = f"_q{i}"
            ranked = undecided.select("_id", "_at", q, F.row_number().over(Window.partitionBy(q).orderBy("_at")).alias("_rn")).where(F.col("_rn") <= most)
            before = ranked.join(accepted.select(q, F.col("_at").alias("_then")), q).where("_then < _at").groupBy("_id").agg(F.count("*").alias("_before"))
            room = ranked.join(before, "_id", "left").where(F.coalesce("_before", F.lit(0)) + F.col("_rn") <= most)
            fits = fits.join(room.select("_id"), "_id", "left_semi")
        new = scratch.keep(fits)
        mark = lambda df, verdict: df.select(*[c for c in done.columns if c != "verdict"], F.lit(verdict).alias("verdict"))
        all_accepted = scratch.keep(accepted.union(mark(new, "accepted")))
        rest = undecided.join(new.select("_id"), "_id", "left_anti")
        taken = new.select(F.explode("_keys").alias("_key")).distinct()
        copies = scratch.keep(rest.join(rest.select("_id", F.explode("_keys").alias("_key")).join(taken, "_key", "left_semi").select("_id").distinct(), "_id", "left_semi"))
        rest, over = rest.join(copies.select("_id"), "_id", "left_anti"), None
        clear = rest.join(later, "_id", "left_anti")  # what may yet be a duplicate waits
        for i, most in enumerate(quotas.values()):
            q = f"_q{i}"
            full = all_accepted.groupBy(q).agg(F.count("*").alias("_n"), F.max("_at").alias("_last")).where(F.col("_n") >= most)
            ended = clear.join(full.select(q, "_last"), q).where("_at > _last").select("_id")
            over = ended if over is None else over.union(ended)
        exceeded = scratch.keep(rest.join(over.distinct(), "_id", "left_semi") if over is not None else rest.limit(0))
        left = scratch.keep(rest.join(exceeded.select("_id"), "_id", "left_anti"))
        decided = scratch.keep(done.union(mark(new, "accepted")).union(mark(copies, "duplicate")).union(mark(exceeded, "quota_exceeded")))
        scratch.drop(undecided, done, new, all_accepted, copies, exceeded, later)
        undecided, done = left, decided
    return done.select(F.col("_id").alias(ident), "verdict")


def leader_clusters(docs: DataFrame, ident: str, text: str, least: float = 0.92, width: int = 4) -> DataFrame:
    """Columns ident, cluster_id, is_duplicate, similarity: taken in the order of ids as strings, a document joins the most similar
    leader before it (the earliest of equals) if that is similar enough, else it leads. Nothing is dropped.

    Texts with equal shingles are one node. A node leads if none of its similar nodes before it leads; that is decided in rounds for
    all nodes whose earlier neighbours are decided. Candidates are all similar pairs, not those of a few bands.
    """
    scratch = Scratch(docs.sparkSession)
    cut = scratch.keep
    found, (members,) = similar.class_pairs([docs.select(F.col(ident).cast("string").alias("id"), F.col(text).alias("text"))], least, width, scratch, by_set=True)
    nodes = cut(members.groupBy("k").agg(F.min("id").alias("node")))
    member = members.join(nodes, "k").select("id", "node")
    named = lambda k, name: nodes.select(F.col("k").alias(k), F.col("node").alias(name))
    pairs = cut(found.join(named("a", "_x"), "a").join(named("b", "_y"), "b").select(F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"), "similarity"))
    state = cut(pairs.select(F.col("b").alias("node")).distinct())  # undecided: those with a similar node before them
    leaders = cut(pairs.select(F.col("a").alias("node")).distinct().join(state, "node", "left_anti"))
    joined = state.limit(0)
    while not state.isEmpty():
        led = cut(pairs.join(leaders.select(F.col("node").alias("a")), "a", "left_semi").select(F.col("b").alias("node")).distinct())
        joined = led
        rest = state.join(led, "node", "left_anti")
        waits = pairs.join(rest.select(F.col("node").alias("b")), "b", "left_semi").join(rest.select(F.col("node").alias("a")), "a", "left_semi").select(F.col("b").alias("node")).distinct()
        new = rest.join(waits, "node", "left_anti").join(leaders, "node", "left_anti")
        leaders = cut(leaders.union(new))
        state = cut(rest.join(leaders, "node", "left_anti"))
    joins = pairs.join(leaders.select(F.col("node").alias("a")), "a", "left_semi").join(joined.select(F.col("node").alias("b")), "b", "left_semi").join(leaders.select(F.col("node").alias("b")), "b", "left_anti")
    best = joins.groupBy("b").agg(F.max(F.col("similarity")).alias("s")).join(joins, "b").where("similarity = s").groupBy(F.col("b").alias("node")).agg(F.min("a").alias("leader"), F.max("s").alias("s"))
    out = member.join(best, "node", "left")
    leads = F.col("leader").isNull() & (F.col("id") == F.col("node"))
    leader = F.coalesce("leader", "node")
    return out.select(F.col("id").alias(ident), stable_id("cluster", leader).alias("cluster_id"), (~leads).alias("is_duplicate"), F.when(leads, 1.0).otherwise(F.bround(F.coalesce("s", F.lit(1.0)), 4)).alias("similarity"))


