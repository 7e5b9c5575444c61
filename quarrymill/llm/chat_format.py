"""Logged conversations without those that are beginnings of longer ones, rendered as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import cut

#: What stands before a role, between role and text, and after a turn.
OPEN, BETWEEN, CLOSE = "<|", "|>\n", "\n<|end|>\n"


def rolling(turns: Column) -> Column:
    """For each number of turns, a 128-bit hash of the turns so far: the one before, hashed together with the next turn's."""
    zero = F.struct(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"))
    step = lambda h, t: F.struct(F.xxhash64(h["a"], t["h1"], t["h2"]).alias("a"), F.xxhash64(t["h2"], h["b"], t["h1"]).alias("b"))
    start = F.struct(zero.alias("last"), F.array().cast("array<struct<a:bigint,b:bigint>>").alias("all"))
    return F.aggregate(turns, start, lambda s, t: F.struct(step(s["last"], t).alias("last"), F.concat(s["all"], F.array(step(s["last"], t))).alias("all")), lambda s: s["all"])


def hashed_turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Columns conv_id, turn, role, h1, h2 (hashes of role and text), text."""
    t = turns.select(
        turns[f"`{conv_col}`"].alias("conv_id"), turns[f"`{turn_col}`"].cast("long").alias("turn"), F.coalesce(turns[f"`{role_col}`"], F.lit("")).alias("role"), F.coalesce(turns[f"`{text_col}`"], F.lit("")).alias("text")
    ).where("conv_id is not null")
    return t.select("conv_id", "turn", "role", F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", F.lit(1), "role").alias("h2"), "text")


def chat_format(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each conversation that no longer one begins with: ``conv_id``, ``n_turns``, ``n_copies`` and ``rendered``.

    Of equal conversations the one with the smallest id stays; n_copies counts all that are equal to it, itself included. A
    conversation goes if its roles and texts are the first turns of a longer one.

    The turns are in the order of their numbers (null first); rows that are equal in all four columns are one turn, and turns of one
    number are ordered by role and then by a hash of the text. Null roles and texts are empty. Rows without a conversation's id are in no conversation and
    are left out. Other columns are not used. An empty table gives an empty result. A conversation is one row, as its rendering is;
    only hashes are compared, and those of common beginnings are reduced in each task before they are shuffled.
    """
    rows = hashed_turns(turns, conv_col, turn_col, role_col, text_col)
    held = rows.groupBy("conv_id").agg(F.sort_array(F.collect_set(F.struct("turn", "role", "h1", "h2"))).alias("turns"))
    keys = cut(held.select("conv_id", F.size("turns").alias("n_turns"), rolling(F.col("turns")).alias("prefixes")))
    full = keys.select("conv_id", F.element_at("prefixes", -1).alias("h"))
    whole = full.groupBy("h.a", "h.b").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    begun = keys.where("n_turns > 1").select(F.explode(F.slice("prefixes", 1, F.col("n_turns") - 1)).alias("h")).select("h.a", "h.b").distinct()
    most = whole.join(begun, ["a", "b"], "left_anti").select("conv_id", "n_copies")
    left = rows.join(most, "conv_id").groupBy("conv_id", "n_copies").agg(F.sort_array(F.collect_set(F.struct("turn", "role", "h1", "h2", "text"))).alias("turns"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(BETWEEN), t["text"], F.lit(CLOSE))), "")
    return left.select("conv_id", F.size("turns").cast("long").alias("n_turns"), "n_copies", text.alias("rendered"))
