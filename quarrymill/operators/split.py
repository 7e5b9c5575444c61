"""Assignment of groups of rows to train, validation and test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.functions.text import hash_fraction

#: Groups of keys by the first hex digits of their hash; a group is ranked on its own.
PREFIX = 3


def hash_split(key: Column, train: float = 0.8, val: float = 0.1) -> Column:
    f = hash_fraction(key)
    return F.when(f < train, "train").when(f < train + val, "val").otherwise("test")


def target_counts(total: int, val: float, test: float) -> tuple[int, int]:
    """Keys for validation and test: the ratio rounded down, one at least of three or more, and one is left for training."""
    counts = [max(1 if r > 0 and total >= 3 else 0, int(total * r)) if r > 0 and total else 0 for r in (val, test)]
    while sum(counts) > max(0, total - 1) and any(counts):
        counts[1 if counts[1] >= counts[0] and counts[1] else 0] -= 1
    return counts[0], counts[1]


def ranked_keys(keys: DataFrame, key: str) -> tuple[DataFrame, int]:
    """Columns key and rank: of each distinct key by its SHA-256, from 1; and the number of keys.

    No sort of all in one task: keys are ranked inside groups of one hash prefix, and the groups' sizes, 16 ** PREFIX numbers at most,
    are summed on the driver and give what is added.
    """
    hashed = keys.select(F.col(key).cast("string").alias(key)).distinct().withColumn("_h", F.sha2(F.col(key), 256)).withColumn("_p", F.substring("_h", 1, PREFIX))
    before, total = [], 0
    for prefix, n in sorted(tuple(r) for r in hashed.groupBy("_p").count().collect()):
        before.append((prefix, total))
        total += n
    inside = hashed.withColumn("_rn", F.row_number().over(Window.partitionBy("_p").orderBy("_h", key)))
    offsets = keys.sparkSession.createDataFrame(before, "_p string, _before long")
    return inside.join(F.broadcast(offsets), "_p").select(key, (F.col("_before") + F.col("_rn")).alias("rank")), total


def exact_split(keys: DataFrame, key: str, val: float = 0.1, test: float = 0.1) -> DataFrame:
    """Columns key and split: the first keys by hash are for validation, the next for test, the rest for training."""
    ranked, total = ranked_keys(keys, key)
    n_val, n_test = target_counts(total, val, test)
    return ranked.select(key, F.when(F.col("rank") <= n_val, "val").when(F.col("rank") <= n_val + n_test, "test").otherwise("train").alias("split"))


def crossing_groups(df: DataFrame, group: str, split: str = "split") -> DataFrame:
    """Groups with rows in more than one split: leaks."""
    return df.groupBy(group).agg(F.array_sort(F.collect_set(split)).alias("splits")).where(F.size("splits") > 1)


def rebalanced(df: DataFrame, group: str, split: str, minimum: int) -> DataFrame:
    """Moves whole groups from train to splits with fewer than ``minimum`` rows, smallest groups first, ties by name.

    A running sum over the training groups' sizes decides, so that no group is divided and the splits stay apart. Of the groups only the
    smallest come to one task and are broadcast, as many as rows are missing, twice ``minimum`` at most.
    """
    sizes = df.groupBy(group, split).agg(F.count("*").alias("n"))
    have = {r[split]: r["n"] for r in df.groupBy(split).agg(F.count("*").alias("n")).collect()}  # a few splits
    need = {s: max(0, minimum - have.get(s, 0)) for s in ("val", "test")}
    total = sum(need.values())
    if not total:
        return df
    donors = sizes.where(F.col(split) == "train").orderBy("n", group).limit(total)  # each donor gives a row or more
    w = Window.orderBy("n", group).rowsBetween(Window.unboundedPreceding, -1)
    moved = donors.withColumn("_given", F.coalesce(F.sum("n").over(w), F.lit(0))).where(F.col("_given") < total)
    to = moved.select(group, F.when(F.col("_given") < need["val"], "val").otherwise("test").alias("_to"))
    return df.join(F.broadcast(to), group, "left").withColumn(split, F.coalesce("_to", split)).drop("_to")


def plan_moves(groups: list[dict], train_groups: int, kinds: list[str], counts: dict, minimum: int = 1) -> dict[str, str]:
    """Where groups of train go: for each kind in turn, first to val, then to test, where it is missing and has two or three rows or more.

    A group goes if train keeps another one. ``groups`` has the first candidates of each kind in order, with the rows of all kinds that each
    holds; ``counts`` the rows by kind and split.
    """
    moved: dict[str, str] = {}
    for kind in kinds:
        total = sum(counts[kind].values())
        for target, least in (("val", 2), ("test", 3)):
            if total < least or counts[kind].get(target, 0) >= minimum:
                continue
            found = next((g for g in groups if g["kinds"].get(kind) and g["group"] not in moved), None)
            if found is None or train_groups <= 1:
                continue
            moved[found["group"]] = target
            train_groups -= 1
            for k, n in found["kinds"].items():
                counts[k]["train"] -= n
                counts[k][target] = counts[k].get(target, 0) + n
    return moved


def represented(df: DataFrame, group: str, split: str, kind: str, order: str) -> DataFrame:
    """The rows with splits changed so that each kind (a modality, a task) that has rows enough stands in val and test, too: whole groups move
    from train, by ``order`` of their first rows, kinds by name. What can't be done for want of groups is left.

    The driver gets a row for each kind and split, and as many candidates of each kind as all kinds could need, two each: the square of the number of
    kinds, none of it growing with the rows. Groups in two splits are an error, as are null groups.
    """
    keyed = df.withColumn("_kind", F.coalesce(F.col(kind).cast("string"), F.lit("")))
    group_of = F.coalesce(F.col(group).cast("string"), F.raise_error("a row has no group").cast("string"))
    sizes = keyed.groupBy(group_of.alias("_group"), "_kind").agg(F.count("*").alias("n"), F.min(order).alias("_first"), F.min(split).alias("_s"), F.max(split).alias("_t"))
    counts: dict[str, dict[str, int]] = {}
    for r in keyed.groupBy("_kind", split).count().collect():  # kinds x splits
        counts.setdefault(r["_kind"], {})[r[split]] = r["count"]
    whole = sizes.groupBy("_group").agg(F.map_from_entries(F.collect_list(F.struct("_kind", "n"))).alias("kinds"), F.min("_first").alias("_first"), F.min("_s").alias("_s"), F.max("_t").alias("_t"))
    leak = F.raise_error(F.concat(F.lit("group in two splits: "), F.col("_group"))).cast("string")
    whole = whole.withColumn("_s", F.when(F.col("_s") == F.col("_t"), F.col("_s")).otherwise(leak))
    train = whole.where("_s = 'train'")
    best = Window.partitionBy("_kind").orderBy("_first", "_group")
    ranked = train.select("_group", "_first", F.explode(F.map_keys("kinds")).alias("_kind"), "kinds").withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= 2 * max(1, len(counts)))
    candidates = [{"group": r["_group"], "kinds": dict(r["kinds"])} for r in ranked.dropDuplicates(["_group"]).orderBy("_first", "_group").collect()]
    moved = plan_moves(candidates, train.count(), sorted(counts), counts)
    if not moved:
        return df.join(whole.where("_s is null").select("_group"), F.col(group).cast("string") == F.col("_group"), "left_anti")  # raises for leaks
    to = df.sparkSession.createDataFrame(sorted(moved.items()), "_group string, _to string")  # two for each kind at most
    checked = whole.select(F.col("_group").alias("_g"), "_s")
    out = df.join(checked, F.col(group).cast("string") == F.col("_g"), "left").join(F.broadcast(to), F.col("_g") == F.col("_group"), "left")
    return out.withColumn(split, F.coalesce("_to", "_s")).select(*df.columns)


def rebalanced_fully(df: DataFrame, group: str, split: str, modality: str, task: str, order: str, minimum: int = 0, strict: bool = False) -> DataFrame:
    """Modalities, then tasks, then sizes: ``represented`` twice, then ``rebalanced``. With ``strict``, an error where val or test still has fewer
    than ``minimum`` rows."""
    out = represented(represented(df, group, split, modality, order), group, split, task, order)
    if minimum:
        out = rebalanced(out, group, split, minimum)
        if strict:
            have = {r[split]: r["n"] for r in out.groupBy(split).agg(F.count("*").alias("n")).collect()}
            short = [s for s in ("val", "test") if have.get(s, 0) < minimum]
            if short:
                raise ValueError(f"too few groups to give {' and '.join(short)} {minimum} rows")
    return out
