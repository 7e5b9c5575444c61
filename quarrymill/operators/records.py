"""Records of media, segments and chunks: parents, merges, versions and intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_parent(rows: DataFrame, parents: DataFrame, keys: list[tuple[str, str]], value: str) -> DataFrame:
    """Adds ``parent`` (the ``value`` of the first of several keys that finds one) and ``parent_by`` (that key).

    ``keys``: pairs of a column of ``rows`` and one of ``parents``, in order of trust. A parents' key that is not unique takes the
    smallest value; null keys find nothing.
    """
    out, found = rows, []
    for i, (own, theirs) in enumerate(keys):
        one = parents.where(F.col(theirs).isNotNull()).groupBy(F.col(theirs).alias(f"_k{i}")).agg(F.min(value).alias(f"_p{i}"))
        out = out.join(one, F.col(own) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
        found.append(f"_p{i}")
    by = F.coalesce(*[F.when(F.col(p).isNotNull(), F.lit(own)) for p, (own, _) in zip(found, keys, strict=True)])
    return out.withColumn("parent", F.coalesce(*found)).withColumn("parent_by", by).drop(*found)


def first_seen(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key by ``order`` (distinct); rows without a key are dropped."""
    first = rows.where(F.col(key).isNotNull() & (F.trim(F.col(key).cast("string")) != "")).groupBy(key).agg(F.min(order).alias(order))
    return rows.join(first, [key, order], "left_semi")


def clean_segments(rows: DataFrame, ident: str, start: str, end: str, text: Column, confidence: Column) -> DataFrame:
    """Segments with text, no negative and no inverted times and a confidence of 0.01 at least; of equal ones by folded text and times
    the one with the smallest id."""
    kept = rows.where((F.trim(text) != "") & (F.coalesce(F.col(start), F.lit(0.0)) >= 0) & (F.coalesce(F.col(end), F.lit(0.0)) >= 0) & F.coalesce(F.col(end) >= F.col(start), F.lit(True)) & (F.coalesce(confidence, F.lit(1.0)) >= 0.01))
    keyed = kept.withColumn("_text", F.lower(F.trim(text)))
    first = keyed.groupBy("_text", start, end).agg(F.min(ident).alias(ident)).select(ident)
    return keyed.join(first, ident, "left_semi").drop("_text")


def timeline_summary(segments: DataFrame, group: str, start: str, end: str, duration: Column) -> DataFrame:
    """For each group: n_segments, first_start, last_end, covered (sum of lengths) and ratio of the duration, 1 at most."""
    length = F.greatest(F.lit(0.0), F.col(end) - F.col(start))
    out = segments.groupBy(group).agg(F.count("*").alias("n_segments"), F.min(start).alias("first_start"), F.max(end).alias("last_end"), F.sum(length).alias("_covered"), F.max(duration).alias("_duration"))
    ratio = F.when(F.col("_duration") > 0, F.round(F.least(F.lit(1.0), F.col("_covered") / F.col("_duration")), 4))
    return out.select(group, "n_segments", "first_start", "last_end", F.round("_covered", 4).alias("covered"), ratio.alias("ratio"))


def covered_ranges(ranges: DataFrame, group: str, start: str, end: str) -> DataFrame:
    """Columns group, start, end: ranges that touch or overlap as one. A group's ranges are in the order of their starts in one task."""
    ordered = Window.partitionBy(group).orderBy(start, end)
    before = F.max(end).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    marked = ranges.withColumn("_new", F.when(before.isNull() | (F.col(start) > before), 1).otherwise(0)).withColumn("_run", F.sum("_new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(group, "_run").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_run")


def points_in_segments(points: DataFrame, segments: DataFrame, group: str, at: str, start: str, end: str, bucket: float) -> DataFrame:
    """Points with the segments of their group that hold them, both ends included.

    A segment is in each bucket of time that it touches, a point in one, so that they meet by group and bucket: a busy group is
    spread, and no pair is met twice.
    """
    bucket_of = lambda c: F.floor(c / bucket)
    spread = segments.withColumn("_b", F.explode(F.sequence(bucket_of(F.col(start)), bucket_of(F.col(end)))))
    return points.withColumn("_b", bucket_of(F.col(at))).join(spread, [group, "_b"]).where(F.col(at).between(F.col(start), F.col(end))).drop("_b")


def weighted_quality(runs: DataFrame, quality: str, weight: str) -> DataFrame:
    """One row: n_runs and quality weighted by objects; null if any run has no evidence."""
    known = F.col(quality).isNotNull() & (F.col(weight) > 0)
    mean = F.when(F.count_if(~known) == 0, F.sum(F.col(quality) * F.col(weight)) / F.sum(weight))
    return runs.agg(F.count("*").alias("n_runs"), F.round(mean, 6).alias("quality"))


def merged_candidates(rows: DataFrame, key: str, preference: list[Column], order: str, fields: list[str]) -> DataFrame:
    """One row for each key: the preferred row's fields, and where it has none, those of the next that has. Ties go to ``order``."""
    rank = F.struct(*[(-p).alias(f"_{i}") for i, p in enumerate(preference)], F.col(order))
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct(rank.alias("_r"), F.col(c).alias("v")))).getField("v")
    return rows.groupBy(key).agg(F.count("*").alias("n_merged"), F.min(rank).getField(order).alias(order), *[first(c).alias(c) for c in fields])


def merged_gaps(left: Column, right: Column) -> Column:
    """Maps of missing counts as one, the larger of each, without what isn't missing."""
    none = F.create_map().cast("map<string,bigint>")
    both = F.map_zip_with(F.coalesce(left, none), F.coalesce(right, none), lambda k, a, b: F.greatest(F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0))))
    return F.map_filter(both, lambda k, v: v > 0)


def at_least(rows: DataFrame, key: str, least: int) -> DataFrame:
    """Rows of keys with ``least`` rows or more; the counts, one row a key, decide."""
    return rows.join(rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select(key), key, "left_semi")
