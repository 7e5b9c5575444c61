"""Batch twins of the stateful operators, over events; the user plays the host."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.sources.tables import table
from quarrymill.streaming import hosts
from quarrymill.streaming.registry import registry

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with seconds, whether they failed (a value over 1.5), and what kind of answer that is."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return e.withColumns({"t": F.unix_micros(F.col("ts").cast("timestamp")) / 1e6, "failed": F.col("value") > 1.5, "kind": F.when(F.col("value") > 1.5, "refused").when(F.col("value") < 0.7, "ok").otherwise("other")})


@query("""
WITH RECURSIVE o AS (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events), f AS (
  SELECT user_id, rn, event_id, value AS m FROM o WHERE rn = 1 UNION ALL SELECT o.user_id, o.rn, o.event_id, 0.7::DOUBLE * f.m + 0.3::DOUBLE * o.value FROM f JOIN o ON o.user_id = f.user_id AND o.rn = f.rn + 1)
SELECT event_id, user_id, round(m, 6) AS mean FROM f
""")
def host_ewma(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = hosts.ordered_fold(outcomes(spark, sf_dir), "user_id", ["ts", "event_id"], "t", "value", hosts.ewma_step(), "event_id", "double")
    return f.select("event_id", "user_id", F.round("state_out", 6).alias("mean"))


@query()
def circuit_breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = hosts.ordered_fold(outcomes(spark, sf_dir), "user_id", ["ts", "event_id"], "t", "failed", hosts.circuit_step(), "event_id")
    return f.groupBy("user_id", F.col("state_out").alias("mode")).agg(F.count("*").alias("n"))


@query()
def host_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = hosts.ordered_fold(outcomes(spark, sf_dir), "user_id", ["ts", "event_id"], "t", "kind", hosts.suppression_step(), "event_id")
    return f.groupBy("user_id", F.col("state_out").alias("mode")).agg(F.count("*").alias("n"))


@query("""
WITH r AS (SELECT user_id, event_id, value > 1.5 AS failed, count(*) FILTER (WHERE value > 1.5) OVER w AS fails, count(*) FILTER (WHERE value <= 1.5) OVER w AS oks FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT event_id, user_id, CASE WHEN (oks - (NOT failed)::INT) > 0 OR (fails - failed::INT) >= 3 THEN 'closed' WHEN NOT failed THEN 'completed' WHEN fails >= 3 THEN 'exhausted' ELSE 'retry' END AS outcome FROM r
""")
def retry_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = hosts.ordered_fold(outcomes(spark, sf_dir), "user_id", ["ts", "event_id"], "t", "failed", hosts.retry_step(), "event_id")
    return f.select("event_id", "user_id", F.col("state_out").alias("outcome"))


@query("SELECT user_id, event_type, round(sum(value), 4) AS spent, round(sum(sum(value)) OVER (PARTITION BY user_id), 4) AS spent_by_host FROM events GROUP BY user_id, event_type")
def byte_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each host spends, by kind and in all; the second sum is over the few rows of the first."""
    from pyspark.sql import Window

    e = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.sum("value").alias("s"))
    return e.select("user_id", "event_type", F.round("s", 4).alias("spent"), F.round(F.sum("s").over(Window.partitionBy("user_id")), 4).alias("spent_by_host"))


@query()
def seen_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as keys of a registry with expiry and capacity: which events are of a user not seen lately."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("key"), F.col("ts").cast("timestamp").alias("ts"))
    return registry(e, "key", "ts", "event_id", capacity=64, ttl=3600.0)
