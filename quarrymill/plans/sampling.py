"""Queries on samples and what is stored: draws, intervals by resampling, shards by bytes, headings in order, upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import wording
from quarrymill.operators import metrics, sampling
from quarrymill.operators.lineage import Scratch
from quarrymill.sources import sinks
from quarrymill.sources.store import StoredTable
from quarrymill.sources.tables import table

QUERIES, ORACLE_SQL = {}, {}
PER_SHARD, MOST_BYTES, REPLICATES = 50, 10 * 10240, 100


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


@query("""
WITH w AS (SELECT doc_id, round(CASE WHEN lang = 'en' THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END / count(*) OVER (PARTITION BY lang, source) * 1048576)::BIGINT AS w FROM documents),
l AS (SELECT doc_id, sum(w) OVER (ORDER BY doc_id) - w AS before, w FROM w WHERE w > 0), t AS (SELECT sum(w)::HUGEINT AS total, count(*) AS n FROM w),
d AS (SELECT k AS draw, (('0x' || substr(md5('7:' || k), 1, 15))::BIGINT::HUGEINT * total) // (1::HUGEINT << 60) AS place FROM t, range(0, n) AS r(k))
SELECT draw, doc_id FROM d ASOF JOIN l ON d.place >= l.before
""")
def weighted_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many draws with replacement as there are documents, by language's weight and the size of each source in it."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    weighted = sampling.sample_weights(d, "lang", "source", F.when(F.col("lang") == "en", 1.0).otherwise(2.0))
    return sampling.weighted_draws(weighted, "doc_id", "weight", d.count(), seed=7)


@query(f"""
WITH e AS (SELECT event_type, event_id, value AS x FROM events WHERE value IS NOT NULL), r AS (
  SELECT event_type, k, x, ('0x' || substr(md5('0:' || event_id || ':' || k), 1, 12))::BIGINT / 281474976710656::DOUBLE AS u FROM e, range(0, {REPLICATES}) AS g(k)
), s AS (SELECT event_type, k, sum({" + ".join(f"(u >= {p!r}::DOUBLE)::INT" for p in metrics.POISSON)}) AS n, sum(({" + ".join(f"(u >= {p!r}::DOUBLE)::INT" for p in metrics.POISSON)}) * x) AS t FROM r GROUP BY ALL
), m AS (SELECT event_type, list_sort(list(t / n)) AS m FROM s WHERE n > 0 GROUP BY event_type)
SELECT event_type, n, round(mean, 6) AS mean, round(m[floor(len(m) * 0.025)::INT + 1], 6) AS low, round(m[ceil(len(m) * 0.975)::INT], 6) AS high FROM (SELECT event_type, count(*)::BIGINT AS n, avg(x) AS mean FROM e GROUP BY event_type) JOIN m USING (event_type)
""")
def bootstrap_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean value of each kind of event, with its interval over resampled means."""
    found = metrics.bootstrap_mean(table(spark, sf_dir, "events"), "event_id", "value", "event_type", replicates=REPLICATES)
    return found.select("event_type", "n", *[F.round(c, 6).alias(c) for c in ("mean", "low", "high")])


@query(f"""
WITH RECURSIVE s AS (SELECT *, greatest({sinks.room_for(MOST_BYTES)}, max(b) OVER ()) AS room FROM (SELECT lang, 512 + CAST(ceil(strlen(coalesce(text, '')) / 512.0) AS BIGINT) * 512 AS b, row_number() OVER (PARTITION BY lang ORDER BY sha256(doc_id::VARCHAR), doc_id) AS k FROM documents)
), f AS (
  SELECT lang, k, 0 AS shard, 1 AS n, b AS total FROM s WHERE k = 1 UNION ALL
  SELECT s.lang, s.k, CASE WHEN f.n + 1 > {PER_SHARD} OR f.total + s.b > room THEN f.shard + 1 ELSE f.shard END, CASE WHEN f.n + 1 > {PER_SHARD} OR f.total + s.b > room THEN 1 ELSE f.n + 1 END,
    CASE WHEN f.n + 1 > {PER_SHARD} OR f.total + s.b > room THEN s.b ELSE f.total + s.b END FROM f JOIN s ON s.lang IS NOT DISTINCT FROM f.lang AND s.k = f.k + 1
)
SELECT f.lang AS split, shard::BIGINT AS shard, count(*)::BIGINT AS n_samples, sum(b)::BIGINT AS n_bytes FROM f JOIN s ON s.lang IS NOT DISTINCT FROM f.lang AND s.k = f.k GROUP BY f.lang, shard
""")
def sized_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as members of tar shards, bounded by samples and bytes, as one pass over each language would fill them; documents of more than
    MOST_BYTES would be an error, so that a shard may hold the largest text."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", sinks.tar_bytes(F.coalesce("text", F.lit(""))).alias("b"))
    most = d.agg(F.coalesce(F.max("b"), F.lit(0))).first()[0]
    filled = sinks.filled_shards(d, "lang", [F.sha2(F.col("doc_id").cast("string"), 256), F.col("doc_id")], "b", PER_SHARD, max(sinks.room_for(MOST_BYTES), most))
    return filled.groupBy(F.col("lang").alias("split"), "shard").agg(F.count("*").alias("n_samples"), F.sum("b").alias("n_bytes"))


@query(r"""
WITH RECURSIVE d AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[ \t\n\r\x0B\f]+', ' ', 'g')) AS t, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(regexp_replace(x, '[ \t\r\x0B\f]+', ' ', 'g'))), lambda x: length(x) BETWEEN 1 AND 60) AS h FROM documents
), s AS (
  SELECT doc_id, 1 AS i, 0 AS cursor, []::BIGINT[] AS taken, []::VARCHAR[] AS kept, t, h FROM d UNION ALL
  SELECT doc_id, i + 1, CASE WHEN ok THEN found + length(h[i]) - 1 ELSE cursor END, CASE WHEN ok THEN list_append(taken, found * 100 + length(h[i])) ELSE taken END, CASE WHEN ok THEN list_append(kept, h[i]) ELSE kept END, t, h
  FROM (SELECT *, place > 0 AND NOT list_contains(taken, place * 100 + length(h[i])) AS ok, place AS found FROM (SELECT *, CASE WHEN strpos(substr(t, cursor + 1), h[i]) > 0 THEN cursor + strpos(substr(t, cursor + 1), h[i]) ELSE strpos(t, h[i]) END AS place FROM s WHERE i <= len(h)))
)
SELECT doc_id, len(h)::BIGINT AS n_lines, len(kept)::BIGINT AS n_kept, sha256(array_to_string(kept, chr(10))) AS headings_sha256 FROM s WHERE i = len(h) + 1
""")
def headings_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short lines as headings, found in order in the text on one line."""
    squeezed = lambda c: F.trim(F.regexp_replace(c, r"[ \t\n\r\x0B\f]+", " "))
    lines = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), squeezed), lambda x: F.length(x).between(1, 60))
    d = table(spark, sf_dir, "documents").select("doc_id", squeezed(F.coalesce("text", F.lit(""))).alias("t"), lines.alias("h"))
    kept = d.withColumn("kept", wording.headings_in_order(F.col("h"), F.col("t")))
    return kept.select("doc_id", F.size("h").cast("long").alias("n_lines"), F.size("kept").cast("long").alias("n_kept"), F.sha2(F.array_join("kept", "\n"), 256).alias("headings_sha256"))


@query("""
WITH b AS (SELECT user_id, event_type, arg_max({'value': value, 'props': props, 'at': ts}, {'ts': ts, 'id': event_id}) AS r FROM events WHERE user_id IS NOT NULL GROUP BY ALL),
c AS (SELECT *, lag(r) OVER w AS before, row_number() OVER (PARTITION BY user_id ORDER BY event_type DESC) AS back FROM b WINDOW w AS (PARTITION BY user_id ORDER BY event_type)),
d AS (SELECT *, before IS NULL OR before.value IS DISTINCT FROM r.value OR before.props IS DISTINCT FROM r.props AS changed FROM c)
SELECT user_id, count(*) FILTER (WHERE changed)::BIGINT AS version, round(arg_max(r.value, event_type) FILTER (WHERE changed), 6) AS value FROM d GROUP BY user_id
""")
def stored_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' last events of each kind as batches for a stored table, one kind after the other, each sent twice."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "value", "props", F.struct("ts", "event_id").alias("at"))
    schema = events.drop("event_type").schema
    users = StoredTable(spark, Scratch(spark).folder, schema, "user_id", buckets=8)
    for kind in sorted(r[0] for r in events.select("event_type").distinct().collect() if r[0] is not None):  # a few kinds
        for _ in range(2):
            users.apply(events.where(F.col("event_type") == kind), kind, "at")
    return users.read().select("user_id", "version", F.round("value", 6).alias("value"))
