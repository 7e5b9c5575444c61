"""Queries that choose, cluster and build samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import text
from quarrymill.operators import metrics, samples, select
from quarrymill.sources.tables import table

QUERIES, ORACLE_SQL = {}, {}
FOLD_SQL = r"lower(trim(regexp_replace(coalesce(text, ''), '[ \t\n\r\x0B\f]+', ' ', 'g')))"
STRIP_SQL = r"regexp_replace(coalesce(text, ''), '^[\s]+|[\s]+$', '', 'g')"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


@query()
def near_dup_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leader clusters of all documents at a similarity of 0.92."""
    return select.leader_clusters(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text").select("doc_id", "cluster_id", "is_duplicate", "similarity")


@query("""
WITH RECURSIVE d AS (SELECT doc_id, trim(coalesce(text, '')) AS t, row_number() OVER (ORDER BY coalesce(quality, 0) DESC, n_chars DESC, doc_id) AS r FROM documents LEFT JOIN labels USING (doc_id)
), asked AS MATERIALIZED (SELECT doc_id, r, ['t' || sha256(t), 'f' || sha256(split_part(t, chr(10), 1)), 'l' || sha256(split_part(t, chr(10), -1))] AS keys FROM d
), fold AS (
  SELECT 0::BIGINT AS r, NULL::BIGINT AS doc_id, false AS accepted, []::VARCHAR[] AS seen
  UNION ALL
  SELECT a.r, a.doc_id, NOT list_has_any(f.seen, a.keys), CASE WHEN list_has_any(f.seen, a.keys) THEN f.seen ELSE list_concat(f.seen, a.keys) END FROM fold f JOIN asked a ON a.r = f.r + 1
) SELECT doc_id, accepted FROM fold WHERE r > 0
""")
def select_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the order of quality label, length and id; accepted if no accepted one has the same text, first line or last line."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    t = F.trim(F.coalesce("text", F.lit("")))
    keys = F.array(*[F.concat(F.lit(n), F.sha2(k, 256)) for n, k in (("t", t), ("f", F.substring_index(t, "\n", 1)), ("l", F.substring_index(t, "\n", -1)))])
    rank = F.struct((-F.coalesce("quality", F.lit(0))).alias("q"), (-F.col("n_chars")).alias("n"), F.col("doc_id").alias("i"))
    return select.select_first(d.select("doc_id", rank.alias("rank"), keys.alias("keys")), "doc_id", "rank", "keys")


@query(f"SELECT doc_id, length(t)::BIGINT AS n_chars, sha256(t) AS target_sha256 FROM (SELECT doc_id, {STRIP_SQL} AS t FROM documents) WHERE length(t) >= 24")
def causal_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = samples.causal_samples(table(spark, sf_dir, "documents"), "doc_id", "text")
    return d.select("doc_id", F.length("target_text").cast("long").alias("n_chars"), F.sha2("target_text", 256).alias("target_sha256"))


@query()
def instruction_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = samples.instruction_samples(table(spark, sf_dir, "documents"), "doc_id", "text")
    return d.select("doc_id", F.length("prompt").alias("prompt_chars"), F.length("answer").alias("answer_chars"), F.sha2(F.concat_ws("\n", "prompt", "answer"), 256).alias("pair_sha256"))


@query("""
WITH e AS (SELECT doc_id, [CASE WHEN lang = '' THEN 'collection_not_allowed' END, CASE WHEN source IN ('src0', 'src1') THEN 'access_deny' END, CASE WHEN n_chars % 7 = 0 THEN 'rights_not_allowed' WHEN n_chars % 5 = 0 THEN 'rights_review_expired' END,
  CASE WHEN n_chars % 11 = 0 THEN 'tdm_not_allowed' END, CASE WHEN toxic IS NULL OR toxic = 1 THEN 'privacy_not_passed' END, CASE WHEN quality IS NULL OR quality = 0 THEN 'quality_not_passed' END] AS v FROM documents LEFT JOIN labels USING (doc_id))
SELECT doc_id, len(list_filter(v, lambda x: x IS NOT NULL)) = 0 AS allowed, array_to_string(list_filter(v, lambda x: x IS NOT NULL), ',') AS violations FROM e
""")
def training_permission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permission from evidence that is derived from the documents' columns and labels; a missing label forbids."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    evidence = {
        "collection_allowed": F.col("lang") != "",
        "access_decision": F.when(F.col("source").isin("src0", "src1"), "deny").otherwise("allow"),
        "rights_decision": F.when(F.col("n_chars") % 7 == 0, "deny").otherwise("allow"),
        "rights_current": F.col("n_chars") % 5 != 0,
        "rights_reserved": F.lit(False),
        "tdm_allowed": F.col("n_chars") % 11 != 0,
        "privacy_result": F.when(F.col("toxic") == 0, "pass"),
        "dedupe_result": F.lit("pass"),
        "quality_result": F.when(F.col("quality") == 1, "pass"),
        "lineage_complete": F.lit(True),
        "activity_allowed": F.lit(True),
        "dpia_approved": F.lit(True),
    }
    v = d.withColumns(evidence).select("doc_id", samples.permission_violations().alias("v"))
    return v.select("doc_id", (F.size("v") == 0).alias("allowed"), F.array_join("v", ",").alias("violations"))


@query("""
WITH t AS (SELECT conv_id, turn, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r\\x0B\\f]+')) AS n FROM conversations), s AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn DESC) AS total FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns, min(turn)::BIGINT AS first_turn, sum(n)::BIGINT AS n_tokens FROM s WHERE total <= 256 GROUP BY conv_id
""")
def conversation_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest turns of each conversation that have 256 tokens together at most."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.size(text.space_tokens(F.coalesce("text", F.lit("")))).cast("long").alias("n"))
    return samples.packed_turns(t, "conv_id", "turn", "n", 256).groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.min("turn").alias("first_turn"), F.sum("n").alias("n_tokens"))


SIGN_SQL = "list_sum(list_transform(range(1, 64), lambda i: CASE WHEN embedding[i] > 0 THEN 1::BIGINT << (i - 1) ELSE 0 END))::BIGINT"


@query(f"""
WITH h AS (SELECT min(vec_id) AS id, x FROM (SELECT vec_id, {SIGN_SQL} AS x FROM embeddings) GROUP BY x)
SELECT a.id AS a, b.id AS b, bit_count(xor(a.x, b.x))::INT AS distance FROM h a JOIN h b ON a.id < b.id WHERE bit_count(xor(a.x, b.x)) <= 8
""")
def hamming_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors by the signs of their first 63 numbers, pairs that differ in eight at most."""
    bits = F.aggregate(F.transform(F.slice("embedding", 1, 63), lambda v, i: F.when(v > 0, F.expr("shiftleft(1L, 0)") * F.pow(F.lit(2.0), i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))), F.lit(0).cast("bigint"), lambda a, x: a + x)
    h = table(spark, sf_dir, "embeddings").select("vec_id", bits.alias("bits"))
    return samples.hamming_pairs(h, "vec_id", "bits", 8)


@query("""
WITH d AS (SELECT event_type, CASE WHEN abs(value - 1) <= 1e-9 THEN 0.5::DOUBLE WHEN value > 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS o FROM events), c AS (SELECT event_type, sum(o) AS k, count(*)::DOUBLE AS n FROM d GROUP BY event_type)
SELECT event_type, n::BIGINT AS n, round(k / n, 6) AS win_rate, round(greatest(0, (k / n + 3.8416 / (2 * n)) / (1 + 3.8416 / n) - 1.96 * sqrt(k / n * (1 - k / n) / n + 3.8416 / (4 * n * n)) / (1 + 3.8416 / n)), 6) AS low FROM c
""")
def paired_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as scores of a candidate against a baseline of 1: wins, ties as halves, and the interval's lower end."""
    v = F.col("value") - 1
    o = F.when(F.abs(v) <= 1e-9, 0.5).when(v > 0, 1.0).otherwise(0.0)
    c = table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum(o).alias("k"), F.count("*").alias("n"))
    return c.select("event_type", "n", F.round(F.col("k") / F.col("n"), 6).alias("win_rate"), F.round(metrics.wilson(F.col("k"), F.col("n").cast("double"))["low"], 6).alias("low"))


@query("SELECT event_type, count(*)::BIGINT AS n_tokens, round(exp(least(avg(value), 20)), 6) AS perplexity, round(avg((value < 1)::INT), 6) AS accuracy, max(value) <= 50 AS within_limit FROM events GROUP BY event_type")
def perplexity_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values as token losses: perplexity, share below 1, and a gate on the largest."""
    e = table(spark, sf_dir, "events").groupBy("event_type")
    return e.agg(F.count("*").alias("n_tokens"), F.round(F.exp(F.least(F.avg("value"), F.lit(20.0))), 6).alias("perplexity"), F.round(F.avg((F.col("value") < 1).cast("int")), 6).alias("accuracy"), (F.max("value") <= 50).alias("within_limit"))


VALUE_SQL = "coalesce(length({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"


@query(f"""
WITH h AS (SELECT sha256(concat_ws('|', {", ".join(VALUE_SQL.format(c=c) for c in ("doc_id", "lang", "source", "text"))})) AS h FROM documents)
SELECT count(*)::BIGINT AS n_rows, sha256(concat_ws(',', count(*)::VARCHAR, {", ".join(f"coalesce(sum(('0x' || substr(h, {15 * k + 1}, 15))::BIGINT::HUGEINT), 0)::VARCHAR" for k in range(4))})) AS fingerprint FROM h
""")
def snapshot_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.snapshot_fingerprint(table(spark, sf_dir, "documents"), "doc_id", ["text", "lang", "source"])


@query("SELECT split_part(raw, ':', 1) AS error, split_part(raw, ':', 2) AS kind, split_part(split_part(raw, ':', 3), '/', 1)::BIGINT AS current, split_part(split_part(raw, ':', 3), '/', 2)::BIGINT AS minimum, greatest(0, split_part(split_part(raw, ':', 3), '/', 2)::BIGINT - split_part(split_part(raw, ':', 3), '/', 1)::BIGINT)::BIGINT AS missing FROM (SELECT 'modality_coverage_below_min:' || lang || ':' || count(*) || '/400' AS raw FROM documents GROUP BY lang)")
def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts as the validator words them (name:kind:current/minimum), read back as gaps."""
    d = table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    raw = d.select(F.concat(F.lit("modality_coverage_below_min:"), "lang", F.lit(":"), F.col("n").cast("string"), F.lit("/400")).alias("raw"))
    p, q = F.split("raw", ":"), F.split(F.get(F.split("raw", ":"), F.lit(2)), "/")
    d = raw.select(p[0].alias("error"), p[1].alias("kind"), q[0].try_cast("long").alias("current"), q[1].try_cast("long").alias("minimum"))
    return d.withColumn("missing", F.greatest(F.lit(0).cast("long"), F.col("minimum") - F.col("current")))
