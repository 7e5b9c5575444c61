"""Queries on samples made ready for release: their evidence, the reasons against them, and what their tasks ask for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import pii
from quarrymill.operators import finalize
from quarrymill.plans.privacy import EMAIL_SQL, IP_SQL, SENSITIVE_SQL, TEXT
from quarrymill.plans.selection import FOLD_SQL
from quarrymill.sources.tables import table

QUERIES, ORACLE_SQL = {}, {}
DEMANDS = finalize.Demands(
    accepted_languages=("en", "de", "fr"), min_quality={"text": 0.4, "image": 0.2}, min_context={"image": 0.2}, min_alignment_by_modality={"image": 0.25}, min_caption_quality=0.35
)


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as samples: labels give quality and safety, a text's own words its licence, consent and personal data. What the texts tell is
    found before the labels are joined, so that no text is shuffled."""
    t, low = F.coalesce("text", F.lit("")), F.col("_low")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    # What patterns can't do without is sought first, and what is used more than once is a column, as Spark would compute an expression anew.
    mail, address = t.contains("@") & (F.size(pii.emails(t)) > 0), t.rlike(r"[0-9]\.[0-9]") & (F.size(pii.ipv4(t, guarded=True)) > 0)
    d = table(spark, sf_dir, "documents").withColumns({"_low": F.lower(t), "_found": mail.cast("int") + address.cast("int")})
    worded = low.contains("token") | low.contains("secret") | low.contains("api") | low.contains("password")
    secrets, found = F.when(worded, F.size(pii.secrets(t))).otherwise(0), F.col("_found")
    d = d.select(
        "doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("document_id"), F.when(F.col("n_chars") > 5000, "document").otherwise("text").alias("modality"), F.lit("text_pretrain").alias("task"), "text",
        F.col("lang").alias("language"),
        pii.outcome(secrets, F.lit(0), pii.sensitive(t), found, found).alias("pii_outcome"), (~low.contains("all rights reserved")).alias("allow_training"),
        F.when(low.contains("licensed under"), "stated").alias("license"), F.concat(F.lit("https://"), "source").alias("source_url"),
    )
    told = finalize.text_evidence(d).drop("text").join(labels, "doc_id", "left")
    score, safety = F.coalesce(F.col("quality").cast("double"), F.lit(0.5)), F.when(F.col("toxic") == 1, "blocked")
    return told.withColumns({"quality_score": score, "safety_status": safety}).drop("doc_id", "quality", "toxic")


def pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as pictures with their names as captions; scores and evidence come from the key and the size."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("p"), k.cast("string")).alias("document_id"), F.lit("image").alias("modality"), F.lit("image_text_pair").alias("task"),
        F.when(k % 11 == 0, "Photo").otherwise(F.concat_ws(" ", "p_name", "p_type")).alias("text"), F.lit("en-GB").alias("language"), (F.col("p_size") / 50.0).alias("quality_score"),
        F.when(k % 7 != 0, (k % 10) / 10.0).alias("context_score"), F.when(k % 13 != 0, (k % 8 + 2) / 10.0).alias("pairability_score"), F.lit("accept").alias("pii_outcome"),
        (k % 17 != 0).alias("allow_training"), F.lit("MIT").alias("license"), F.when(k % 5 != 0, F.hex(k)).alias("image_dhash"), F.hex(k).alias("image_phash"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).unionByName(finalize.text_evidence(pictures(spark, sf_dir)).drop("text"), allowMissingColumns=True)


ACCEPT_SQL = rf"""len({EMAIL_SQL}) = 0 AND len({IP_SQL}) = 0 AND len(list_filter([{SENSITIVE_SQL}], lambda x: x IS NOT NULL)) = 0
    AND NOT regexp_matches({TEXT}, '(?i)(?:token|secret|api[_-]?key|password)\s*[:=]\s*["'']?([0-9a-f]{{32,64}}|[A-Za-z0-9_\-]{{24,}})["'']?')"""
STOCK = ", ".join(f"'{g}'" for g in finalize.GENERIC)
SAMPLES_SQL = f"""
WITH s AS (
  SELECT 'd' || doc_id AS document_id, CASE WHEN n_chars > 5000 THEN 'document' ELSE 'text' END AS modality, false AS pair, coalesce(text, '') AS text, {FOLD_SQL} AS fold, lower(lang) AS language, coalesce(quality::DOUBLE, 0.5) AS q,
    NULL::DOUBLE AS context, NULL::DOUBLE AS pairability, coalesce(toxic = 1, false) AS toxic, {ACCEPT_SQL} AS accept, NOT contains(lower({TEXT}), 'all rights reserved') AS allowed,
    contains(lower({TEXT}), 'licensed under') AS licensed, 'https://' || source AS url, true AS hashed
  FROM documents LEFT JOIN (SELECT doc_id, quality, toxic FROM labels) USING (doc_id)
  UNION ALL SELECT 'p' || p_partkey, 'image', true, CASE WHEN p_partkey % 11 = 0 THEN 'Photo' ELSE p_name || ' ' || p_type END, CASE WHEN p_partkey % 11 = 0 THEN 'photo' ELSE lower(p_name || ' ' || p_type) END, 'en', p_size::DOUBLE / 50,
    CASE WHEN p_partkey % 7 <> 0 THEN (p_partkey % 10)::DOUBLE / 10 END, CASE WHEN p_partkey % 13 <> 0 THEN (p_partkey % 8 + 2)::DOUBLE / 10 END, false, true, p_partkey % 17 <> 0, true, NULL, p_partkey % 5 <> 0
  FROM part
), e AS (
  SELECT *, string_split(fold, ' ') AS w, toxic OR len(list_filter({list(finalize.SAFETY_TERMS)}, lambda x: contains(lower(text), x))) > 0 AS unsafe, CASE WHEN pair THEN least(1.0, q, pairability, context) ELSE q END AS aligned,
    CASE WHEN allowed AND licensed THEN 'training_allowed' WHEN NOT allowed THEN 'blocked' ELSE 'unknown' END AS usage_status
  FROM s
), g AS (
  SELECT *, fold = '' OR fold IN ({STOCK}) OR (len(w) <= 2 AND len(list_filter(w, lambda x: x IN ({STOCK}))) > 0) OR 1.0::DOUBLE - len(list_distinct(w))::DOUBLE / len(w) > 0.6 AS generic FROM e
), v AS (
  SELECT *, CASE WHEN unsafe THEN 'blocked_safety_content' WHEN NOT accept THEN 'blocked_pii_content' WHEN usage_status = 'blocked' THEN 'usage_rules_blocks_training' WHEN generic THEN 'generic_or_uninformative_caption' END AS quarantine_reason FROM g
)"""


@query(SAMPLES_SQL + r""" SELECT document_id, language, CASE WHEN unsafe THEN 'blocked' ELSE 'passed' END AS safety_status, CASE WHEN accept THEN 'passed' ELSE 'blocked' END AS pii_status, usage_status, round(aligned, 4) AS alignment_score,
  sha256(text || CASE WHEN text = '' OR url IS NULL THEN '' ELSE chr(10) END || coalesce(url, '')) AS content_hash, CASE WHEN fold <> '' THEN sha256(fold) END AS normalized_text_sha256, hashed AS fingerprints_complete, quarantine_reason FROM v""")
def finalized_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pictures with the evidence that a release asks for."""
    s = samples(spark, sf_dir)
    return finalize.finalized(s, DEMANDS).select("document_id", "language", "safety_status", "pii_status", "usage_status", "alignment_score", "content_hash", "normalized_text_sha256", "fingerprints_complete", "quarantine_reason")


@query(SAMPLES_SQL + """ SELECT modality, coalesce(CASE WHEN pair AND coalesce(pairability, 0) < 0.3 THEN 'low_alignment_score' WHEN (modality = 'text' AND q < 0.4) OR (modality = 'image' AND q < 0.2) THEN 'low_modality_quality'
    WHEN modality = 'image' AND (context IS NULL OR context < 0.2) THEN 'low_context_score' WHEN round(aligned, 4) < 0.3 THEN 'low_alignment_score' WHEN language IS NULL OR language NOT IN ('en', 'de', 'fr') THEN 'language_rules_reject'
    WHEN unsafe OR NOT accept THEN 'safety_or_pii_blocked' WHEN NOT hashed THEN 'required_fingerprint_evidence_missing' WHEN quarantine_reason IS NOT NULL THEN quarantine_reason WHEN modality = 'image' AND q < 0.35 THEN 'low_caption_quality' END, 'none') AS reason, count(*)::BIGINT AS n FROM v GROUP BY ALL""")
def sample_quality_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pictures by the first reason against their quality."""
    s = samples(spark, sf_dir)
    reasons = finalize.quality_reason(finalize.finalized(s, DEMANDS), DEMANDS)
    return reasons.groupBy("modality", F.coalesce("reason", F.lit("none")).alias("reason")).agg(F.count("*").alias("n"))


@query("""
WITH t AS (SELECT u.conv_id, u.turn, u.text AS instruction, a.text AS target FROM conversations u LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' WHERE u.role = 'user'),
e AS (SELECT conv_id, turn, unnest(list_filter([CASE WHEN coalesce(trim(instruction), '') = '' THEN 'missing_required_modality:text' END, CASE WHEN coalesce(trim(instruction), '') = '' THEN 'missing_required_field:instruction' END, CASE WHEN coalesce(trim(target), '') = '' THEN 'missing_required_field:target_text' END, CASE WHEN coalesce(trim(instruction), '') <> '' AND coalesce(trim(target), '') <> '' THEN 'none' END], lambda x: x IS NOT NULL)) AS error FROM t)
SELECT error, count(*)::BIGINT AS n, min(conv_id)::BIGINT AS first_conv_id FROM e GROUP BY error
""")
def sample_task_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What users' turns, taken as instructions with the answers that follow, lack for their task."""
    c = table(spark, sf_dir, "conversations")
    answers = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("target"))
    t = c.where("role = 'user'").select("conv_id", "turn", "text").join(answers, ["conv_id", "turn"], "left")
    has = F.when(finalize.filled(F.col("text")), F.array(F.lit("text"))).otherwise(F.array().cast("array<string>"))
    errors = finalize.task_errors(F.lit("instruction_following"), has, F.create_map(F.lit("instruction"), "text", F.lit("target_text"), "target"))
    e = t.select("conv_id", F.explode(F.when(F.size(errors) > 0, errors).otherwise(F.array(F.lit("none")))).alias("error"))
    return e.groupBy("error").agg(F.count("*").alias("n"), F.min("conv_id").alias("first_conv_id"))
