"""Queries that admit samples: permission, quality, duplicates and quotas in one chain; splits, leakage reports and gates over what is admitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import selection, text
from quarrymill.functions.wording import bound
from quarrymill.operators import leakage, retrieval, select
from quarrymill.operators.lineage import Scratch
from quarrymill.operators.split import hash_split
from quarrymill.sources.tables import table

QUERIES, ORACLE_SQL = {}, {}
FOLD_SQL = r"lower(trim(regexp_replace(coalesce(text, ''), '[ \t\n\r\x0B\f]+', ' ', 'g')))"
QUOTAS = {"domain": 15, "domain_language": 10, "topic": 150}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def text_evidence(d: DataFrame, *columns: str) -> DataFrame:
    """The columns, and what a text's own words tell: closed, licensed, folded."""
    low = F.lower(F.coalesce("text", F.lit("")))
    return d.select(*columns, low.contains("by-nc").alias("closed"), low.contains("licensed under").alias("licensed"), text.folded(F.col("text")).alias("folded"))


def labelled(spark: SparkSession, sf_dir: str, told: DataFrame) -> DataFrame:
    """Documents with the evidence of their texts as samples: labels give quality and safety. Columns besides those stay."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return told.join(labels, "doc_id", "left").select(
        "doc_id",
        F.col("source").alias("domain"),
        F.concat(F.lit("https://"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("source_url"),
        F.col("lang").alias("language"),
        F.concat_ws("/", "source", "lang").alias("domain_language"),
        F.col("lang").alias("topic"),
        F.when(F.col("closed"), "no_training").otherwise("open").alias("usage_rules"),
        F.when(F.col("licensed"), "stated").alias("license"),
        F.when(F.col("toxic") == 1, "blocked").otherwise("clear").alias("safety_status"),
        F.coalesce(F.col("quality").cast("double"), F.lit(0.5)).alias("quality_score"),
        *[c for c in told.columns if c not in ("doc_id", "source", "lang", "closed", "licensed")],
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as samples with the evidence that the tables have: labels give quality and safety, a text's own words its licence and usage."""
    return labelled(spark, sf_dir, text_evidence(table(spark, sf_dir, "documents"), "doc_id", "lang", "source"))


SAMPLES_SQL = f"""
samples AS (
  SELECT doc_id, source AS domain, 'https://' || source || '/' || doc_id::VARCHAR AS source_url, lang AS language, concat_ws('/', source, lang) AS domain_language, lang AS topic,
    CASE WHEN contains(lower(coalesce(text, '')), 'by-nc') THEN 'no_training' ELSE 'open' END AS usage_rules, CASE WHEN contains(lower(coalesce(text, '')), 'licensed under') THEN 'stated' END AS license,
    CASE WHEN toxic = 1 THEN 'blocked' ELSE 'clear' END AS safety_status, coalesce(quality::DOUBLE, 0.5) AS quality_score, {FOLD_SQL} AS folded
  FROM documents LEFT JOIN (SELECT doc_id, quality, toxic FROM labels) USING (doc_id)
), rejected AS (
  SELECT *, len(string_split(folded, ' ')) AS n, CASE WHEN folded = '' THEN 0 ELSE len(list_distinct(string_split(folded, ' '))) END AS u,
    CASE WHEN coalesce(trim(source_url) = '', true) THEN 'no_source' WHEN coalesce(trim(domain) = '', true) THEN 'no_domain' WHEN usage_rules = 'no_training' THEN 'usage_rules_blocked' END AS permission
  FROM samples
), reasons AS (
  SELECT *, coalesce(permission, CASE WHEN quality_score < 0.4 THEN 'low_modality_quality' WHEN coalesce(language IN ('en', 'de', 'fr'), false) THEN CASE WHEN safety_status = 'blocked' THEN 'safety_blocked' WHEN folded = '' OR 1.0 - u::DOUBLE / n > 0.6 THEN 'generic_caption' END ELSE 'language_not_allowed' END) AS reason FROM rejected
)"""


def generic(folded: Column) -> Column:
    """Nothing, or over 60 % repetition."""
    return (folded == "") | bound(F.split(folded, " "), lambda words: 1.0 - F.size(F.array_distinct(words)) / F.size(words) > 0.6)


def with_reasons(s: DataFrame) -> DataFrame:
    """The first reason of permission, else of quality; null if admitted. A column ``generic`` stands for the folded text."""
    permission = selection.permission_reject(F.col("source_url"), F.col("domain"), F.lit("allowed"), F.col("usage_rules"), F.lit(True), F.col("license"), require_license=False)
    quality = (
        F.when(F.col("quality_score") < 0.4, "low_modality_quality")
        .when(~selection.language_allowed(F.col("language"), F.lit(None).cast("double"), ["en", "de", "fr"], 0.5), "language_not_allowed")
        .when(F.col("safety_status") == "blocked", "safety_blocked")
        .when(F.col("generic") if "generic" in s.columns else generic(F.col("folded")), "generic_caption")
    )
    return s.withColumn("reason", F.coalesce(permission, quality))


@query(f"WITH {SAMPLES_SQL} SELECT coalesce(reason, 'admitted') AS reason, domain, count(*)::BIGINT AS n FROM reasons GROUP BY ALL")
def sample_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected samples by the first reason of permission and quality, and source."""
    s = with_reasons(samples(spark, sf_dir))
    return s.groupBy(F.coalesce("reason", F.lit("admitted")).alias("reason"), "domain").agg(F.count("*").alias("n"))


CHAIN_SQL = f"""
WITH RECURSIVE {SAMPLES_SQL}, asked AS MATERIALIZED (
  SELECT doc_id, domain, domain_language, coalesce(topic, '') AS topic, md5(folded) AS k, row_number() OVER (ORDER BY doc_id) AS r FROM reasons WHERE reason IS NULL
), fold AS (
  SELECT 0::BIGINT AS r, NULL::BIGINT AS doc_id, '' AS verdict, []::VARCHAR[] AS seen, []::VARCHAR[] AS ds, []::VARCHAR[] AS dls, []::VARCHAR[] AS ts
  UNION ALL
  SELECT r, doc_id, verdict, CASE WHEN verdict = 'accepted' THEN list_append(seen, k) ELSE seen END, CASE WHEN verdict = 'accepted' THEN list_append(ds, domain) ELSE ds END,
    CASE WHEN verdict = 'accepted' THEN list_append(dls, domain_language) ELSE dls END, CASE WHEN verdict = 'accepted' THEN list_append(ts, topic) ELSE ts END
  FROM (SELECT a.*, f.seen, f.ds, f.dls, f.ts, CASE WHEN list_contains(f.seen, a.k) THEN 'duplicate'
      WHEN len(list_filter(f.ds, lambda x: x = a.domain)) >= {QUOTAS["domain"]} OR len(list_filter(f.dls, lambda x: x = a.domain_language)) >= {QUOTAS["domain_language"]} OR len(list_filter(f.ts, lambda x: x = a.topic)) >= {QUOTAS["topic"]} THEN 'quota_exceeded' ELSE 'accepted' END AS verdict
    FROM fold f JOIN asked a ON a.r = f.r + 1)
), verdicts AS (
  SELECT doc_id, verdict FROM fold WHERE r > 0 UNION ALL SELECT doc_id, reason FROM reasons WHERE reason IS NOT NULL
)"""


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns doc_id, domain, language, verdict."""
    # Written once without texts: the choice and the final join would each read, fold and judge all texts again.
    s = Scratch(spark).keep(with_reasons(samples(spark, sf_dir)).select("doc_id", "domain", "language", "domain_language", "topic", F.md5("folded").alias("key"), "reason"))
    asked = s.where("reason is null").select("doc_id", "domain", "domain_language", "topic", F.array("key").alias("keys"))
    verdicts = select.select_within_quotas(asked, "doc_id", "doc_id", "keys", QUOTAS)
    return s.select("doc_id", "domain", "language", "reason").join(verdicts, "doc_id", "left").select("doc_id", "domain", "language", F.coalesce("reason", "verdict").alias("verdict"))


@query(CHAIN_SQL + " SELECT doc_id, verdict FROM verdicts")
def selection_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sample's verdict: a reason of permission or quality, duplicate, quota_exceeded, or accepted; only accepted samples use up quotas."""
    return chain(spark, sf_dir).select("doc_id", "verdict")


@query(CHAIN_SQL + " SELECT d.source AS domain, v.verdict, count(*)::BIGINT AS n FROM verdicts v JOIN documents d USING (doc_id) GROUP BY ALL")
def selection_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the chain's verdicts by source: the report that goes with the accepted samples."""
    return chain(spark, sf_dir).groupBy("domain", "verdict").agg(F.count("*").alias("n"))


SPLIT_SQL = "CASE WHEN f < 0.8 THEN 'train' WHEN f < 0.9 THEN 'val' ELSE 'test' END"
EVIDENCE = {"content_hash": "sha256(fold)", "first_line": "sha256(head)", "source_url": "sha256(url)"}
LEAKAGE_SQL = f"""
WITH base AS (
  SELECT doc_id, {SPLIT_SQL} AS split, fold, CASE WHEN length(fold) >= 40 THEN substr(fold, 1, 40) END AS head, CASE WHEN fold <> '' THEN source || '/' || substr(md5(fold), 1, 2) END AS url
  FROM (SELECT doc_id, source, {FOLD_SQL} AS fold, ('0x' || substr(sha256(doc_id::VARCHAR), 1, 16))::UBIGINT::DOUBLE / 18446744073709551615::DOUBLE AS f FROM documents)
), long AS (
  SELECT doc_id, split, 'content_hash' AS category, CASE WHEN fold <> '' THEN sha256(fold) END AS value FROM base UNION ALL SELECT doc_id, split, 'first_line', sha256(head) FROM base UNION ALL SELECT doc_id, split, 'source_url', sha256(url) FROM base
), sides AS (
  SELECT *, 'train_vs_holdout' AS comparison, split = 'train' AS is_left FROM long UNION ALL SELECT *, 'val_vs_test', split = 'val' FROM long WHERE split <> 'train'
), coverage AS (
  SELECT comparison, category, count(*) FILTER (WHERE is_left) AS n_left, count(*) FILTER (WHERE NOT is_left) AS n_right, count(value) FILTER (WHERE is_left) AS left_evidence, count(value) FILTER (WHERE NOT is_left) AS right_evidence FROM sides GROUP BY ALL
), pairs AS (
  SELECT comparison, category, sum(l * r) AS n_pairs FROM (SELECT comparison, category, value, count(*) FILTER (WHERE is_left) AS l, count(*) FILTER (WHERE NOT is_left) AS r FROM sides WHERE value IS NOT NULL GROUP BY ALL) GROUP BY ALL
)
SELECT comparison, category, n_left::BIGINT AS n_left, n_right::BIGINT AS n_right, left_evidence::BIGINT AS left_evidence, right_evidence::BIGINT AS right_evidence, coalesce(n_pairs, 0)::BIGINT AS n_pairs,
  coalesce(n_pairs, 0) = 0 AND left_evidence >= 0.9 * n_left AND right_evidence >= 0.9 * n_right AS passed
FROM coverage LEFT JOIN pairs USING (comparison, category)
"""


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns doc_id, split, category, value: what may give a row away; null where there is no valid evidence."""
    fold = text.folded(F.col("text"))
    d = table(spark, sf_dir, "documents").select("doc_id", "source", fold.alias("fold"), hash_split(F.col("doc_id").cast("string")).alias("split"))
    head = F.when(F.length("fold") >= 40, F.substring("fold", 1, 40))
    url = F.when(F.col("fold") != "", F.concat("source", F.lit("/"), F.substring(F.md5("fold"), 1, 2)))
    values = {"content_hash": F.sha2(F.when(F.col("fold") != "", F.col("fold")), 256), "first_line": F.sha2(head, 256), "source_url": F.sha2(url, 256)}
    return d.select("doc_id", "split", F.explode(F.array(*[F.struct(F.lit(k).alias("category"), v.alias("value")) for k, v in values.items()])).alias("e")).select("doc_id", "split", "e.category", "e.value")


@query(LEAKAGE_SQL)
def leakage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training against held-out rows and validation against test, by kind of evidence: rows, rows with valid evidence, pairs, and
    whether it passes: no pair, and evidence for nine tenths of each side."""
    return leakage.leakage_report(fingerprints(spark, sf_dir), least_coverage=0.9)


@query(f"""
WITH base AS (SELECT doc_id, {SPLIT_SQL} AS split, fold FROM (SELECT doc_id, {FOLD_SQL} AS fold, ('0x' || substr(sha256(doc_id::VARCHAR), 1, 16))::UBIGINT::DOUBLE / 18446744073709551615::DOUBLE AS f FROM documents) WHERE fold <> '')
SELECT l.doc_id AS left_id, r.doc_id AS right_id FROM base l JOIN base r ON l.fold = r.fold AND l.split = 'train' AND r.split <> 'train' ORDER BY 1, 2 LIMIT 1000
""")
def leakage_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first thousand pairs of the report: its sample, in a fixed order."""
    f = fingerprints(spark, sf_dir).where("category = 'content_hash' and value is not null")
    return leakage.leakage_samples(f.where("split = 'train'"), f.where("split <> 'train'"), "doc_id", "value", 1000)


STAGES = ("raw", "normalized", "deduplicated", "chunked", "admitted")
WINDOW_SQL = "SELECT DISTINCT {i} AS id, md5(array_to_string(w[p:p+7], ' ')) AS s FROM (SELECT {i}, regexp_extract_all({t}, '[^ \\t\\n\\r\\x0B\\f]+') AS w FROM {r}), unnest(range(1, len(w) - 6)) AS u(p)"


@query(f"""
WITH {SAMPLES_SQL}, d AS (SELECT doc_id, coalesce(text, '') AS raw, {FOLD_SQL} AS fold FROM documents), items AS ({WINDOW_SQL.format(i="item_id", t="lower(coalesce(text, ''))", r="benchmark")}),
keepers AS (SELECT min(doc_id) AS doc_id FROM d GROUP BY fold), chunks AS (SELECT doc_id, array_to_string(string_split(fold, ' ')[c * 96 + 1 : c * 96 + 128], ' ') AS fold FROM d, unnest(range(0, 1 + greatest(0, ceil((len(string_split(fold, ' ')) - 128) / 96.0)::BIGINT))) AS x(c)),
stages AS (
  SELECT 'raw' AS stage, id, s FROM ({WINDOW_SQL.format(i="doc_id", t="raw", r="d")}) UNION ALL SELECT 'normalized', id, s FROM ({WINDOW_SQL.format(i="doc_id", t="fold", r="d")})
  UNION ALL SELECT 'deduplicated', id, s FROM ({WINDOW_SQL.format(i="doc_id", t="fold", r="(SELECT d.* FROM d SEMI JOIN keepers USING (doc_id))")}) UNION ALL SELECT 'chunked', id, s FROM ({WINDOW_SQL.format(i="doc_id", t="fold", r="chunks")})
  UNION ALL SELECT 'admitted', id, s FROM ({WINDOW_SQL.format(i="doc_id", t="fold", r="(SELECT doc_id, folded AS fold FROM reasons WHERE reason IS NULL)")})
)
SELECT stage, count(DISTINCT x.id)::BIGINT AS n_documents, count(DISTINCT i.id)::BIGINT AS n_items FROM stages x JOIN items i USING (s) GROUP BY stage
""")
def contamination_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In which stages of preparation benchmark items are found: documents that share a window of eight words with an item, and the items.

    Texts are read once. A document without windows of items counts in no stage, so that all stages come from those with hits, which are written
    without texts: copies have the same windows, and a sample is admitted by itself."""
    scratch = Scratch(spark)
    items = table(spark, sf_dir, "benchmark").select("item_id", F.lower(F.coalesce("text", F.lit(""))).alias("t"))
    windows = scratch.keep(leakage.window_keys(items, "item_id", "t", 8))
    d = leakage.with_hits(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text")), "text", windows, 8, chunk=(128, 96))
    told = text_evidence(d, "doc_id", "lang", "source", "hits").withColumns({"fold_key": F.sha2("folded", 256), "generic": generic(F.col("folded"))})
    met = scratch.keep(told.drop("folded"))
    keys = lambda which: F.transform(F.filter("hits", which), lambda h: h["key"])
    stage = lambda df, name, which=lambda h: F.lit(True): df.select(F.lit(name).alias("stage"), "doc_id", keys(which).alias("keys")).where(F.size("keys") > 0)
    stages = (
        stage(met, "raw", lambda h: h["raw"])
        .union(stage(met, "normalized"))
        .union(stage(met.groupBy("fold_key").agg(F.min("doc_id").alias("doc_id"), F.first("hits").alias("hits")), "deduplicated"))
        .union(stage(met, "chunked", lambda h: h["chunked"]))
        .union(stage(with_reasons(labelled(spark, sf_dir, met)).where("reason is null"), "admitted"))
    )
    return leakage.contamination(stages, windows, "doc_id", "item_id")


@query("""
WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, CASE WHEN f < 0.8 THEN 'train' ELSE 'held' END AS split FROM (SELECT *, ('0x' || substr(sha256(vec_id::VARCHAR), 1, 16))::UBIGINT::DOUBLE / 18446744073709551615::DOUBLE AS f FROM embeddings)),
p AS (SELECT a.vec_id, b.vec_id AS negative_id, list_dot_product(a.v, b.v) AS s FROM e a JOIN e b ON a.vec_id % 20 = 0 AND a.split = b.split AND a.label <> b.label)
SELECT vec_id, negative_id, row_number() OVER (PARTITION BY vec_id ORDER BY round(s, 9) DESC, negative_id)::BIGINT AS rank FROM p QUALIFY rank <= 4
""")
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four most similar vectors of other families in the same split, for every twentieth vector, of all."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding", F.when(hash_split(F.col("vec_id").cast("string")) == "train", "train").otherwise("held").alias("split"))
    return retrieval.hard_negatives(e.where("vec_id % 20 = 0"), e, "vec_id", "embedding", "split", "label", most=4)


@query("""
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), p AS (SELECT a.vec_id, b.vec_id AS other, round(list_dot_product(a.v, b.v), 9) AS s FROM (SELECT * FROM e WHERE vec_id % 20 = 0) a, e b),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, other) AS rk FROM p WHERE vec_id <> other),
m AS (SELECT q.vec_id, l1.label = l0.label AS hit1, (SELECT bool_or(x.label = l0.label) FROM r JOIN embeddings x ON x.vec_id = r.other WHERE r.vec_id = q.vec_id AND r.rk <= 5) AS hit5, q.s AS s1 FROM r q JOIN embeddings l0 ON l0.vec_id = q.vec_id JOIN embeddings l1 ON l1.vec_id = q.other WHERE q.rk = 1)
SELECT count(*)::BIGINT AS n_queries, round(avg(hit1::INT), 6) AS recall_at_1, round(avg(hit5::INT), 6) AS recall_at_5, round(avg(s1), 4) AS mean_similarity FROM m
""")
def retrieval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall at one and five by label and the mean similarity of the nearest, for every twentieth vector against all others."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    return retrieval.recall_summary(e.where("vec_id % 20 = 0"), e, "vec_id", "embedding", "label")
