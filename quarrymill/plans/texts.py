"""Queries on the documents' texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import language, text
from quarrymill.operators.chunks import chunk_documents
from quarrymill.operators.dedup import best_per_key, top_per_key
from quarrymill.operators.lineage import Scratch
from quarrymill.operators.split import exact_split, hash_split
from quarrymill.sources.tables import table

QUERIES, ORACLE_SQL = {}, {}
quoted = lambda xs: ", ".join("'" + x.replace("'", "''") + "'" for x in xs)

TEXT = "coalesce(text, '')"
TOKENS_SQL = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]+')"
SPACED_SQL = r"regexp_extract_all({}, '[^ \t\n\r\x0B\f]+')"
MARKERS_SQL = " + ".join(f"((length(t) - length(replace(t, '{m}', ''))) // {len(m)})" for m in text.CODE_MARKERS)
NORMAL_SQL = (
    r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), "
    r"'[\x00-\x08\x0e-\x1f\x7f]', '', 'g'), '[ \t\x0b\x0c]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g')"
)
SIGNALS_SQL = f"""
normal AS (SELECT doc_id, lang, source, {NORMAL_SQL} AS t FROM documents),
worded AS (SELECT *, {TOKENS_SQL.format("t")} AS w FROM normal),
signals AS (
  SELECT doc_id, lang, source, t, length(t)::BIGINT AS n_chars, len(w)::BIGINT AS n_tokens, len(list_distinct(w))::BIGINT AS n_unique,
    CASE WHEN length(t) > 0 THEN length(regexp_replace(t, '[^\\x00-\\x7F]', '', 'g'))::DOUBLE / length(t) ELSE 0 END AS ascii_ratio,
    CASE WHEN len(w) > 0 THEN coalesce(list_sum(list_transform(range(2, len(w) + 1), lambda i: (w[i] = w[i-1])::INT)), 0)::DOUBLE / len(w) ELSE 0 END AS repetition,
    CASE WHEN len(w) > 0 THEN len(list_filter(w, lambda x: x IN ({quoted(text.BOILERPLATE)})))::DOUBLE / len(w) ELSE 0 END AS boilerplate,
    least(1.0::DOUBLE, ({MARKERS_SQL})::DOUBLE / greatest(1, len({SPACED_SQL.format("t")}))) AS code
  FROM worded
),
scored AS (
  SELECT *, CASE WHEN n_chars < 300 THEN 'text_too_short' WHEN n_chars > 200000 THEN 'text_too_long' WHEN boilerplate > 0.65 AND n_chars < 900 THEN 'boilerplate_heavy' WHEN lang IS NULL OR lang = '' THEN 'language_missing' END AS reason,
    greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1.0::DOUBLE - CASE WHEN n_chars < 600 THEN 0.25::DOUBLE ELSE 0 END - CASE WHEN n_chars < 1500 THEN 0.1::DOUBLE ELSE 0 END - CASE WHEN ascii_ratio < 0.85 THEN 0.1::DOUBLE ELSE 0 END
      - CASE WHEN boilerplate > 0.4 THEN 0.25::DOUBLE ELSE 0 END - CASE WHEN n_unique < 60 THEN 0.15::DOUBLE ELSE 0 END - CASE WHEN repetition > 0.45 THEN 0.15::DOUBLE ELSE 0 END - CASE WHEN code > 0.35 THEN 0.15::DOUBLE ELSE 0 END)) AS raw
  FROM signals
),
bucketed AS (
  SELECT *, CASE WHEN reason IS NOT NULL THEN least(raw, 0.25) ELSE raw END AS score,
    CASE WHEN reason IS NOT NULL THEN 'reject' WHEN raw >= 0.85 - 1e-9 THEN 'gold' WHEN raw >= 0.65 - 1e-9 THEN 'silver' WHEN raw >= 0.45 - 1e-9 THEN 'bronze' ELSE 'reject' END AS bucket FROM scored
)"""


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def signals(docs: DataFrame) -> DataFrame:
    """Adds t (normal text), counts and ratios; the texts are in a Latin script and without control characters by then."""
    d = docs.withColumn("t", text.normalize_text(F.col("text"))).withColumn("w", text.tokens(F.col("t")))
    n, w = F.length("t"), F.col("w")
    return d.withColumns(
        {
            "n_chars": n.cast("long"),
            "n_tokens": F.size(w).cast("long"),
            "n_unique": F.size(F.array_distinct(w)).cast("long"),
            "ascii_ratio": text.ratio(text.ascii_count(F.col("t")), n),
            "repetition": text.ratio(text.repeats(w), F.size(w)),
            "boilerplate": text.boilerplate_ratio(w),
            "code": text.code_ratio(F.col("t")),
        }
    ).drop("w")


def scored(docs: DataFrame) -> DataFrame:
    d = signals(docs).withColumn("reason", text.reject_reason(F.col("n_chars"), F.col("boilerplate"), F.col("lang")))
    raw = text.quality_score(F.col("n_chars"), F.col("ascii_ratio"), F.lit(0.0), F.col("boilerplate"), F.col("n_unique"), F.col("repetition"), F.col("code"), F.lit(1.0), F.lit(True))
    d = d.withColumn("raw", raw).withColumn("score", F.when(F.col("reason").isNotNull(), F.least("raw", F.lit(text.REJECT_CAP))).otherwise(F.col("raw")))
    return d.withColumn("bucket", text.bucket(F.col("raw") + 1e-9, F.col("reason")))


@query(f"""
WITH {SIGNALS_SQL}, best AS (SELECT * FROM bucketed WHERE bucket <> 'reject' QUALIFY row_number() OVER (PARTITION BY sha256(t) ORDER BY score DESC, doc_id) = 1
), ranked AS (SELECT *, row_number() OVER (ORDER BY sha256(doc_id::VARCHAR), doc_id::VARCHAR) AS rk, count(*) OVER () AS n FROM best
), split AS (SELECT *, CASE WHEN rk <= greatest(CASE WHEN n >= 3 THEN 1 ELSE 0 END, floor(n * 0.1::DOUBLE)) THEN 'val' WHEN rk <= 2 * greatest(CASE WHEN n >= 3 THEN 1 ELSE 0 END, floor(n * 0.1::DOUBLE)) THEN 'test' ELSE 'train' END AS split FROM ranked)
SELECT lang, bucket, split, count(*)::BIGINT AS n_docs, round(avg(score), 4) AS mean_score FROM split GROUP BY ALL
""")
def curation_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normal text, signals, score and reject reason, best of each exact text, exact-count split, counts.

    Verdicts and choices are written once without the texts: a filter on them would be computed through the signals, and the split
    reads its keys twice."""
    scratch = Scratch(spark)
    good = scratch.keep(scored(table(spark, sf_dir, "documents")).select("doc_id", "lang", "bucket", "score", F.sha2("t", 256).alias("exact_key"))).where("bucket <> 'reject'")
    best = scratch.keep(best_per_key(good, [F.col("exact_key")], [F.desc("score"), F.col("doc_id")]).withColumn("key", F.col("doc_id").cast("string")))
    split = best.join(exact_split(best, "key"), "key")
    return split.groupBy("lang", "bucket", "split").agg(F.count("*").alias("n_docs"), F.round(F.avg("score"), 4).alias("mean_score"))


@query(f"WITH {SIGNALS_SQL} SELECT doc_id, n_chars, n_tokens, n_unique, round(ascii_ratio, 4) AS ascii_ratio, round(repetition, 4) AS repetition, round(boilerplate, 4) AS boilerplate, round(code, 4) AS code FROM signals")
def text_quality_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = signals(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_chars", "n_tokens", "n_unique", *[F.round(c, 4).alias(c) for c in ("ascii_ratio", "repetition", "boilerplate", "code")])


@query(f"WITH {SIGNALS_SQL} SELECT bucket, coalesce(reason, CASE WHEN bucket = 'reject' THEN 'quality_below_threshold' ELSE '' END) AS reason, count(*)::BIGINT AS n_docs, round(avg(score), 4) AS mean_score FROM bucketed GROUP BY ALL")
def text_quality_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = scored(table(spark, sf_dir, "documents"))
    reason = F.coalesce("reason", F.when(F.col("bucket") == "reject", "quality_below_threshold").otherwise(""))
    return d.groupBy("bucket", reason.alias("reason")).agg(F.count("*").alias("n_docs"), F.round(F.avg("score"), 4).alias("mean_score"))


@query(rf"""
SELECT doc_id, length({TEXT})::BIGINT AS char_count, len({SPACED_SQL.format(TEXT)})::BIGINT AS token_count,
  len(list_filter(string_split({TEXT}, chr(10)), lambda x: regexp_matches(x, '[^ \t\r\x0B\f]')))::BIGINT AS line_count,
  len(list_filter(string_split_regex({TEXT}, '\n\n+'), lambda x: regexp_matches(x, '[^ \t\n\r\x0B\f]')))::BIGINT AS paragraph_count,
  CASE WHEN length({TEXT}) > 0 THEN round(length(regexp_replace({TEXT}, '[^\x00-\x7F]', '', 'g'))::DOUBLE / length({TEXT}), 4) ELSE 0.0::DOUBLE END AS ascii_ratio
FROM documents
""")
def text_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^ \t\r\x0b\x0c]"))
    paragraphs = F.filter(F.split(t, "\n\n+"), lambda x: x.rlike(r"[^ \t\n\r\x0b\x0c]"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.length(t).cast("long").alias("char_count"), F.size(text.space_tokens(t)).cast("long").alias("token_count"), F.size(lines).cast("long").alias("line_count"), F.size(paragraphs).cast("long").alias("paragraph_count"), F.round(text.ratio(text.ascii_count(t), F.length(t)), 4).alias("ascii_ratio")
    )


@query(f"SELECT doc_id, sha256({NORMAL_SQL}) AS normal_sha256, length({NORMAL_SQL})::BIGINT AS n_chars FROM documents")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = text.normalize_text(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(t, 256).alias("normal_sha256"), F.length(t).cast("long").alias("n_chars"))


@query(r"SELECT doc_id, CASE WHEN regexp_matches(h, 'licen[sc]e|copyright|terms') THEN 'legal' WHEN regexp_matches(h, 'readme|guide|tutorial|documentation') THEN 'documentation' ELSE 'content' END AS role FROM (SELECT doc_id, lower(regexp_extract(coalesce(text, ''), '^\s*#*\s*([^\n]{0,160})', 1)) AS h FROM documents)")
def content_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.content_role(F.coalesce("text", F.lit(""))).alias("role"))


HITS_SQL = ", ".join(f"len(list_filter(w, lambda x: x IN ({quoted(sorted(set(m.split())))})))::BIGINT AS hits_{lang}" for lang, m in language.MARKERS.items())


@query(rf"SELECT doc_id, len(w)::BIGINT AS n_words, {HITS_SQL} FROM (SELECT doc_id, regexp_extract_all(lower({TEXT}), '\p{{L}}{{2,}}') AS w FROM documents)")
def language_latin_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", language.words_of(F.coalesce("text", F.lit(""))).alias("w"))
    d = d.select("doc_id", F.size("w").cast("long").alias("n_words"), language.marker_words(F.col("w")).alias("m"))
    return d.select("doc_id", "n_words", *[h.cast("long").alias(f"hits_{k}") for k, h in language.marker_hits(F.col("m")).items()])


BEST_SQL = rf"""
WITH hits AS (SELECT doc_id, lang, len(w) AS n_words, {HITS_SQL} FROM (SELECT doc_id, lang, regexp_extract_all(lower({TEXT}), '\p{{L}}{{2,}}') AS w FROM documents)
), long AS (SELECT doc_id, lang, n_words, u.l, u.n, u.pos FROM hits, unnest([{", ".join(f"{{'l': '{k}', 'n': hits_{k}, 'pos': {i}}}" for i, k in enumerate(language.MARKERS))}]) AS x(u)
), ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, pos) AS rk, sum(n) OVER (PARTITION BY doc_id) AS total FROM long
), best AS (SELECT doc_id, any_value(lang) AS lang, any_value(n_words) AS n_words, any_value(total) AS total, max(CASE WHEN rk = 1 THEN l END) AS l, max(CASE WHEN rk = 1 THEN n END) AS n1, max(CASE WHEN rk = 2 THEN n END) AS n2 FROM ranked GROUP BY doc_id)
"""


@query(BEST_SQL + "SELECT lang, coalesce(CASE WHEN n1 >= 2 THEN CASE WHEN n2 > 0 AND n2 = n1 THEN NULL ELSE l END WHEN total <= 0 THEN 'und' END, 'none') AS detected, count(*)::BIGINT AS n_docs FROM best GROUP BY ALL")
def language_vs_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("lang", language.words_of(F.coalesce("text", F.lit(""))).alias("w"))
    d = d.select("lang", F.size("w").alias("n"), language.marker_words(F.col("w")).alias("m"))
    d = d.select("lang", "n", *[h.alias(k) for k, h in language.marker_hits(F.col("m")).items()])
    best = language.best_marker_language({k: F.col(k) for k in language.MARKERS}, F.col("n"))
    return d.select("lang", F.coalesce(best["language"], F.lit("none")).alias("detected")).groupBy("lang", "detected").agg(F.count("*").alias("n_docs"))


@query(rf"SELECT doc_id, len(regexp_extract_all({TEXT}, '\p{{Latin}}'))::BIGINT AS n_latin, len(regexp_extract_all({TEXT}, '\p{{Cyrillic}}'))::BIGINT AS n_cyrillic, len(regexp_extract_all({TEXT}, '\p{{Han}}'))::BIGINT AS n_han, len(regexp_extract_all({TEXT}, '\p{{L}}'))::BIGINT AS n_letters FROM documents")
def script_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    n = language.script_counts(t)
    return table(spark, sf_dir, "documents").select("doc_id", n["Latin"].cast("long").alias("n_latin"), n["Cyrillic"].cast("long").alias("n_cyrillic"), n["Han"].cast("long").alias("n_han"), F.regexp_count(t, F.lit(r"\p{L}")).cast("long").alias("n_letters"))


@query(f"""
WITH k AS (SELECT doc_id, lang, source, sha256({NORMAL_SQL}) AS exact_key, length({NORMAL_SQL})::BIGINT AS n FROM documents)
SELECT exact_key, min(doc_id) AS doc_id, count(*)::BIGINT AS n_copies, max(n) AS n_chars FROM k GROUP BY exact_key
""")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = text.normalize_text(F.col("text"))
    keys = table(spark, sf_dir, "documents").select("doc_id", F.sha2(t, 256).alias("exact_key"), F.length(t).cast("long").alias("n"))
    return keys.groupBy("exact_key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies"), F.max("n").alias("n_chars"))


@query("SELECT source, lang, doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id) = 1")
def best_per_source_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("source", "lang", "doc_id", "n_chars")
    return best_per_key(d, [F.col("source"), F.col("lang")], [F.desc("n_chars"), F.col("doc_id")])


@query("SELECT source, doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) <= 5")
def topn_per_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return top_per_key(d, ["source"], [F.desc("n_chars"), F.col("doc_id")], 5)


@query("SELECT doc_id, 'doc_' || substr(sha256(source || chr(31) || sha256(coalesce(text, ''))), 1, 16) AS document_id, 'sample_' || substr(sha256(doc_id::VARCHAR || '|train'), 1, 24) AS sample_id FROM documents")
def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = F.sha2(F.coalesce("text", F.lit("")), 256)
    sample = F.concat(F.lit("sample_"), F.substring(F.sha2(F.concat(F.col("doc_id").cast("string"), F.lit("|train")), 256), 1, 24))
    return table(spark, sf_dir, "documents").select("doc_id", text.stable_id("doc", F.col("source"), exact).alias("document_id"), sample.alias("sample_id"))


@query("SELECT CASE WHEN f < 0.8 THEN 'train' WHEN f < 0.9 THEN 'val' ELSE 'test' END AS split, count(*)::BIGINT AS n_docs, sum(doc_id)::BIGINT AS id_sum FROM (SELECT doc_id, ('0x' || substr(sha256(doc_id::VARCHAR), 1, 16))::UBIGINT::DOUBLE / 18446744073709551615::DOUBLE AS f FROM documents) GROUP BY ALL")
def hash_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", hash_split(F.col("doc_id").cast("string")).alias("split"))
    return d.groupBy("split").agg(F.count("*").alias("n_docs"), F.sum("doc_id").alias("id_sum"))


@query("""
WITH k AS (SELECT DISTINCT sha256(coalesce(text, '')) AS key FROM documents), r AS (SELECT key, row_number() OVER (ORDER BY sha256(key), key) AS rk, count(*) OVER () AS n FROM k)
SELECT key, CASE WHEN rk <= greatest(1, floor(n * 0.1::DOUBLE)) THEN 'val' WHEN rk <= 2 * greatest(1, floor(n * 0.1::DOUBLE)) THEN 'test' ELSE 'train' END AS split FROM r
""")
def exact_count_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "documents").select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("key"))
    return exact_split(keys, "key")


@query(rf"""
WITH p AS (SELECT doc_id, u.pos - 1 AS paragraph, {SPACED_SQL.format("u.p")} AS w FROM documents, unnest(string_split_regex({TEXT}, '\n[ \t\n\r\x0B\f]*\n')) WITH ORDINALITY AS u(p, pos)
), c AS (SELECT doc_id, paragraph, i, w[i * 96 + 1 : i * 96 + 128] AS c FROM p, unnest(range(0, 1 + greatest(0, ceil((len(w) - 128) / 96.0)::BIGINT))) AS x(i) WHERE len(w) > 0)
SELECT doc_id, paragraph::BIGINT AS paragraph, i::BIGINT AS chunk, len(c)::BIGINT AS n_tokens, sha256(array_to_string(c, ' ')) AS chunk_sha256 FROM c
""")
def chunk_document_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = chunk_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", 128, 32)
    return c.select("doc_id", "paragraph", "chunk", "n_tokens", F.sha2("chunk_text", 256).alias("chunk_sha256"))
