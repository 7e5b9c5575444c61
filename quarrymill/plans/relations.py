"""Queries that join, compare and count: leakage, splits, conversations, metrics, coverage, samples, versions of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.functions import text
from quarrymill.operators import coverage, dedup, leakage, metrics, sampling, similar, split
from quarrymill.operators.lineage import Scratch
from quarrymill.sources.tables import table

QUERIES, ORACLE_SQL = {}, {}
FOLD_SQL = r"lower(trim(regexp_replace(coalesce(text, ''), '[ \t\n\r\x0B\f]+', ' ', 'g')))"
WORDS_SQL = r"regexp_extract_all(lower(coalesce(text, '')), '[^ \t\n\r\x0B\f]+')"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


@query(f"""
WITH l AS (SELECT sha256({FOLD_SQL}) AS key, count(*) AS n FROM documents WHERE source IN ('src0', 'src1', 'src2', 'src3') GROUP BY 1), r AS (SELECT sha256({FOLD_SQL}) AS key, count(*) AS n FROM documents WHERE source NOT IN ('src0', 'src1', 'src2', 'src3') GROUP BY 1)
SELECT key, l.n::BIGINT AS n_left, r.n::BIGINT AS n_right, (l.n * r.n)::BIGINT AS n_pairs FROM l JOIN r USING (key)
""")
def exact_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("source", F.sha2(text.folded(F.col("text")), 256).alias("key"))
    left = F.col("source").isin("src0", "src1", "src2", "src3")
    return leakage.exact_leakage(d.where(left), d.where(~left), "key")


@query("""
SELECT source AS side, count(*)::BIGINT AS n_eligible, count(*) FILTER (WHERE n_chars >= 300)::BIGINT AS n_evidence, round(count(*) FILTER (WHERE n_chars >= 300)::DOUBLE / count(*), 6) AS ratio FROM documents GROUP BY source
""")
def leakage_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("side")).agg(F.count("*").alias("n_eligible"), F.count_if(F.col("n_chars") >= 300).alias("n_evidence"))
    return d.withColumn("ratio", F.round(F.col("n_evidence") / F.col("n_eligible"), 6))


def shingles_sql(rel: str, ident: str, where: str = "true") -> str:
    return f"SELECT DISTINCT {ident} AS id, array_to_string(w[i:i+3], ' ') AS s FROM (SELECT {ident}, {WORDS_SQL} AS w FROM {rel} WHERE {where}), unnest(range(1, greatest(len(w) - 2, 2))) AS u(i) WHERE len(w) > 0"


NEAR_SQL = """
WITH a AS ({a}), b AS ({b}), na AS (SELECT id, count(*) AS n FROM a GROUP BY id), nb AS (SELECT id, count(*) AS n FROM b GROUP BY id),
p AS (SELECT a.id AS x, b.id AS y, count(*) AS n FROM a JOIN b USING (s) {on} GROUP BY 1, 2)
SELECT x AS {x}, y AS {y}, p.n::BIGINT AS n_both, round(p.n::DOUBLE / (na.n + nb.n - p.n), 6) AS similarity FROM p JOIN na ON na.id = x JOIN nb ON nb.id = y WHERE p.n::DOUBLE / (na.n + nb.n - p.n) >= {least}
"""


@query(NEAR_SQL.format(a=shingles_sql("benchmark", "item_id"), b=shingles_sql("documents", "doc_id"), on="", x="item_id", y="doc_id", least=0.2))
def near_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items against all documents by shingles of four words, similarity of a fifth or more."""
    left, right = table(spark, sf_dir, "benchmark").select("item_id", "text"), table(spark, sf_dir, "documents").select("doc_id", "text")
    return leakage.near_pairs(left, right, "item_id", "doc_id", "text", 0.2).withColumn("similarity", F.round("similarity", 6))


LONG = "source IN ('src0', 'src1', 'src2', 'src3', 'src4', 'src5', 'src6', 'src7', 'src8', 'src9')"


@query(NEAR_SQL.format(a=shingles_sql("documents", "doc_id", LONG), b=shingles_sql("documents", "doc_id", f"NOT ({LONG})"), on="", x="left_id", y="right_id", least=0.92))
def near_duplicates_between_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the first ten sources against those of the others, by shingles of four words, similar by 0.92 as its SQL has
    it. All pairs of sources, by five words and 0.75, are in near_duplicates_of_all_sources."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", F.expr(LONG).alias("first"))
    left, right = d.where("first").select(F.col("doc_id").alias("left_id"), "text"), d.where("not first").select(F.col("doc_id").alias("right_id"), "text")
    return leakage.near_pairs(left, right, "left_id", "right_id", "text", 0.92).withColumn("similarity", F.round("similarity", 6))


@query()
def near_duplicates_of_all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of equal texts, by their smallest ids, that are similar by 0.75 in shingles of five words, each class with itself
    included, and how many pairs of documents of different sources they stand for; none is made."""
    docs = table(spark, sf_dir, "documents").select(F.struct("doc_id", F.coalesce("source", F.lit("")).alias("source")).alias("id"), "text")
    scratch = Scratch(spark)
    near, (members,) = similar.class_pairs([docs], 0.75, 5, scratch)
    counts = members.where("n > 0").groupBy("k", F.col("id.source").alias("source")).agg(F.count("*").alias("c"), F.min("id.doc_id").alias("id"), F.min("n").alias("n"))
    classes = scratch.keep(counts.groupBy("k").agg(F.min("id").alias("id"), F.min("n").cast("long").alias("n"), F.map_from_entries(F.collect_list(F.struct("source", "c"))).alias("m")))
    side = lambda k, ident, m: classes.select(F.col("k").alias(k), F.col("id").alias(ident), F.col("m").alias(m))
    met = near.join(side("a", "i", "x"), "a").join(side("b", "j", "y"), "b").select(F.least("i", "j").alias("left_id"), F.greatest("i", "j").alias("right_id"), "n_both", "similarity", "x", "y")
    itself = classes.where(F.size("m") > 1).select(F.col("id").alias("left_id"), F.col("id").alias("right_id"), F.col("n").alias("n_both"), F.lit(1.0).alias("similarity"), F.col("m").alias("x"), F.col("m").alias("y"))
    total = lambda c: F.aggregate(F.map_values(c), F.lit(0).cast("long"), lambda a, n: a + n)
    same = F.aggregate(F.map_entries("x"), F.lit(0).cast("long"), lambda a, e: a + e["value"] * F.coalesce(F.try_element_at("y", e["key"]), F.lit(0)))
    pairs = total(F.col("x")) * total(F.col("y")) - same
    n = F.when(F.col("left_id") == F.col("right_id"), (pairs / 2).cast("long")).otherwise(pairs)
    return met.unionAll(itself).select("left_id", "right_id", "n_both", F.round("similarity", 6).alias("similarity"), n.alias("n_pairs")).where("n_pairs > 0")


@query(f"SELECT key AS family, list_aggregate(list_sort(list(DISTINCT split)), 'string_agg', ',') AS splits FROM (SELECT sha256({FOLD_SQL}) AS key, CASE WHEN f < 0.8 THEN 'train' WHEN f < 0.9 THEN 'val' ELSE 'test' END AS split FROM (SELECT text, ('0x' || substr(sha256(doc_id::VARCHAR), 1, 16))::UBIGINT::DOUBLE / 18446744073709551615::DOUBLE AS f FROM documents)) GROUP BY key HAVING count(DISTINCT split) > 1")
def family_cross_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families of equal text that a split by id divides."""
    d = table(spark, sf_dir, "documents").select(F.sha2(text.folded(F.col("text")), 256).alias("family"), split.hash_split(F.col("doc_id").cast("string")).alias("split"))
    return split.crossing_groups(d, "family").select("family", F.array_join("splits", ",").alias("splits"))


@query(f"""
WITH d AS (SELECT sha256({FOLD_SQL}) AS family FROM documents), f AS (SELECT family, count(*) AS n, CASE WHEN x < 0.98 THEN 'train' WHEN x < 0.98::DOUBLE + 0.01::DOUBLE THEN 'val' ELSE 'test' END AS split FROM (SELECT family, ('0x' || substr(sha256(family), 1, 16))::UBIGINT::DOUBLE / 18446744073709551615::DOUBLE AS x FROM d) GROUP BY ALL
), need AS (SELECT greatest(0, 20 - coalesce(sum(n) FILTER (WHERE split = 'val'), 0)) AS val, greatest(0, 20 - coalesce(sum(n) FILTER (WHERE split = 'test'), 0)) AS test FROM f
), given AS (SELECT family, coalesce(sum(n) OVER (ORDER BY n, family ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM f WHERE split = 'train'
), moved AS (SELECT family, CASE WHEN g < val THEN 'val' ELSE 'test' END AS target FROM given, need WHERE g < val + test)
SELECT coalesce(target, split) AS split, sum(n)::BIGINT AS n_docs, count(*)::BIGINT AS n_families FROM f LEFT JOIN moved USING (family) GROUP BY 1
""")
def split_rebalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.folded(F.col("text")), 256).alias("family")).withColumn("split", split.hash_split(F.col("family"), 0.98, 0.01))
    return split.rebalanced(d, "family", "split", 20).groupBy("split").agg(F.count("*").alias("n_docs"), F.countDistinct("family").alias("n_families"))


@query("""
WITH c AS (SELECT conv_id, count(*) AS n, count(DISTINCT turn) AS d, max(turn) AS last, arg_max(role, turn) AS last_role, arg_min(role, turn) AS first_role FROM conversations GROUP BY conv_id)
SELECT conv_id, n::BIGINT AS n_turns, n = d AS unique_turns, last_role = 'assistant' AS ends_with_answer, n = d AND last_role = 'assistant' AND first_role <> 'assistant' AS valid FROM c
""")
def conversation_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.countDistinct("turn").alias("d"), F.max_by("role", "turn").alias("last"), F.min_by("role", "turn").alias("first"))
    unique, answer = F.col("n_turns") == F.col("d"), F.col("last") == "assistant"
    return c.select("conv_id", "n_turns", unique.alias("unique_turns"), answer.alias("ends_with_answer"), (unique & answer & (F.col("first") != "assistant")).alias("valid"))


@query("""
WITH t AS (SELECT *, max(CASE WHEN role = 'assistant' THEN turn END) OVER (PARTITION BY conv_id) AS target FROM conversations)
SELECT conv_id, any_value(target)::BIGINT AS target_turn, sha256(string_agg('<' || role || '>' || chr(10) || text, chr(10) ORDER BY turn) FILTER (WHERE turn < target)) AS prompt_sha256, sha256(max(text) FILTER (WHERE turn = target)) AS answer_sha256
FROM t WHERE target IS NOT NULL GROUP BY conv_id HAVING count(*) FILTER (WHERE turn < target) > 0
""")
def conversation_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns before the last answer as one prompt, and the answer."""
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"), F.max(F.when(F.col("role") == "assistant", F.col("turn"))).alias("target_turn")).where("target_turn is not null")
    before = F.filter("t", lambda x: x["turn"] < F.col("target_turn"))
    prompt = F.array_join(F.transform(before, lambda x: F.concat(F.lit("<"), x["role"], F.lit(">\n"), x["text"])), "\n")
    answer = F.filter("t", lambda x: x["turn"] == F.col("target_turn"))[0]["text"]
    return c.where(F.size(before) > 0).select("conv_id", "target_turn", F.sha2(prompt, 256).alias("prompt_sha256"), F.sha2(answer, 256).alias("answer_sha256"))


@query("""
WITH q AS (SELECT * FROM embeddings WHERE vec_id % 20 = 0), s AS (
  SELECT q.vec_id, q.label = e.label AS same, round(list_dot_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 6) AS s FROM q JOIN embeddings e ON q.vec_id <> e.vec_id
), b AS (SELECT vec_id, max(s) FILTER (WHERE same) AS best_same, max(s) FILTER (WHERE NOT same) AS best_other FROM s GROUP BY vec_id)
SELECT vec_id, round(best_same, 4) AS best_same, round(best_other, 4) AS best_other, coalesce(best_same >= best_other, false) AS hit FROM b
""")
def retrieval_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries, every 20th vector, against all vectors: whether the nearest other one has the query's label."""
    e = table(spark, sf_dir, "embeddings")
    best = metrics.retrieval_best(e.where("vec_id % 20 = 0"), e, "vec_id", "embedding", "label")
    return best.select("vec_id", F.round("best_same", 4).alias("best_same"), F.round("best_other", 4).alias("best_other"), F.coalesce(F.col("best_same") >= F.col("best_other"), F.lit(False)).alias("hit"))


@query("""
SELECT a.conv_id, a.turn, round(CASE WHEN len(x) = 0 AND len(y) = 0 THEN 1.0::DOUBLE WHEN c = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * c / (len(x) + len(y)) END, 6) AS token_f1 FROM (
  SELECT a.conv_id, a.turn, a.w AS x, b.w AS y, coalesce(list_sum(list_transform(list_distinct(a.w), lambda t: least(len(list_filter(a.w, lambda z: z = t)), len(list_filter(b.w, lambda z: z = t))))), 0) AS c
  FROM (SELECT conv_id, turn, %s AS w FROM conversations) a JOIN (SELECT conv_id, turn, %s AS w FROM conversations) b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1) a
""" % (WORDS_SQL, WORDS_SQL))
def token_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn against the next one of its conversation."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", text.space_tokens(F.lower(F.coalesce("text", F.lit("")))).alias("w"))
    after = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("w").alias("v"))
    return c.join(after, ["conv_id", "turn"]).select("conv_id", "turn", F.round(metrics.token_f1(F.col("w"), F.col("v")), 6).alias("token_f1"))


ASCII = r"regexp_replace(lower(coalesce(text, '')), '[^a-z ]', '', 'g')"


@query(f"""
WITH t AS (SELECT conv_id, turn, {ASCII} AS t FROM conversations)
SELECT sum(levenshtein(a.t, b.t))::BIGINT AS edits, sum(greatest(length(b.t), 1))::BIGINT AS length, round(sum(levenshtein(a.t, b.t))::DOUBLE / sum(greatest(length(b.t), 1)), 6) AS rate FROM t a JOIN t b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
""")
def character_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each whole turn's plain letters against the next one's; DuckDB compares bytes, so other letters are only in text_error_rates."""
    t = F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[^a-z ]", "")
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", t.alias("t"))
    after = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("t").alias("v"))
    rate = metrics.error_rate(c.join(after, ["conv_id", "turn"]), F.levenshtein("t", "v"), F.length("v"))
    return rate.withColumn("rate", F.round("rate", 6))


@query()
def text_error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each whole turn against the next one: edits of characters and of words, by the lengths of the next ones."""
    t = F.coalesce("text", F.lit(""))
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", t.alias("t"))
    after = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("t").alias("v"))
    pairs = c.join(after, ["conv_id", "turn"]).select("t", "v", text.space_tokens(F.col("t")).alias("a"), text.space_tokens(F.col("v")).alias("b"))
    rates = []
    for unit, edits, length in (("character", F.levenshtein("t", "v"), F.length("v")), ("word", metrics.word_edits(F.col("a"), F.col("b")), F.size("b"))):
        rates.append(metrics.error_rate(pairs, edits, length).select(F.lit(unit).alias("unit"), "edits", "length", F.round("rate", 6).alias("rate")))
    return rates[0].unionByName(rates[1])


@query("""
WITH c AS (SELECT source, count(*) FILTER (WHERE quality = 1)::DOUBLE AS k, count(*)::DOUBLE AS n FROM documents JOIN labels USING (doc_id) GROUP BY source)
SELECT source, k::BIGINT AS n_good, n::BIGINT AS n_labelled, round(greatest(0, (k / n + 3.8416 / (2 * n)) / (1 + 3.8416 / n) - 1.96 * sqrt(k / n * (1 - k / n) / n + 3.8416 / (4 * n * n)) / (1 + 3.8416 / n)), 6) AS low,
  round(least(1, (k / n + 3.8416 / (2 * n)) / (1 + 3.8416 / n) + 1.96 * sqrt(k / n * (1 - k / n) / n + 3.8416 / (4 * n * n)) / (1 + 3.8416 / n)), 6) AS high FROM c
""")
def wilson_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of good documents of each source, with its score interval."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id")
    c = d.groupBy("source").agg(F.count_if(F.col("quality") == 1).alias("n_good"), F.count("*").alias("n_labelled"))
    w = metrics.wilson(F.col("n_good").cast("double"), F.col("n_labelled").cast("double"))
    return c.select("source", "n_good", "n_labelled", F.round(w["low"], 6).alias("low"), F.round(w["high"], 6).alias("high"))


@query("SELECT event_type, count(*)::BIGINT AS n, round(max(value) - min(value), 6) AS spread, round(avg(value), 6) AS mean, count(DISTINCT user_id)::BIGINT AS n_users, count(*) > count(DISTINCT user_id) AS repeated FROM events GROUP BY event_type")
def reproducibility_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.max("value") - F.min("value"), 6).alias("spread"), F.round(F.avg("value"), 6).alias("mean"), F.countDistinct("user_id").alias("n_users"))
    return e.withColumn("repeated", F.col("n") > F.col("n_users"))


@query("SELECT 'labels' AS child, count(*)::BIGINT AS n_orphans FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents) UNION ALL SELECT 'lineitem', count(*)::BIGINT FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def orphan_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = coverage.orphans(table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"), "doc_id", "doc_id").agg(F.count("*").alias("n_orphans"))
    b = coverage.orphans(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"), "l_orderkey", "o_orderkey").agg(F.count("*").alias("n_orphans"))
    return a.withColumn("child", F.lit("labels")).unionByName(b.withColumn("child", F.lit("lineitem")))


@query("SELECT l_orderkey, l_partkey, count(*)::BIGINT AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.duplicate_ids(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")


@query("WITH m(lang, minimum) AS (VALUES ('en', 500), ('de', 100), ('it', 10)), c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang) SELECT m.lang, minimum::BIGINT AS minimum, coalesce(n, 0)::BIGINT AS n, greatest(0, minimum - coalesce(n, 0))::BIGINT AS missing, CASE WHEN minimum > coalesce(n, 0) THEN 'below_minimum:' || m.lang ELSE 'ok' END AS code FROM m LEFT JOIN c USING (lang)")
def coverage_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = spark.createDataFrame([("en", 500), ("de", 100), ("it", 10)], "lang string, minimum long")
    counts = table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    return coverage.limit_gaps(counts, limits, "lang")


@query("SELECT lang, source, count(*)::BIGINT AS n_docs, sum(n_chars)::BIGINT AS n_chars, count(quality)::BIGINT AS n_labelled FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang, source")
def dataset_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.groupBy("lang", "source").agg(F.count("*").alias("n_docs"), F.sum("n_chars").alias("n_chars"), F.count("quality").alias("n_labelled"))


@query("SELECT doc_id, round(CASE WHEN lang = 'en' THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END / count(*) OVER (PARTITION BY lang, source), 9) AS weight FROM documents")
def weighted_sampling_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return sampling.sample_weights(d, "lang", "source", F.when(F.col("lang") == "en", 1.0).otherwise(2.0)).select("doc_id", F.round("weight", 9).alias("weight"))


@query("SELECT lang, source, batch, count(*)::BIGINT AS n, min(doc_id) AS first_id FROM (SELECT *, ((row_number() OVER (PARTITION BY lang, source ORDER BY n_chars, doc_id) - 1) // 8)::BIGINT AS batch FROM documents) GROUP BY ALL")
def modality_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    b = sampling.batches(d, ["lang", "source"], [F.col("n_chars"), F.col("doc_id")], 8)
    return b.groupBy("lang", "source", "batch").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


@query("SELECT worker, count(*)::BIGINT AS n, sum(doc_id)::BIGINT AS id_sum FROM (SELECT doc_id, (('0x' || substr(sha256(doc_id::VARCHAR), 1, 8))::BIGINT % 7)::INT AS worker FROM documents) GROUP BY worker")
def rank_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", sampling.worker_share(F.col("doc_id"), 7).alias("worker"))
    return d.groupBy("worker").agg(F.count("*").alias("n"), F.sum("doc_id").alias("id_sum"))


STRATEGIES = ("text_span_focus", "title_prefix", "context_prefix")


@query("WITH p AS (SELECT doc_id, (('0x' || substr(sha256(doc_id::VARCHAR), 1, 8))::BIGINT % 3)::INT AS o FROM documents) SELECT doc_id, k::INT AS position, ['text_span_focus', 'title_prefix', 'context_prefix'][(o + k) % 3 + 1] AS strategy FROM p, range(0, 2) AS r(k)")
def augment_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two strategies for each document, from a rotation by its id's hash."""
    o = F.pmod(F.conv(F.substring(F.sha2(F.col("doc_id").cast("string"), 256), 1, 8), 16, 10).cast("long"), F.lit(3)).cast("int")
    names = F.array(*[F.lit(s) for s in STRATEGIES])
    plan = F.transform(F.sequence(F.lit(0), F.lit(1)), lambda k: F.get(names, F.pmod(o + k, F.lit(3))))
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(plan).alias("position", "strategy"))


@query(r"""
WITH v AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[^ \t\n\r\x0B\f]+')) AS a, list_distinct(regexp_extract_all(lower('Title: ' || source || chr(10) || coalesce(text, '')), '[^ \t\n\r\x0B\f]+')) AS b FROM documents)
SELECT doc_id, round(len(list_intersect(a, b))::DOUBLE / (len(a) + len(b) - len(list_intersect(a, b))), 6) AS overlap, (len(b) - len(a))::BIGINT AS new_tokens FROM v
""")
def variant_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlap of each text and its variant with a title."""
    t = F.coalesce("text", F.lit(""))
    words = lambda x: F.array_distinct(text.space_tokens(F.lower(x)))
    d = table(spark, sf_dir, "documents").select("doc_id", words(t).alias("a"), words(F.concat(F.lit("Title: "), F.col("source"), F.lit("\n"), t)).alias("b"))
    return d.select("doc_id", F.round(text.jaccard(F.col("a"), F.col("b")), 6).alias("overlap"), (F.size("b") - F.size("a")).cast("long").alias("new_tokens"))


@query("""
WITH e AS (SELECT *, lag(event_type) OVER w AS before, row_number() OVER w AS rn FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
), d AS (SELECT *, CASE WHEN rn = 1 THEN 'insert' WHEN before = event_type THEN 'duplicate' ELSE 'update' END AS decision FROM e)
SELECT decision, count(*)::BIGINT AS n, count(DISTINCT user_id)::BIGINT AS n_users FROM d GROUP BY decision
""")
def record_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records of their user: insert, update or duplicate."""
    v = dedup.record_versions(table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"], "event_type")
    return v.groupBy("decision").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("n_users"))


@query("SELECT user_id, event_id, event_type, round(value, 6) AS value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return dedup.latest(e, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", F.round("value", 6).alias("value"))


@query("""
WITH m AS (SELECT *, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS starts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), r AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM m)
SELECT user_id, run::BIGINT AS run, any_value(event_type) AS event_type, count(*)::BIGINT AS n, min(event_id) AS first_event FROM r GROUP BY user_id, run
""")
def activity_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of equal event types of each user."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    r = e.withColumn("starts", F.when(F.lag("event_type").over(w) == F.col("event_type"), 0).otherwise(1)).withColumn("run", F.sum("starts").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return r.groupBy("user_id", "run").agg(F.first("event_type").alias("event_type"), F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query("SELECT user_id, event_id FROM (SELECT *, lag(value) OVER w AS a, lag(value, 2) OVER w AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE value > a AND a > b")
def rising_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third of three rising values in a row."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").withColumn("a", F.lag("value").over(w)).withColumn("b", F.lag("value", 2).over(w))
    return e.where("value > a and a > b").select("user_id", "event_id")


@query("SELECT event_id, turn FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id)::BIGINT AS turn FROM events)")
def fair_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turn in which each host's (user's) task is served: its rank by priority."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return e.select("event_id", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id")).cast("long").alias("turn"))


@query("SELECT user_id, event_type, count(*)::BIGINT AS n_kept FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS before FROM events) WHERE before IS NULL OR ts > before + INTERVAL 1 HOUR GROUP BY ALL")
def seen_dedup_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that were not seen in the hour before, seeing again counts anew."""
    w = Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").withColumn("before", F.lag("ts").over(w)).where("before is null or ts > before + interval 1 hour")
    return e.groupBy("user_id", "event_type").agg(F.count("*").alias("n_kept"))


@query("""
WITH s AS (SELECT event_id, user_id, epoch_us(ts) AS a, epoch_us(ts) + (value * 60000000)::BIGINT AS b, event_type FROM events)
SELECT x.user_id, count(*)::BIGINT AS n_overlaps FROM s x JOIN s y ON x.user_id = y.user_id AND x.event_type = 'click' AND y.event_type <> 'click' AND x.a < y.b AND y.a < x.b GROUP BY x.user_id
""")
def segment_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of one user's overlapping intervals, clicks with others; each lasts as many minutes as its value.

    Intervals meet by user and hour, and a pair counts in the hour in which the later one begins, so that a busy user is spread.
    """
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    e = table(spark, sf_dir, "events").select("user_id", "event_type", start.alias("a"), (start + F.round(F.col("value") * 60_000_000).cast("long")).alias("b"))
    hour = F.lit(3_600_000_000)
    e = e.withColumn("hour", F.explode(F.sequence(F.floor(F.col("a") / hour), F.greatest(F.floor(F.col("a") / hour), F.floor(F.col("b") / hour)))))
    x = e.where("event_type = 'click'").select("user_id", "hour", F.col("a").alias("xa"), F.col("b").alias("xb"))
    met = x.join(e.where("event_type <> 'click'"), ["user_id", "hour"]).where((F.col("xa") < F.col("b")) & (F.col("a") < F.col("xb")) & (F.floor(F.greatest("xa", "a") / hour) == F.col("hour")))
    return met.groupBy("user_id").agg(F.count("*").alias("n_overlaps"))


@query("""
WITH l AS (SELECT l_returnflag, l_linestatus, sum(l_quantity) AS q, sum(l_extendedprice * (1 - l_discount)) AS r, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL)
SELECT l_returnflag, l_linestatus, round(q, 2) AS sum_qty, round(r, 2) AS revenue, n::BIGINT AS n FROM l
""")
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").where("l_shipdate <= timestamp '1998-09-02'")
    return l.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@query("""
SELECT n_name, r_name, count(*)::BIGINT AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL
""")
def orders_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are summed by customer before the join; nation and region have fixed sizes."""
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("t"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    return o.join(c, "o_custkey").join(F.broadcast(n), "c_nationkey").groupBy("n_name", "r_name").agg(F.sum("n").alias("n_orders"), F.round(F.sum("t"), 2).alias("total"))
