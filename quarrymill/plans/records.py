"""Queries on records that belong together: parents, chunks, segments, versions, merged candidates, gates and inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.functions import selection, text
from quarrymill.functions.canonical import canonical_json
from quarrymill.operators import records
from quarrymill.operators.chunks import chunk_documents
from quarrymill.sources.tables import table

QUERIES, ORACLE_SQL = {}, {}
WS = r"[ \t\n\r\x0B\f]"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


FOLD_SQL = r"lower(trim(regexp_replace(coalesce(text, ''), '[ \t\n\r\x0B\f]+', ' ', 'g')))"


@query(f"""
WITH d AS (SELECT doc_id, source, CASE WHEN {FOLD_SQL} <> '' THEN md5({FOLD_SQL}) END AS k FROM documents), x AS (SELECT k, min(doc_id) AS first, count(*) AS n FROM d WHERE k IS NOT NULL GROUP BY k)
SELECT doc_id, CASE WHEN n > 1 THEN 'exact:' || k ELSE 'doc:' || doc_id::VARCHAR END AS group_key FROM d LEFT JOIN x USING (k)
""")
def split_group_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The family in which a document is split: its exact copies where it has any, else itself."""
    fold = text.folded(F.col("text"))
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(fold != "", F.md5(fold)).alias("k"))
    families = d.where("k is not null").groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k", F.concat(F.lit("exact:"), "k").alias("family"))
    return d.join(families, "k", "left").select("doc_id", F.coalesce("family", F.concat(F.lit("doc:"), F.col("doc_id").cast("string"))).alias("group_key"))


@query(r"""
WITH p AS (SELECT doc_id, u.pos - 1 AS paragraph, regexp_extract_all(u.p, '[^ \t\n\r\x0B\f]+') AS w FROM documents, unnest(string_split_regex(coalesce(text, ''), '\n[ \t\n\r\x0B\f]*\n')) WITH ORDINALITY AS u(p, pos)
), c AS (SELECT doc_id, paragraph, i, len(w[i * 96 + 1 : i * 96 + 128]) AS n FROM p, unnest(range(0, 1 + greatest(0, ceil((len(w) - 128) / 96.0)::BIGINT))) AS x(i) WHERE len(w) > 0)
SELECT d.source, d.lang, count(*)::BIGINT AS n_chunks, sum(n)::BIGINT AS n_tokens, count(l.quality)::BIGINT AS n_labelled FROM c JOIN documents d USING (doc_id) LEFT JOIN labels l USING (doc_id) GROUP BY ALL
""")
def chunk_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks joined with their documents, and these with labels where there are any."""
    d = table(spark, sf_dir, "documents")
    c = chunk_documents(d.select("doc_id", "text"), "doc_id", "text", 128, 32).select("doc_id", "n_tokens")
    parents = d.select("doc_id", "source", "lang").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return c.join(parents, "doc_id").groupBy("source", "lang").agg(F.count("*").alias("n_chunks"), F.sum("n_tokens").alias("n_tokens"), F.count("quality").alias("n_labelled"))


@query("""
WITH m AS (SELECT event_id, CASE WHEN event_type = 'click' THEN user_id END AS parent_id, (json_extract(props, '$.k'))::BIGINT AS k FROM events), a AS (SELECT c_custkey, min(c_custkey) AS v FROM customer WHERE c_custkey IS NOT NULL GROUP BY 1), b AS (SELECT c_nationkey, min(c_custkey) AS v FROM customer WHERE c_nationkey IS NOT NULL GROUP BY 1)
SELECT event_id, coalesce(a.v, b.v) AS parent, CASE WHEN a.v IS NOT NULL THEN 'parent_id' WHEN b.v IS NOT NULL THEN 'k' END AS parent_by FROM m LEFT JOIN a ON a.c_custkey = parent_id LEFT JOIN b ON b.c_nationkey = k
""")
def media_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as media: the parent by its own id where that is known, else by a second key."""
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "click", F.col("user_id")).alias("parent_id"), F.get_json_object("props", "$.k").cast("long").alias("k"))
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("c_nationkey"))
    return records.with_parent(e, c, [("parent_id", "c_custkey"), ("k", "c_nationkey")], "c_custkey").select("event_id", "parent", "parent_by")


@query("""
WITH e AS (SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type || '/' || (json_extract(props, '$.k'))::VARCHAR END AS stable_id FROM events)
SELECT stable_id, min(event_id) AS event_id FROM e WHERE stable_id IS NOT NULL GROUP BY stable_id
""")
def stable_id_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first record of each stable id; records without one are dropped."""
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") != "error", F.concat_ws("/", "event_type", F.get_json_object("props", "$.k"))).alias("stable_id"))
    return records.first_seen(e, "stable_id", "event_id")


SEGMENTS_SQL = """
s AS (SELECT event_id, user_id, event_type AS label, round(epoch_us(ts) / 1000000.0::DOUBLE - 1704067200.0::DOUBLE, 3) AS a, round(epoch_us(ts) / 1000000.0::DOUBLE - 1704067200.0::DOUBLE + value - 5, 3) AS b, value / 10.0::DOUBLE AS confidence FROM events),
clean AS (SELECT * FROM s WHERE trim(label) <> '' AND a >= 0 AND b >= 0 AND b >= a AND confidence >= 0.01 QUALIFY row_number() OVER (PARTITION BY lower(trim(label)), a, b ORDER BY event_id) = 1)"""


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as segments: seconds since the first day, as long as their value less five."""
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000.0 - 1704067200.0
    s = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("event_type").alias("label"), F.round(at, 3).alias("a"), F.round(at + F.col("value") - 5, 3).alias("b"), (F.col("value") / 10.0).alias("confidence"))
    return records.clean_segments(s, "event_id", "a", "b", F.col("label"), F.col("confidence"))


@query(f"WITH {SEGMENTS_SQL} SELECT event_id, a, b FROM clean")
def transcript_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments with sound times and confidence, without repeats."""
    return segments(spark, sf_dir).select("event_id", "a", "b")


@query(f"WITH {SEGMENTS_SQL} SELECT user_id, count(*)::BIGINT AS n_segments, min(a) AS first_start, max(b) AS last_end, round(sum(b - a), 4) AS covered, round(least(1.0::DOUBLE, sum(b - a) / 3600), 4) AS ratio FROM clean GROUP BY user_id")
def timeline_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each user's segments cover of an hour."""
    return records.timeline_summary(segments(spark, sf_dir), "user_id", "a", "b", F.lit(3600.0))


@query(f"""
WITH {SEGMENTS_SQL}, m AS (SELECT *, max(b) OVER (PARTITION BY user_id ORDER BY a, b, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM clean),
r AS (SELECT *, sum(CASE WHEN before IS NULL OR a > before THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY a, b, event_id) AS run FROM m), u AS (SELECT user_id, run, min(a) AS a, max(b) AS b FROM r GROUP BY ALL)
SELECT user_id, count(*)::BIGINT AS n_ranges, round(sum(b - a), 3) AS covered FROM u GROUP BY user_id
""")
def coverage_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's segments as ranges that don't overlap, and the seconds that they cover."""
    r = records.covered_ranges(segments(spark, sf_dir).select("user_id", "a", "b"), "user_id", "a", "b")
    return r.groupBy("user_id").agg(F.count("*").alias("n_ranges"), F.round(F.sum(F.col("b") - F.col("a")), 3).alias("covered"))


@query(f"""
WITH {SEGMENTS_SQL}, p AS (SELECT event_id AS point_id, user_id, round(epoch_us(ts) / 1000000.0::DOUBLE - 1704067200.0::DOUBLE, 3) AS at FROM events WHERE event_type = 'purchase')
SELECT s.event_id, count(*)::BIGINT AS n_points, min(point_id) AS first_point FROM p JOIN clean s ON p.user_id = s.user_id AND p.at BETWEEN s.a AND s.b GROUP BY s.event_id
""")
def keyframes_in_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as keyframes, counted in the segments of their user that hold them, ends included."""
    at = F.round(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000.0 - 1704067200.0, 3)
    p = table(spark, sf_dir, "events").where("event_type = 'purchase'").select(F.col("event_id").alias("point_id"), "user_id", at.alias("at"))
    met = records.points_in_segments(p, segments(spark, sf_dir).select("event_id", "user_id", "a", "b"), "user_id", "at", "a", "b", 3600.0)
    return met.groupBy("event_id").agg(F.count("*").alias("n_points"), F.min("point_id").alias("first_point"))


@query("SELECT user_id, day, t AS starts, lead(t) OVER (PARTITION BY user_id, day ORDER BY t) AS ends FROM (SELECT DISTINCT user_id, ts::DATE AS day, epoch_us(ts) // 3600000000 AS t FROM events)")
def scene_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct hours with events of each user and day; each scene ends where the next starts."""
    t = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000).alias("t")).distinct()
    return t.select("user_id", "day", F.col("t").alias("starts"), F.lead("t").over(Window.partitionBy("user_id", "day").orderBy("t")).alias("ends"))


@query("""
WITH latest AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)
SELECT event_type AS modality, count(*)::BIGINT AS n, count(*) FILTER (WHERE value > 50)::BIGINT AS n_good, round(avg(value), 4) AS mean_quality FROM latest WHERE value > 0 GROUP BY event_type
""")
def modality_counts_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by modality over the latest valid version of each record."""
    latest = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.max_by("value", F.struct("ts", "event_id")).alias("value")).where("value > 0")
    return latest.groupBy(F.col("event_type").alias("modality")).agg(F.count("*").alias("n"), F.count_if(F.col("value") > 50).alias("n_good"), F.round(F.avg("value"), 4).alias("mean_quality"))


RUNS_SQL = "SELECT source, count(*) AS n, avg(l.quality) AS q FROM documents LEFT JOIN labels l USING (doc_id) GROUP BY source"


@query(f"SELECT 'all' AS runs, count(*)::BIGINT AS n_runs, CASE WHEN count(*) FILTER (WHERE q IS NULL OR n <= 0) = 0 THEN round(sum(q * n) / sum(n), 6) END AS quality FROM ({RUNS_SQL}) UNION ALL SELECT 'with_unlabelled', count(*)::BIGINT, CASE WHEN count(*) FILTER (WHERE q IS NULL OR n <= 0) = 0 THEN round(sum(q * n) / sum(n), 6) END FROM (SELECT * FROM ({RUNS_SQL}) UNION ALL SELECT 'none', 5, NULL)")
def run_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean quality of sources as runs, weighted by documents; with one run without evidence there is none."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    runs = d.groupBy("source").agg(F.count("*").alias("n"), F.avg("quality").alias("q"))
    more = runs.union(spark.sql("select 'none' source, 5L n, cast(null as double) q"))
    named = lambda df, name: records.weighted_quality(df, "q", "n").select(F.lit(name).alias("runs"), "n_runs", "quality")
    return named(runs, "all").union(named(more, "with_unlabelled"))


@query("""
SELECT identity, count(*)::BIGINT AS n_merged, arg_min(event_id, (-value, event_id)) AS event_id, arg_min(caption, (-value, event_id)) AS caption, arg_min(alt, (-value, event_id)) AS alt
FROM (SELECT event_id, value, user_id::VARCHAR || '/' || (json_extract(props, '$.k'))::VARCHAR AS identity, CASE WHEN event_type = 'view' THEN 'c' || event_id::VARCHAR END AS caption, CASE WHEN event_type = 'click' THEN 'a' || event_id::VARCHAR END AS alt FROM events) GROUP BY identity
""")
def asset_candidate_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of one identity as one: the preferred one's fields, gaps filled from the next."""
    e = table(spark, sf_dir, "events")
    name = lambda kind, letter: F.when(F.col("event_type") == kind, F.concat(F.lit(letter), F.col("event_id").cast("string")))
    rows = e.select("event_id", "value", F.concat_ws("/", F.col("user_id").cast("string"), F.get_json_object("props", "$.k")).alias("identity"), name("view", "c").alias("caption"), name("click", "a").alias("alt"))
    return records.merged_candidates(rows, "identity", [F.col("value")], "event_id", ["caption", "alt"])


@query("""
WITH c AS (SELECT user_id, event_type, greatest(0, 12 - count(*)) AS a, greatest(0, 20 - count(*) - count(*) FILTER (WHERE value > 50)) AS b FROM events GROUP BY ALL)
SELECT user_id, string_agg(event_type || '=' || greatest(a, b)::VARCHAR, ',' ORDER BY event_type) AS gaps FROM c WHERE greatest(a, b) > 0 GROUP BY user_id
""")
def merged_gap_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two maps of missing counts by kind as one, the larger of each."""
    n, good = F.count("*"), F.count_if(F.col("value") > 50)
    c = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.greatest(F.lit(0), 12 - n).alias("a"), F.greatest(F.lit(0), 20 - n - good).alias("b"))
    maps = c.groupBy("user_id").agg(*[F.map_from_entries(F.collect_list(F.struct("event_type", x))).alias(x) for x in ("a", "b")])
    m = maps.select("user_id", records.merged_gaps(F.col("a"), F.col("b")).alias("m")).where(F.size("m") > 0)
    text_of = F.array_join(F.transform(F.array_sort(F.map_keys("m")), lambda k: F.concat(k, F.lit("="), F.element_at("m", k).cast("string"))), ",")
    return m.select("user_id", text_of.alias("gaps"))


@query("SELECT task, count(*)::BIGINT AS n FROM (SELECT event_type || ':' || (user_id % 7)::VARCHAR AS task FROM events) GROUP BY task HAVING count(*) >= (SELECT count(*) FROM events) / 35.0")
def task_minimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks with an even share of the samples at least; the others are dropped."""
    e = table(spark, sf_dir, "events").select(F.concat(F.col("event_type"), F.lit(":"), (F.col("user_id") % 7).cast("string")).alias("task"))
    least = -(-e.count() // 35)
    return records.at_least(e, "task", least).groupBy("task").agg(F.count("*").alias("n"))


@query("SELECT event_id, '{\"k\":' || (json_extract(props, '$.k'))::VARCHAR || '}' AS canonical, sha256('{\"k\":' || (json_extract(props, '$.k'))::VARCHAR || '}') AS fingerprint FROM events")
def canonical_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties as canonical JSON, and its digest."""
    c = table(spark, sf_dir, "events").select("event_id", canonical_json(F.col("props")).alias("canonical"))
    return c.select("event_id", "canonical", F.sha2("canonical", 256).alias("fingerprint"))


@query("""
WITH have AS (SELECT user_id, list_distinct(list(event_type)) AS kinds FROM events GROUP BY user_id), need AS (SELECT ['click', 'error', 'purchase', 'refund', 'signup', 'view'] AS all_kinds)
SELECT user_id, array_to_string(list_sort(list_filter(all_kinds, lambda x: NOT list_contains(kinds, x))), ',') AS missing, array_to_string(list_sort(list_filter(kinds, lambda x: NOT list_contains(all_kinds, x))), ',') AS unknown FROM have, need
""")
def missing_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each user has of a list of kinds: missing and unknown ones."""
    need = F.array(*[F.lit(x) for x in ("click", "error", "purchase", "refund", "signup", "view")])
    have = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("kinds"))
    joined = lambda c: F.array_join(F.array_sort(c), ",")
    return have.select("user_id", joined(F.array_except(need, "kinds")).alias("missing"), joined(F.array_except("kinds", need)).alias("unknown"))


@query("""
WITH a AS (SELECT 'document' AS modality, doc_id AS id, source AS domain, NULL::VARCHAR AS url FROM documents), b AS (SELECT 'page', page_id, NULL, url FROM pages), c AS (SELECT 'turn', conv_id * 1000 + turn, NULL, NULL FROM conversations)
SELECT modality, count(*)::BIGINT AS n, count(domain)::BIGINT AS n_domain, count(url)::BIGINT AS n_url FROM (FROM a UNION ALL FROM b UNION ALL FROM c) GROUP BY modality
""")
def combined_builders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of several builders as one table; columns that a builder doesn't have are null."""
    a = table(spark, sf_dir, "documents").select(F.lit("document").alias("modality"), F.col("doc_id").alias("id"), F.col("source").alias("domain"))
    b = table(spark, sf_dir, "pages").select(F.lit("page").alias("modality"), F.col("page_id").alias("id"), "url")
    c = table(spark, sf_dir, "conversations").select(F.lit("turn").alias("modality"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"))
    every = a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)
    return every.groupBy("modality").agg(F.count("*").alias("n"), F.count("domain").alias("n_domain"), F.count("url").alias("n_url"))


@query("""
SELECT user_id, count(*)::BIGINT AS n, count(*) FILTER (WHERE event_type = 'view')::BIGINT AS n_caption, count(*) FILTER (WHERE event_type = 'click')::BIGINT AS n_alt, count(*) FILTER (WHERE value > 50)::BIGINT AS n_large, count(*) FILTER (WHERE event_type = 'view' AND value > 50)::BIGINT AS n_caption_large,
  count(*) FILTER (WHERE event_type NOT IN ('view', 'click'))::BIGINT AS n_without_text, round(coalesce(avg(value) FILTER (WHERE event_type = 'view'), 0), 4) AS mean_caption_score, round(count(*) FILTER (WHERE event_type = 'view')::DOUBLE / count(*), 4) AS caption_ratio FROM events GROUP BY user_id
""")
def image_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as images: counts with caption, alt text and size, and the mean score of captions."""
    view, large, alt = F.col("event_type") == "view", F.col("value") > 50, F.col("event_type") == "click"
    return table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count("*").alias("n"), F.count_if(view).alias("n_caption"), F.count_if(alt).alias("n_alt"), F.count_if(large).alias("n_large"), F.count_if(view & large).alias("n_caption_large"), F.count_if(~view & ~alt).alias("n_without_text"),
        F.round(F.coalesce(F.avg(F.when(view, F.col("value"))), F.lit(0.0)), 4).alias("mean_caption_score"), F.round(F.count_if(view) / F.count("*"), 4).alias("caption_ratio"),
    )


@query("""
WITH s AS (SELECT event_id, event_type, value, user_id FROM events), x AS (SELECT event_id, CASE WHEN event_type = 'view' THEN 0.4::DOUBLE ELSE 0 END + CASE WHEN value > 50 THEN 0.35::DOUBLE ELSE 0 END + CASE WHEN user_id % 2 = 0 THEN 0.2::DOUBLE ELSE 0 END + CASE WHEN user_id % 3 = 0 THEN 0.1::DOUBLE ELSE 0 END AS p FROM s)
SELECT round(least(1.0::DOUBLE, p), 4) AS pairability, count(*)::BIGINT AS n FROM x GROUP BY 1
""")
def pairability_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well media go with text, by the evidence that they have."""
    p = selection.pairability(caption=F.col("event_type") == "view", transcript=F.col("value") > 50, surrounding=F.col("user_id") % 2 == 0, parent_text=F.col("user_id") % 3 == 0)
    return table(spark, sf_dir, "events").select(F.round(p, 4).alias("pairability")).groupBy("pairability").agg(F.count("*").alias("n"))


@query("""
SELECT event_id, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, CASE WHEN pair THEN least(1.0::DOUBLE, q, p, c) ELSE greatest(a, q, c) END)), 4) AS alignment
FROM (SELECT event_id, event_type IN ('click', 'view') AS pair, value / 500 AS q, CASE WHEN event_type = 'click' THEN round(user_id / 150.0::DOUBLE, 2) END AS p, CASE WHEN user_id % 5 > 0 THEN (user_id % 5) / 5.0::DOUBLE END AS c, 0.25::DOUBLE AS a FROM events)
""")
def alignment_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weakest score of tasks on pairs, the strongest of others."""
    q = F.col("value") / 500
    p = F.when(F.col("event_type") == "click", F.round(F.col("user_id") / 150.0, 2))
    c = F.when(F.col("user_id") % 5 > 0, (F.col("user_id") % 5) / 5.0)
    score = selection.alignment_score(F.col("event_type").isin("click", "view"), F.lit(0.25), q, p, c)
    return table(spark, sf_dir, "events").select("event_id", F.round(score, 4).alias("alignment"))


@query("""
SELECT event_id, greatest(0, least(100, CASE WHEN event_type = 'signup' THEN 10 ELSE 50 END + (user_id % 6) * 5 - round_even(q * 12, 0) - round_even(g * 6, 0) + round_even((1 - q) * 8, 0) + CASE WHEN g < 0.2 THEN 6 ELSE 0 END))::BIGINT AS priority
FROM (SELECT event_id, event_type, user_id, least(1.0::DOUBLE, value / 100) AS q, (user_id % 10) / 10.0::DOUBLE AS g FROM events)
""")
def task_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priorities of crawl tasks by depth, a host's quality and its gain."""
    q, g = F.least(F.lit(1.0), F.col("value") / 100), (F.col("user_id") % 10) / 10.0
    return table(spark, sf_dir, "events").select("event_id", selection.crawl_priority(F.col("user_id") % 6, F.col("event_type") == "signup", q, g).alias("priority"))


@query("SELECT attempt, count(*)::BIGINT AS n, max(least(60.0::DOUBLE, pow(2.0::DOUBLE, attempt))) AS delay FROM (SELECT (user_id % 9)::BIGINT AS attempt FROM events WHERE event_type = 'error') GROUP BY attempt")
def retry_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds before the next attempt, doubled each time up to a minute."""
    e = table(spark, sf_dir, "events").where("event_type = 'error'").select((F.col("user_id") % 9).alias("attempt"))
    return e.groupBy("attempt").agg(F.count("*").alias("n"), F.max(selection.retry_delay(F.col("attempt"))).alias("delay"))


@query("""
WITH r AS (SELECT event_id, event_type, user_id, value, CASE WHEN value > 150 THEN 'too_long' WHEN value < 1 THEN 'no_change' WHEN event_type = 'error' THEN 'not_applicable' END AS reason, s AS strategy FROM events, unnest(['title_prefix', 'context_prefix', 'span_focus']) AS x(s) WHERE user_id % 10 < 8)
SELECT strategy, event_type AS task, coalesce(CASE WHEN reason IS NULL AND strategy = 'span_focus' AND value < 20 THEN 'too_short' ELSE reason END, 'accepted') AS outcome, count(*)::BIGINT AS n FROM r GROUP BY ALL
""")
def augmentation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows times strategies, with the first reason to reject a variant: counts by strategy, task and outcome."""
    e = table(spark, sf_dir, "events").where("user_id % 10 < 8").select("event_type", "value", F.explode(F.array(*[F.lit(s) for s in ("title_prefix", "context_prefix", "span_focus")])).alias("strategy"))
    reason = F.when(F.col("value") > 150, "too_long").when(F.col("value") < 1, "no_change").when(F.col("event_type") == "error", "not_applicable").when((F.col("strategy") == "span_focus") & (F.col("value") < 20), "too_short")
    return e.groupBy("strategy", F.col("event_type").alias("task"), F.coalesce(reason, F.lit("accepted")).alias("outcome")).agg(F.count("*").alias("n"))


@query("""
WITH t AS (SELECT * FROM (VALUES ('click', 0), ('view', 1), ('purchase', 2)) AS x(task, r)), k AS (SELECT event_type AS task, user_id % 4 AS signature, count(*) AS n FROM events GROUP BY ALL)
SELECT task, signature, n::BIGINT AS n, row_number() OVER (ORDER BY coalesce(r, 3), task, signature)::BIGINT AS place FROM k LEFT JOIN t USING (task)
""")
def curriculum_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches' keys in the order of a schedule of tasks, others by name after them; the keys are as few as tasks and modalities."""
    k = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("task"), (F.col("user_id") % 4).alias("signature")).agg(F.count("*").alias("n"))
    rank = F.when(F.col("task") == "click", 0).when(F.col("task") == "view", 1).when(F.col("task") == "purchase", 2).otherwise(3)
    return k.select("task", "signature", "n", F.row_number().over(Window.orderBy(rank, "task", "signature")).cast("long").alias("place"))


@query("""
SELECT 'documents' AS entity, count(*)::BIGINT AS n, count(DISTINCT doc_id)::BIGINT AS n_ids, count(*) FILTER (WHERE coalesce(trim(text), '') = '')::BIGINT AS n_empty, min(doc_id) AS first_id, max(doc_id) AS last_id FROM documents UNION ALL
SELECT 'pages', count(*), count(DISTINCT page_id), count(*) FILTER (WHERE coalesce(trim(html), '') = ''), min(page_id), max(page_id) FROM pages UNION ALL
SELECT 'conversations', count(*), count(DISTINCT conv_id), count(*) FILTER (WHERE coalesce(trim(text), '') = ''), min(conv_id), max(conv_id) FROM conversations UNION ALL
SELECT 'benchmark', count(*), count(DISTINCT item_id), count(*) FILTER (WHERE coalesce(trim(text), '') = ''), min(item_id), max(item_id) FROM benchmark
""")
def snapshot_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, ids and empty contents of each entity of a snapshot."""
    out = None
    for name, ident, content in (("documents", "doc_id", "text"), ("pages", "page_id", "html"), ("conversations", "conv_id", "text"), ("benchmark", "item_id", "text")):
        empty = F.coalesce(F.trim(content), F.lit("")) == ""
        part = table(spark, sf_dir, name).agg(F.lit(name).alias("entity"), F.count("*").alias("n"), F.count_distinct(ident).alias("n_ids"), F.count_if(empty).alias("n_empty"), F.min(ident).alias("first_id"), F.max(ident).alias("last_id"))
        out = part if out is None else out.union(part)
    return out


@query("""
WITH m AS (SELECT event_type AS task, avg(value) AS mean, count(*) AS n, quantile_cont(value, 0.5) AS p50 FROM events GROUP BY event_type)
SELECT task, n >= 100 AS enough, mean BETWEEN 1 AND 100 AS in_range, p50 <= mean AS skew_ok, n >= 100 AND mean BETWEEN 1 AND 100 AND p50 <= mean AS accepted FROM m
""")
def release_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gates on the measures of each task, and whether all hold."""
    m = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("task")).agg(F.avg("value").alias("mean"), F.count("*").alias("n"), F.percentile("value", F.lit(0.5)).alias("p50"))
    gates = {"enough": F.col("n") >= 100, "in_range": F.col("mean").between(1, 100), "skew_ok": F.col("p50") <= F.col("mean")}
    return m.select("task", *[g.alias(k) for k, g in gates.items()], (gates["enough"] & gates["in_range"] & gates["skew_ok"]).alias("accepted"))


@query("""
SELECT page_id, u.position::INT - 1 AS position, u.kind, u.t AS target FROM (SELECT page_id, list_concat([{'kind': 'page', 't': url}], list_transform(list_filter(links, lambda x, i: list_position(links, x) = i), lambda x: {'kind': 'link', 't': x})) AS rows FROM (SELECT *, regexp_extract_all(html, 'href="([^"]+)"', 1) AS links FROM pages)), unnest(list_transform(range(1, len(rows) + 1), lambda i: {'position': i, 'kind': rows[i].kind, 't': rows[i].t})) AS x(u)
""")
def alignment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that tie a page to itself and to each of its links, in the page's order and without repeats."""
    links = F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), 1))
    row = lambda kind, t: F.struct(F.lit(kind).alias("kind"), t.alias("target"))
    p = table(spark, sf_dir, "pages").select("page_id", F.concat(F.array(row("page", F.col("url"))), F.transform(links, lambda x: row("link", x))).alias("rows"))
    return p.select("page_id", F.posexplode("rows").alias("position", "r")).select("page_id", "position", "r.kind", "r.target")
