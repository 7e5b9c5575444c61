"""Queries on the wording of texts and pages: headings, evidence, variants, captions, links, fingerprints, and word metrics of turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.functions import selection, text, unicode, url, wording
from quarrymill.operators import metrics
from quarrymill.plans.texts import NORMAL_SQL
from quarrymill.sources.tables import table

QUERIES, ORACLE_SQL = {}, {}
TEXT = "coalesce(text, '')"
LINE_SQL = r"trim(regexp_replace(coalesce(text, ''), '[ \t\n\r\x0B\f]+', ' ', 'g'))"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")


@query(rf"SELECT doc_id, sha256(nullif({LINE_SQL}, '')) AS line_sha256, len(regexp_extract_all({TEXT}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_ \t\n\x0B\f\r]'))::BIGINT AS n_estimated FROM documents")
def training_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts on one line, and an estimate of their tokens."""
    return documents(spark, sf_dir).select("doc_id", F.sha2(wording.single_line(F.col("text")), 256).alias("line_sha256"), wording.token_estimate(F.col("text")).cast("long").alias("n_estimated"))


@query(f"SELECT doc_id, sha256({NORMAL_SQL}) AS normal_sha256 FROM documents")
def normalize_compatibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normal texts after Unicode's compatibility form; the tables have composed letters only, so that SQL without it agrees."""
    return documents(spark, sf_dir).select("doc_id", F.sha2(text.normalize_text(unicode.nfkc(F.col("text"))), 256).alias("normal_sha256"))


@query(f"SELECT item_id, CASE WHEN text IS NOT NULL THEN sha256(replace(lower(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), 'ß', 'ss')) END AS digest FROM benchmark")
def value_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests under which values can be compared without being read."""
    return table(spark, sf_dir, "benchmark").select("item_id", unicode.value_digest(F.col("text")).alias("digest"))


HEADING_SQL = rf"substr(rtrim(regexp_extract({TEXT}, '^(?:[ \t\r]*#*[ \t\r]*\n)*[ \t\r]*#*[ \t\r]*([^\n]*)', 1)), 1, 160)"


@query(f"SELECT doc_id, nullif({HEADING_SQL}, '') AS heading, ((length({TEXT}) - length(replace({TEXT}, '```', ''))) // 6)::BIGINT AS n_code_blocks FROM documents")
def first_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", wording.first_heading(F.col("text")).alias("heading"), wording.code_blocks(F.col("text")).cast("long").alias("n_code_blocks"))


PAGE_TEXT_SQL = r"regexp_replace(regexp_replace(coalesce(html, ''), '(?s)<(?:script|style|title)[^>]*>.*?</(?:script|style|title)>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g')"
PAGE_TEXT = r"(?s)<(?:script|style|title)[^>]*>.*?</(?:script|style|title)>|<!--.*?-->"


@query(f"""
WITH p AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, {PAGE_TEXT_SQL} AS t FROM pages)
SELECT page_id, title, CASE WHEN strpos(t, title) > 0 THEN strpos(t, title) - 1 WHEN strpos(lower(t), lower(title)) > 0 THEN strpos(lower(t), lower(title)) - 1 END::BIGINT AS evidence_start FROM p WHERE title <> ''
""")
def title_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a page's text has its title: the evidence of a question about the title."""
    plain = F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), PAGE_TEXT, " "), "<[^>]*>", " ")
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), plain.alias("t")).where("title <> ''")
    return p.select("page_id", "title", wording.located(F.col("t"), F.col("title")).cast("long").alias("evidence_start"))


@query(f"""
WITH v AS (SELECT doc_id, 'title_prefix' AS strategy, CASE WHEN {TEXT} <> '' AND NOT starts_with(lower({TEXT}), lower(source)) THEN source || chr(10) || chr(10) || text END AS variant FROM documents
UNION ALL SELECT doc_id, 'context_prefix', CASE WHEN {TEXT} <> '' AND NOT starts_with(lower({TEXT}), lower('Domain: ' || source)) THEN 'Domain: ' || source || chr(10) || chr(10) || text END FROM documents)
SELECT doc_id, strategy, sha256(variant) AS variant_sha256, length(variant)::BIGINT AS n_chars FROM v WHERE variant IS NOT NULL
""")
def text_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants with a title or a context in front, where the text doesn't begin so already."""
    d = documents(spark, sf_dir).where(F.coalesce("text", F.lit("")) != "")
    prefixes = {"title_prefix": F.col("source"), "context_prefix": F.concat(F.lit("Domain: "), "source")}
    v = d.select("doc_id", F.explode(F.array(*[F.struct(F.lit(k).alias("strategy"), F.when(~F.startswith(F.lower("text"), F.lower(p)), F.concat(p, F.lit("\n\n"), "text")).alias("variant")) for k, p in prefixes.items()])).alias("v"))
    return v.where("v.variant is not null").select("doc_id", "v.strategy", F.sha2("v.variant", 256).alias("variant_sha256"), F.length("v.variant").cast("long").alias("n_chars"))


LAST_SQL = "CASE WHEN strpos(reverse(c), '{r}') > 0 THEN length(c) - strpos(reverse(c), '{r}') - {n} + 1 ELSE -1 END"
ENDS_SQL = ", ".join(f"CASE WHEN ({LAST_SQL.format(r=m[::-1], n=len(m))}) >= low THEN ({LAST_SQL.format(r=m[::-1], n=len(m))}) + {len(m.rstrip())} END" for m in wording.BOUNDARIES)


@query(rf"""
WITH a AS (SELECT doc_id, text, regexp_replace(substr(text, 1, 400), '[ \t\n\r\x0B\f]+$', '') AS c FROM documents WHERE text IS NOT NULL), b AS (SELECT *, greatest(1, least(length(c) - 1, 200)) AS low FROM a), e AS (SELECT *, coalesce({ENDS_SQL}, length(c)) AS fin FROM b)
SELECT doc_id, CASE WHEN length(text) <= 400 THEN text ELSE regexp_replace(substr(c, 1, fin), '[ \t\n\r\x0B\f]+$', '') END AS excerpt FROM e
""")
def natural_excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 400 characters, up to a natural boundary: an excerpt is what is asked for."""
    return documents(spark, sf_dir).where("text is not null").select("doc_id", wording.truncated(F.col("text"), 400).alias("excerpt"))


@query(rf"SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '([\p{{L}}\p{{N}}_])-[ \t\r\f\x0B]*\n[ \t\n\r\f\x0B]*([\p{{L}}\p{{N}}_])', '\1\2', 'g'), '[ \t]+', ' ', 'g'), ' *\n *', chr(10), 'g'), '^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$', '', 'g')) AS scan_sha256 FROM documents")
def scanned_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as of a scan: hyphens at line ends, ligatures and spaces mended."""
    return documents(spark, sf_dir).select("doc_id", F.sha2(wording.joined_hyphens(F.col("text")), 256).alias("scan_sha256"))


@query("""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^ \\t\\n\\r\\x0B\\f]+') AS w FROM documents), s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 2, 2)), lambda i: ('0x' || substr(md5(array_to_string(w[i:i+3], ' ')), 1, 15))::BIGINT))) END AS h FROM w)
SELECT doc_id, len(h)::BIGINT AS n_shingles, array_to_string(list_transform(range(0, least(4, len(h))), lambda b: h[least(len(h) - 1, (b * len(h)) // greatest(1, least(4, len(h)))) + 1]::VARCHAR), ',') AS signals FROM s
""")
def band_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four order statistics of a text's hashed runs of four words: what near copies are likely to share."""
    w = documents(spark, sf_dir).select("doc_id", text.space_tokens(F.lower(F.coalesce("text", F.lit("")))).alias("w"))
    h = w.select("doc_id", F.array_distinct(F.transform(text.shingles("w", 4), wording.short_hash)).alias("h"))
    return h.select("doc_id", F.size("h").cast("long").alias("n_shingles"), F.array_join(F.transform(wording.band_signals(F.col("h")), lambda x: x.cast("string")), ",").alias("signals"))


@query(rf"WITH p AS (SELECT doc_id, string_split_regex({TEXT}, '\n[ \t\n\r\x0B\f]*\n') AS p FROM documents) SELECT doc_id, len(p)::BIGINT AS n_spans, sha256(array_to_string(list_transform(p, lambda x, i: (i - 1)::VARCHAR || ':' || length(x)::VARCHAR), '|')) AS layout FROM p")
def layout_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of the paragraphs' places and lengths."""
    p = documents(spark, sf_dir).select("doc_id", F.split(F.coalesce("text", F.lit("")), r"\n[ \t\n\r\x0B\f]*\n").alias("p"))
    return p.select("doc_id", F.size("p").cast("long").alias("n_spans"), wording.layout_hash(F.col("p")).alias("layout"))


CAPTIONS_SQL = "SELECT page_id * 3 AS id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS c FROM pages UNION ALL SELECT page_id * 3 + 1, substr(html, strpos(html, '<article>') + 9, 60) FROM pages UNION ALL SELECT page_id * 3 + 2, 'href ' || url || ' photo by class' FROM pages"


@query(rf"""
WITH c AS (SELECT id, lower(trim(regexp_replace(coalesce(c, ''), '[ \t\n\r\x0B\f]+', ' ', 'g'))) AS t FROM ({CAPTIONS_SQL}))
SELECT id, t <> '' AND ({" OR ".join(f"contains(t, '{m}')" for m in selection.CAPTION_MARKERS)} OR len(regexp_extract_all(t, '[<>]')) >= 2
  OR len(list_filter(string_split(t, ' '), lambda w: starts_with(w, '<') OR ends_with(w, '>') OR contains(w, '=') OR w IN ('href', 'src', 'rel', 'class', 'type')))::DOUBLE / len(string_split(t, ' ')) >= 0.25) AS garbage FROM c
""")
def caption_garbage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles, beginnings of articles and link remains as captions: which are markup."""
    p = table(spark, sf_dir, "pages")
    article = F.substr("html", F.instr("html", "<article>") + 9, F.lit(60))
    parts = [F.regexp_extract("html", "<title>([^<]*)</title>", 1), article, F.concat(F.lit("href "), "url", F.lit(" photo by class"))]
    c = p.select(F.explode(F.array(*[F.struct((F.col("page_id") * 3 + i).alias("id"), x.alias("c")) for i, x in enumerate(parts)])).alias("e"))
    return c.select("e.id", selection.caption_garbage(F.col("e.c")).alias("garbage"))


@query("""
SELECT page_id, len(regexp_extract_all(html, '<h[1-6][^>]*>'))::BIGINT AS n_headings, regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1) AS heading, len(regexp_extract_all(html, '<a\\s'))::BIGINT AS n_links, len(regexp_extract_all(html, '<p>'))::BIGINT AS n_paragraphs,
  len(regexp_extract_all(html, '<img\\s'))::BIGINT AS n_images, len(regexp_extract_all(html, '<script[^>]*>'))::BIGINT AS n_scripts, regexp_extract(html, '<html[^>]*\\slang="([^"]*)"', 1) AS lang FROM pages
""")
def page_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a page's elements, its first heading and language."""
    n = lambda p: F.regexp_count("html", F.lit(p)).cast("long")
    return table(spark, sf_dir, "pages").select(
        "page_id", n("<h[1-6][^>]*>").alias("n_headings"), F.regexp_extract("html", "<h1[^>]*>([^<]*)</h1>", 1).alias("heading"), n(r"<a\s").alias("n_links"), n("<p>").alias("n_paragraphs"),
        n(r"<img\s").alias("n_images"), n("<script[^>]*>").alias("n_scripts"), F.regexp_extract("html", r'<html[^>]*\slang="([^"]*)"', 1).alias("lang"),
    )


@query("""
SELECT DISTINCT page_id, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) || '://' || lower(regexp_extract(url, '^[^:]*://([^/?#]*)', 1)) || h AS target FROM (SELECT page_id, url, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS h FROM pages)
""")
def resolved_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links as whole URLs; here all are paths from the root (other forms are in the tests)."""
    p = table(spark, sf_dir, "pages").select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), 1)).alias("h"))
    return p.select("page_id", url.resolved(F.col("url"), F.col("h")).alias("target")).where("target is not null").distinct()


@query("""
WITH q AS (SELECT page_id, url, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) AS scheme, lower(regexp_extract(url, '^[^:]*://([^/?#]*)', 1)) AS host, regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1) AS path, list_sort(list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT starts_with(lower(p), 'utm_') AND NOT lower(split_part(p, '=', 1)) IN ('fbclid', 'gclid', 'msclkid'))) AS q FROM pages)
SELECT page_id, lower(scheme) || '://' || host || path || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS identity FROM q
""")
def asset_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of one asset as one: without fragment and tracking, parameters in order."""
    return table(spark, sf_dir, "pages").select("page_id", url.asset_identity(F.col("url")).alias("identity"))


@query("""
WITH p AS (SELECT page_id, lower(regexp_extract(url, '^[^:]*://([^/?#:]*)', 1)) AS host FROM pages), deny AS (SELECT DISTINCT host FROM p WHERE contains(host, 'spam'))
SELECT page_id, host FROM p ANTI JOIN deny USING (host)
""")
def blacklist_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of hosts that are not on the blacklist (hosts that say spam)."""
    p = table(spark, sf_dir, "pages").select("page_id", url.host(F.col("url")).alias("host"))
    return p.join(p.where(F.col("host").contains("spam")).select("host").distinct(), "host", "left_anti").select("page_id", "host")


@query("""
WITH l AS (SELECT page_id, h, row_number() OVER (PARTITION BY page_id ORDER BY length(h) DESC, h) AS rk FROM (SELECT DISTINCT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS h FROM pages))
SELECT page_id, rk::BIGINT AS rank, h AS target FROM l WHERE rk <= 3
""")
def discovery_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best links of each page by score (here their length), ties by identity."""
    p = table(spark, sf_dir, "pages").select("page_id", F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), 1)).alias("h"))
    ranked = F.slice(F.array_sort(F.transform("h", lambda x: F.struct((-F.length(x)).alias("s"), x.alias("t")))), 1, 3)
    return p.select("page_id", F.posexplode(ranked).alias("at", "e")).select("page_id", (F.col("at") + 1).cast("long").alias("rank"), F.col("e.t").alias("target"))


@query("""
SELECT page_id, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.5::DOUBLE + 0.1 + CASE c WHEN 'documentation' THEN 0.2 WHEN 'academic' THEN 0.25 WHEN 'media' THEN 0.1 WHEN 'boilerplate' THEN -0.3 ELSE 0 END - CASE WHEN n < 512 THEN 0.2 ELSE 0 END + CASE WHEN n > 20000 THEN 0.05 ELSE 0 END)), 3) AS relevance
FROM (SELECT page_id, strlen(html) AS n, CASE WHEN url LIKE '%/en/%' THEN 'documentation' WHEN url LIKE '%/fr/%' THEN 'academic' WHEN url LIKE '%/de/%' THEN 'media' ELSE 'boilerplate' END AS c FROM pages)
""")
def relevance_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relevance of pages by category (here of their path) and size."""
    u = F.col("url")
    c = F.when(u.contains("/en/"), "documentation").when(u.contains("/fr/"), "academic").when(u.contains("/de/"), "media").otherwise("boilerplate")
    return table(spark, sf_dir, "pages").select("page_id", selection.relevance(F.lit(True), c, F.octet_length("html")).alias("relevance"))


PAIRS_SQL = r"pairs AS (SELECT conv_id, turn, regexp_extract_all(lower(coalesce(text, '')), '[^ \t\n\r\x0B\f]+') AS t, regexp_extract_all(lower(coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn, text), '')), '[^ \t\n\r\x0B\f]+') AS p FROM conversations)"


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn's words as a target, those of the turn before as a prediction."""
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn", "text"))
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", before.alias("before"))
    words = lambda x: text.space_tokens(F.lower(F.coalesce(x, F.lit(""))))
    return c.select("conv_id", "turn", words(F.col("text")).alias("t"), words(F.col("before")).alias("p"))


@query(f"WITH {PAIRS_SQL} SELECT conv_id, count(*)::BIGINT AS n, round(avg((t = p)::INT), 6) AS exact_match, coalesce(round(sum(len(list_filter(range(1, least(len(t), len(p)) + 1), lambda i: t[i] = p[i])))::DOUBLE / nullif(sum(len(t)), 0), 6), 0) AS token_accuracy FROM pairs GROUP BY conv_id")
def exact_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact matches and tokens right in their place, by conversation."""
    pairs = turn_pairs(spark, sf_dir).select("conv_id", (F.col("t") == F.col("p")).cast("int").alias("same"), metrics.right_in_place(F.col("p"), F.col("t")).alias("right"), F.size("t").alias("n_t"))
    ratio = F.when(F.sum("n_t") > 0, F.round(F.sum("right") / F.sum("n_t"), 6)).otherwise(0.0)
    return pairs.groupBy("conv_id").agg(F.count("*").alias("n"), F.round(F.avg("same"), 6).alias("exact_match"), ratio.alias("token_accuracy"))


@query()
def rouge_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longest common subsequences of whole turns with the turns before, as precision, recall and their mean (tested by brute force)."""
    return metrics.rouge_l(turn_pairs(spark, sf_dir), "p", "t").select("conv_id", "turn", "lcs", F.round("f1", 6).alias("f1"))


@query("""
WITH b AS (SELECT event_id, value AS x0, (user_id % 50)::DOUBLE AS y0, value + 40 AS x1, (user_id % 50 + 30)::DOUBLE AS y1 FROM events), s AS (SELECT event_id, least(greatest(x0 * 0.5 - 10, 0), 60) AS x0, least(greatest(x1 * 0.5 - 10, 0), 60) AS x1, least(greatest(y0 * 0.5 - 5, 0), 20) AS y0, least(greatest(y1 * 0.5 - 5, 0), 20) AS y1 FROM b)
SELECT event_id, round(60 - x1, 6) AS x0, round(y0, 6) AS y0, round(60 - x0, 6) AS x1, round(y1, 6) AS y1 FROM s WHERE x1 > x0 AND y1 > y0
""")
def box_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes scaled by a half, cut to a window and mirrored; empty ones are dropped."""
    v, u = F.col("value"), F.col("user_id") % 50
    box = F.struct(v.alias("x0"), u.cast("double").alias("y0"), (v + 40).alias("x1"), (u + 30).cast("double").alias("y1"))
    b = table(spark, sf_dir, "events").select("event_id", wording.clipped_box(box, 0.5, 10.0, 5.0, 60.0, 20.0, True).alias("b")).where("b is not null")
    return b.select("event_id", *[F.round(F.col("b")[c], 6).alias(c) for c in ("x0", "y0", "x1", "y1")])


@query("SELECT event_id, round((greatest(a, 20) - 20) / 1.25::DOUBLE, 6) AS starts, round((least(b, 80) - 20) / 1.25::DOUBLE, 6) AS ends FROM (SELECT event_id, value AS a, value + user_id % 20 AS b FROM events) WHERE least(b, 80) > greatest(a, 20)")
def timeline_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals cut to seconds 20 to 80 and sped up by a quarter."""
    i = table(spark, sf_dir, "events").select("event_id", wording.clipped_interval(F.col("value"), F.col("value") + F.col("user_id") % 20, 20.0, 80.0, 1.25).alias("i")).where("i is not null")
    return i.select("event_id", F.round("i.start", 6).alias("starts"), F.round("i.end", 6).alias("ends"))


@query("""
WITH v AS (SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'yes' WHEN 1 THEN ' 0 ' WHEN 2 THEN 'TRUE' WHEN 3 THEN 'Off' WHEN 4 THEN '2.5' WHEN 5 THEN 'x' WHEN 6 THEN '' END AS v FROM events)
SELECT coalesce(v, 'null') AS v, CASE WHEN lower(trim(v)) IN ('1', 'true', 'yes', 'y', 'on') THEN true WHEN lower(trim(v)) IN ('0', 'false', 'no', 'n', 'off') THEN false END AS as_bool, try_cast(trim(v) AS DOUBLE) AS as_number, nullif(trim(v), '') AS as_text, count(*)::BIGINT AS n FROM v GROUP BY ALL
""")
def coercions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values as truth, number and text where they can be."""
    names = {0: "yes", 1: " 0 ", 2: "TRUE", 3: "Off", 4: "2.5", 5: "x", 6: ""}
    v = F.lit(None).cast("string")
    for k, name in names.items():
        v = F.when(F.col("event_id") % 8 == k, name).otherwise(v)
    e = table(spark, sf_dir, "events").select(v.alias("v"))
    e = e.select(F.coalesce("v", F.lit("null")).alias("v"), wording.as_bool(F.col("v")).alias("as_bool"), F.expr("try_cast(trim(v) as double)").alias("as_number"), F.when(F.trim("v") != "", F.trim("v")).alias("as_text"))
    return e.groupBy("v", "as_bool", "as_number", "as_text").agg(F.count("*").alias("n"))


@query("""
WITH w AS (SELECT vec_id, unnest([vec_id + 1, (vec_id * 7) % 450, -1, vec_id]) AS negative_id FROM embeddings)
SELECT w.vec_id, count(e.vec_id)::BIGINT AS n_found, min(e.label) AS lowest_label FROM w LEFT JOIN embeddings e ON e.vec_id = w.negative_id AND w.negative_id <> w.vec_id GROUP BY w.vec_id
""")
def negative_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of negatives looked up in the index: how many are there, without the sample itself."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    v = F.col("vec_id")
    w = e.select("vec_id", F.explode(F.array(v + 1, (v * 7) % 450, F.lit(-1).cast("long"), v)).alias("negative_id")).where("negative_id <> vec_id")
    index = e.select(F.col("vec_id").alias("negative_id"), "label")
    return w.join(index, "negative_id", "left").groupBy("vec_id").agg(F.count("label").alias("n_found"), F.min("label").alias("lowest_label"))


@query(f"""
SELECT doc_id, CASE WHEN coalesce(trim(source), '') = '' THEN 'missing_source_url' WHEN {LINE_SQL} = '' THEN 'empty_input' WHEN strlen({TEXT}) > 50000 THEN 'too_large' ELSE 'ok' END AS outcome FROM documents
""")
def input_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first reason why an input can't be used."""
    empty = wording.single_line(F.coalesce("text", F.lit(""))).isNull()
    outcome = F.when(selection.blank(F.col("source")), "missing_source_url").when(empty, "empty_input").when(F.octet_length(F.coalesce("text", F.lit(""))) > 50_000, "too_large").otherwise("ok")
    return documents(spark, sf_dir).select("doc_id", outcome.alias("outcome"))
