"""Queries on pages: URLs, admission, title, language, links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import language, url
from quarrymill.sources.tables import table

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def pages(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", *more)


PARTS = r"""
parts AS (SELECT page_id, url, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) AS scheme, lower(regexp_extract(url, '^[^:]*://([^/?#]*)', 1)) AS host, regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1) AS path,
  regexp_extract(url, '\?([^#]*)', 1) AS query FROM pages),
kept AS (SELECT *, list_filter(string_split(query, '&'), lambda p: p <> '' AND NOT (lower(split_part(p, '=', 1)) IN ('fbclid','gclid','mc_cid','mc_eid','msclkid','utm_campaign','utm_content','utm_medium','utm_source','utm_term'))) AS q FROM parts),
sorted AS (SELECT *, CASE WHEN len(list_distinct(list_transform(q, lambda p: split_part(p, '=', 1)))) = len(q) THEN list_sort(q) ELSE q END AS s FROM kept)
"""


@query(f"WITH {PARTS} SELECT page_id, lower(scheme) || '://' || host || CASE WHEN path = '' THEN '/' ELSE regexp_replace(path, '/{{2,}}', '/', 'g') END || CASE WHEN len(s) > 0 THEN '?' || array_to_string(s, '&') ELSE '' END AS normalized FROM sorted")
def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select("page_id", url.normalized(F.col("url")).alias("normalized"))


@query(f"WITH {PARTS} SELECT page_id, len(list_filter(string_split(query, '&'), lambda p: p <> ''))::BIGINT AS n_parameters, len(q)::BIGINT AS n_kept, array_to_string(s, '&') AS kept FROM sorted")
def url_tracking_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = url.without_tracking(F.col("url"))
    return pages(spark, sf_dir).select("page_id", F.size(url.parameters(F.col("url"))).cast("long").alias("n_parameters"), F.size(kept).cast("long").alias("n_kept"), F.array_join(kept, "&").alias("kept"))


@query(f"WITH {PARTS} SELECT page_id, sha256(lower(scheme) || '://' || host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN query = '' THEN '' ELSE '?' || query END) AS url_hash, sha256('//' || host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN query = '' THEN '' ELSE '?' || query END) AS agnostic_hash, scheme || '://' || host || path AS public_url FROM parts")
def url_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return pages(spark, sf_dir).select("page_id", url.url_hash(u).alias("url_hash"), url.url_hash(u, True).alias("agnostic_hash"), url.public(u).alias("public_url"))


@query(r"SELECT page_id, CASE WHEN n <> '' THEN n::BIGINT END AS page_number FROM (SELECT page_id, regexp_extract(url, '[?&](?:page|p|pg)=(\d{1,9})(?:&|#|$)', 1) AS n FROM pages)")
def url_pagination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select("page_id", url.page_number(F.col("url")).alias("page_number"))


@query(r"SELECT CASE WHEN NOT regexp_matches(url, '^https?://') THEN 'unsupported_scheme' WHEN regexp_matches(url, '^[^:]*://[0-9.]+(/|$)') THEN 'ip_literal' WHEN length(url) > 2048 THEN 'url_too_long' ELSE 'accept' END AS decision, regexp_extract(lower(regexp_extract(url, '^[^:]*://([^/?#]*)', 1)), '([^.]+\.[^.]+)$', 1) AS site, count(*)::BIGINT AS n FROM pages GROUP BY ALL")
def url_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pages(spark, sf_dir).select(url.admission(F.col("url")).alias("decision"), F.regexp_extract(url.host(F.col("url")), r"([^.]+\.[^.]+)$", 1).alias("site"))
    return d.groupBy("decision", "site").agg(F.count("*").alias("n"))


@query("SELECT host, kind, n_pages FROM (SELECT lower(regexp_extract(url, '^[^:]*://([^/?#]*)', 1)) AS host, 'page' AS kind, count(*)::BIGINT AS n_pages FROM pages GROUP BY ALL)")
def page_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pages(spark, sf_dir).select(url.host(F.col("url")).alias("host"), url.kind(F.col("url")).alias("kind"))
    return d.groupBy("host", "kind").agg(F.count("*").alias("n_pages"))


@query(r"""SELECT page_id, regexp_replace(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '\s+', ' ', 'g') AS title, lower(split_part(regexp_extract(html, '(?i)<html[^>]*\blang="([^"]*)"', 1), '-', 1)) AS lang FROM pages""")
def html_title_and_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.regexp_replace(F.trim(F.regexp_extract(F.coalesce("html", F.lit("")), r"(?is)<title[^>]*>(.*?)</title>", 1)), r"\s+", " ")
    lang = F.regexp_extract(F.coalesce("html", F.lit("")), r'(?i)<html[^>]*\blang="([^"]*)"', 1)
    return pages(spark, sf_dir, "html").select("page_id", title.alias("title"), F.coalesce(language.normalized_code(lang), F.lit("")).alias("lang"))


@query(r"""SELECT page_id, len(x)::BIGINT AS n_links, len(list_distinct(x))::BIGINT AS n_distinct, sha256(array_to_string(list_sort(list_distinct(x)), chr(10))) AS links_sha256 FROM (SELECT page_id, regexp_extract_all(html, '(?i)<a\b[^>]*\bhref="([^"]*)"', 1) AS x FROM pages)""")
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pages(spark, sf_dir, "html").select("page_id", F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r'(?i)<a\b[^>]*\bhref="([^"]*)"'), 1).alias("x"))
    return d.select("page_id", F.size("x").cast("long").alias("n_links"), F.size(F.array_distinct("x")).cast("long").alias("n_distinct"), F.sha2(F.array_join(F.array_sort(F.array_distinct("x")), "\n"), 256).alias("links_sha256"))


@query(r"""
WITH p AS (SELECT page_id, lower(url) AS u, html FROM pages), s AS (SELECT page_id, [{'s': len(regexp_extract_all(html, '(?i)<pre|<code')) * 2 + contains(u, 'doc')::INT, 'p': -0, 'c': 'documentation'}, {'s': len(regexp_extract_all(html, '(?i)abstract|doi\.org')), 'p': -1, 'c': 'academic'}, {'s': len(regexp_extract_all(html, '(?i)<article')) + contains(u, 'news')::INT, 'p': -2, 'c': 'news'}, {'s': len(regexp_extract_all(html, '(?i)<img|<video|<audio')), 'p': -3, 'c': 'media'}] AS x FROM p)
SELECT page_id, CASE WHEN list_max(x).s > 0 THEN list_max(x).c ELSE 'boilerplate' END AS category, list_max(x).s::BIGINT AS score FROM s
""")
def content_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category with most signs, ties by priority."""
    h, u = F.coalesce("html", F.lit("")), F.lower("url")
    n = lambda p: F.regexp_count(h, F.lit(p))
    scores = {"documentation": n("(?i)<pre|<code") * 2 + u.contains("doc").cast("int"), "academic": n(r"(?i)abstract|doi\.org"), "news": n("(?i)<article") + u.contains("news").cast("int"), "media": n("(?i)<img|<video|<audio")}
    best = F.array_max(F.array(*[F.struct(s.cast("long").alias("s"), F.lit(-i).alias("p"), F.lit(c).alias("c")) for i, (c, s) in enumerate(scores.items())]))
    return pages(spark, sf_dir, "html").select("page_id", best.alias("b")).select("page_id", F.when(F.col("b.s") > 0, F.col("b.c")).otherwise("boilerplate").alias("category"), F.col("b.s").alias("score"))
