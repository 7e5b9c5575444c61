"""Tables by name, and typed JSON lines with what can't be read kept apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Tables whose rows take long to work on, and up to what size they are dealt to all cores.
TEXTS, DEALT_BYTES = ("documents", "pages"), 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A small table of texts is dealt row by row to all cores, as a file of one row group is read by one task alone. Filters and the
    choice of columns still reach the scan. Larger tables stay as they are read."""
    path = f"{sf_dir}/{name}.parquet"
    df = spark.read.parquet(path)
    return df.repartition(spark.sparkContext.defaultParallelism) if name in TEXTS and stored_bytes(spark, path) <= DEALT_BYTES else df


def stored_bytes(spark: SparkSession, path: str) -> int:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, most_bytes: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """Good rows by schema, and rejected ones (value, reason): longer than most_bytes, no JSON, or not of these types."""
    lines = spark.read.text(path).where(F.trim("value") != "").withColumn("source_file", F.col("_metadata.file_path"))
    checked = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = lines.withColumn("_r", F.from_json("value", checked, {"columnNameOfCorruptRecord": "_corrupt"}))
    reason = F.when(F.octet_length("value") > most_bytes, "too_long").when(F.col("_r").isNull() | F.col("_r._corrupt").isNotNull(), "malformed")
    parsed = parsed.withColumn("reason", reason)
    good = parsed.where("reason is null").select(*[F.col("_r")[f.name].alias(f.name) for f in schema.fields], "source_file")
    return good, parsed.where("reason is not null").select("value", "reason", "source_file")


def require_version(df: DataFrame, column: str, supported: tuple[str, ...]) -> DataFrame:
    """The rows, or an error that names the first version that isn't supported: checked when the rows are read, in the same pass."""
    ok = F.coalesce(F.col(column).isin(*supported), F.lit(False))
    message = F.concat(F.lit("unsupported schema version: "), F.coalesce(F.col(column).cast("string"), F.lit("null")))
    return df.withColumn(column, F.when(ok, F.col(column)).otherwise(F.raise_error(message)))


def completed_runs(records: DataFrame, runs: DataFrame, run: str = "run_id") -> DataFrame:
    """Records of runs that are completed and final."""
    return records.join(runs.where("status = 'completed' and final").select(run), run, "left_semi")


def latest_run(runs: DataFrame, run: str = "run_id", finished: str = "finished_at") -> DataFrame:
    return runs.where("status = 'completed' and final").orderBy(F.desc(finished), F.desc(run)).limit(1)


def without_revoked(records: DataFrame, revoked: DataFrame, key: str) -> DataFrame:
    """The records, or an error if one of them has a revoked key."""
    marked = records.join(revoked.select(key).distinct().withColumn("_revoked", F.lit(True)), key, "left")
    return marked.withColumn(key, F.when(F.col("_revoked"), F.raise_error(F.concat(F.lit("revoked: "), F.col(key).cast("string")))).otherwise(F.col(key))).drop("_revoked")


def sitemap_locations(documents: DataFrame, xml: str) -> DataFrame:
    """Rows url, kind: locations of pages, and of nested sitemaps."""
    clean = F.regexp_replace(F.col(xml), r"<\?xml[^>]*\?>|\sxmlns(?::\w+)?=(?:\"[^\"]*\"|'[^']*')", "")
    pages = documents.select(F.explode(F.xpath(clean, F.lit("/urlset/url/loc/text()"))).alias("url")).withColumn("kind", F.lit("page"))
    nested = documents.select(F.explode(F.xpath(clean, F.lit("/sitemapindex/sitemap/loc/text()"))).alias("url")).withColumn("kind", F.lit("sitemap"))
    return pages.union(nested).withColumn("url", F.trim("url"))


def feed_entries(documents: DataFrame, xml: str, most: int = 500) -> DataFrame:
    """Rows title, link of an RSS feed's first entries."""
    clean = F.regexp_replace(F.col(xml), r"<\?xml[^>]*\?>", "")
    titles, links = F.xpath(clean, F.lit("/rss/channel/item/title/text()")), F.xpath(clean, F.lit("/rss/channel/item/link/text()"))
    return documents.select(F.explode(F.slice(F.arrays_zip(titles.alias("title"), links.alias("link")), 1, most)).alias("e")).select("e.title", "e.link")
