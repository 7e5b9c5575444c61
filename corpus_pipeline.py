"""Documents through five of the operators, each stage on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm.byte_bpe import bpe_decode, bpe_encode
from quarrymill.llm.common import table
from quarrymill.llm.decontaminate import decontaminate
from quarrymill.llm.line_dedup import line_dedup
from quarrymill.llm.near_dedup import near_dedup
from quarrymill.llm.quality_rules import quality_rules
from quarrymill.operators.lineage import Scratch


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality_rules(docs).where("kept").select(docs.columns)


def _lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of other documents go, and n_chars is counted anew; a document that keeps no text stays, with an empty one."""
    return line_dedup(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def _near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id; of rows with the same id all stay."""
    return near_dedup(docs).where("kept").select(docs.columns)


def _benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).where("n_hit = 0").select(docs.columns)


def _tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents, n_tokens, token_ids (little-endian 32-bit integers) and round_trip: whether the decoded ids are the text's bytes."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    decoded = bpe_decode(bpe_encode(docs, path, pattern), path, pattern)
    back = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return decoded.select(*docs.columns, (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"), "token_ids", back.alias("round_trip"))


STAGES = [("quality rules", _quality), ("line dedup", _lines), ("MinHash near-dedup", _near), ("benchmark decontamination", _benchmark), ("byte-level BPE", _tokens)]
#: SQL can't express byte-level BPE; tests/llm/test_stages.py compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's rows are written as Parquet in the shared folder and read again by the next."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
