"""One query for each numbered operator, over the whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm.byte_bpe import bpe_decode, bpe_encode
from quarrymill.llm.chat_format import chat_format
from quarrymill.llm.common import table
from quarrymill.llm.decontaminate import decontaminate
from quarrymill.llm.html_text import html_text
from quarrymill.llm.license_scan import license_scan
from quarrymill.llm.line_dedup import line_dedup
from quarrymill.llm.merkle import folded, leaf_digest, merkle_manifest, siblings
from quarrymill.llm.near_dedup import near_dedup
from quarrymill.llm.packing import pack_documents
from quarrymill.llm.quality_classifier import quality_scores
from quarrymill.llm.quality_rules import quality_rules
from quarrymill.llm.token_counts import token_counts
from quarrymill.llm.whitening import fit_whitening, whiten


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def digest(text: str) -> Column:
    return F.sha2(F.col(text).cast("binary"), 256)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", digest("text").alias("kept_sha256"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe_encode(documents(spark, sf_dir), path, pattern).select("doc_id", "token_ids")
    decoded = bpe_decode(encoded, path, pattern)
    return decoded.select("doc_id", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"), digest("token_ids").alias("ids_sha256"), digest("decoded").alias("decoded_sha256"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir), with_text=False).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir)).select("doc_id", "license", F.array_join("licenses", ",").alias("licenses"), F.round("license_score", 6).alias("license_score"), "n_notices")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality_scores(documents(spark, sf_dir), labels).select("doc_id", "held_out", "score", "predicted")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format(turns).select("conv_id", "n_turns", "n_copies", digest("rendered").alias("rendered_sha256"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    fit = fit_whitening(vectors)
    rows = whiten(vectors, fit).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    n, error = (fit.n, fit.identity_error) if fit else (0, None)
    explained = F.array(*[F.lit(float(x)) for x in (fit.explained if fit else ())]).cast("array<double>")
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.get(explained, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_tokens")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    leaf = lambda n_chars: leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, leaf(F.col("n_chars").cast("decimal(20,0)") + 1))
    leaves = docs.select("doc_id", "lang", leaf(F.col("n_chars")).alias("original"), tampered.alias("tampered"))
    found = merkle_manifest(leaves, F.col("lang"), F.col("doc_id"), F.col("original"))
    found = found.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(siblings(F.col("proof")), ""), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_byte_bpe, op3_quality_rules, op4_html_text, op5_license_scan, op6_near_dedup, op7_decontaminate, op8_quality_classifier, op9_chat_format, op10_token_counts, op11_whitening, op12_packing, op13_merkle_manifest)}
