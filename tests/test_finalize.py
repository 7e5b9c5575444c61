"""Evidence of samples, the reasons against them in order, and what their tasks ask for."""

import hashlib

import pytest
from pyspark.sql import functions as F

from quarrymill.functions import language
from quarrymill.operators import finalize
from quarrymill.operators.finalize import Demands

GOOD = {"text": "a plain text about rivers", "modality": "text", "task": "text_pretrain", "language": "EN-us", "quality_score": 0.9, "pii_outcome": "accept", "allow_training": True, "license": "MIT"}
SCHEMA = ", ".join(f"{n} {t}" for n, t in finalize.READ.items())


def run(spark, demands, *rows):
    full = [tuple((dict.fromkeys(finalize.READ) | GOOD | r).values()) for r in rows]
    return finalize.quality_reason(finalize.finalized(spark.createDataFrame(full, SCHEMA), demands), demands).collect()


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_evidence(spark):
    row, empty, document, nothing = run(
        spark, Demands(),
        {"text": "One  two three\nFOUR five", "object_id": "o", "source_url": "http://u", "document_id": "d", "object_ids": ["o", "p", None, ""]},
        {"text": " ", "language": "und"},
        {"modality": "document", "spans": [(1, "abc"), (None, "de")], "text": "Нет gore"},
        dict.fromkeys(finalize.READ),
    )
    assert (row["language"], row["language_confidence"], row["language_script"], row["reason"]) == ("en", 1.0, "Latin", None)
    assert row["content_hash"] == digest("One  two three\nFOUR five\no\nhttp://u") and row["source_object_ids"] == ["d", "o", "p"]
    assert row["normalized_text_sha256"] == digest("one two three four five") and row["emitted_text_sha256"] == digest("One  two three\nFOUR five")
    assert row["text_shingle_profile"] == ["one two three four", "two three four five"]
    assert (empty["language"], empty["language_confidence"], empty["language_script"], empty["normalized_text_sha256"]) == (None, 0.0, "Unknown", None)
    assert empty["reason"] == "language_rules_reject" and empty["quarantine_reason"] == finalize.UNINFORMATIVE
    assert document["document_layout_sha256"] == digest("1:3|0:2") and document["safety_labels"] == ["gore"] and document["language_script"] == "Other"
    assert nothing["pii_status"] == "blocked" and nothing["reason"] == "low_alignment_score"


@pytest.mark.parametrize(
    ("demands", "sample", "reason"),
    [
        ({}, {}, None),
        ({}, {"task": "image_text_pair"}, "low_alignment_score"),
        ({}, {"task": "image_text_pair", "pairability_score": 0.3, "context_score": 0.4}, None),
        ({}, {"task": "image_text_pair", "pairability_score": 0.3, "context_score": 0.1}, "low_alignment_score"),
        ({"min_quality": {"text": 0.95}}, {}, "low_modality_quality"),
        ({"min_quality": {"image": 0.95}}, {}, None),
        ({"min_context": {"text": 0.2}}, {}, "low_context_score"),
        ({"min_context": {"text": 0.2}}, {"context_score": 0.2}, None),
        ({"min_alignment_by_task": {"text_pretrain": 0.95}}, {}, "low_alignment_score"),
        ({"min_alignment_by_modality": {"text": 0.95}}, {"alignment_score": 0.96}, None),
        ({}, {"language": "fr"}, "language_rules_reject"),
        ({"accepted_languages": ()}, {"language": None}, None),
        ({"min_language_confidence": 0.6}, {"language_confidence": 0.5}, "language_rules_reject"),
        ({}, {"text": "some NSFW words here"}, "safety_or_pii_blocked"),
        ({}, {"safety_status": "blocked"}, "safety_or_pii_blocked"),
        ({}, {"pii_outcome": "remediate"}, "safety_or_pii_blocked"),
        ({"require_safety": True}, {"modality": "image", "image_dhash": "1", "image_phash": "2"}, "safety_or_pii_blocked"),
        ({"require_safety": True}, {"modality": "image", "image_dhash": "1", "image_phash": "2", "safety_status": "passed"}, None),
        ({}, {"modality": "image", "image_dhash": "1"}, "required_fingerprint_evidence_missing"),
        ({}, {"output_modalities": ["audio"]}, "required_fingerprint_evidence_missing"),
        ({}, {"modality": "video", "video_phashes": []}, "required_fingerprint_evidence_missing"),
        ({}, {"modality": "document"}, None),
        ({}, {"allow_training": False}, "usage_rules_blocks_training"),
        ({}, {"allow_training": None}, None),
        ({"known_license": True}, {"license": "Unknown"}, "usage_rules_blocks_training"),
        ({"license_evidence": True}, {}, "usage_rules_blocks_training"),
        ({"license_url_or_terms": True}, {"terms_source": "t"}, None),
        ({}, {"text": "Photo  one"}, "generic_or_uninformative_caption"),
        ({}, {"text": "b b b c"}, None),
        ({}, {"text": "b b b b"}, "generic_or_uninformative_caption"),
        ({}, {"modality": "image", "image_dhash": "1", "image_phash": "2", "quality_score": 0.34}, "low_caption_quality"),
    ],
)
def test_reason(spark, demands, sample, reason):
    assert run(spark, Demands(**demands), sample)[0]["reason"] == reason


def test_missing_and_further_columns(spark):
    table = spark.createDataFrame([("x y z", 1)], "text string, _mine int")
    out = finalize.quality_reason(finalize.finalized(table, Demands()), Demands())
    assert out.columns[:2] == ["text", "_mine"] and out.first()["reason"] == "low_alignment_score"
    assert finalize.finalized(table.limit(0), Demands()).count() == 0


def test_task_errors(spark):
    rows = [
        ("vqa", ["image", "text"], {"question": "q", "answer": "a"}), ("vqa", ["text"], {"question": " "}), ("no_such", [], {}), (None, None, None),
        ("text_pretrain", ["text"], None), ("multimodal_evidence_qa", ["text", "image"], {"target_text": "t"}), ("multimodal_evidence_qa", ["text", "image", "audio"], {"target_text": "t"}),
    ]
    t = spark.createDataFrame(rows, "task string, has array<string>, fields map<string,string>")
    wanted = {"multimodal_evidence_qa": (2, ("document", "image", "audio", "video"))}
    assert [r[0] for r in t.select(finalize.task_errors(F.col("task"), F.col("has"), F.col("fields"), wanted)).collect()] == [
        [], ["missing_required_modality:image", "missing_required_field:question", "missing_required_field:target_text"], ["unknown_task_type:no_such"], ["unknown_task_type:"],
        [], ["insufficient_evidence_modalities:1/2"], [],
    ]
    assert set(finalize.TARGETS) <= set(finalize.INPUTS)


def test_language_by_script(spark):
    rows = [("Ж",), ("中",), ("ねこ",), ("क",), ("한",), ("ש",), ("abc",), ("",), (None,), ("مرحبا",)]
    got = [(r["x"]["language"], r["x"]["confidence"]) for r in spark.createDataFrame(rows, "t string").select(language.inferred(F.col("t")).alias("x")).collect()]
    assert got == [("ru", 0.65), ("zh", 0.65), ("ja", 0.5), ("hi", 0.65), ("ko", 0.65), (None, 0.0), (None, 0.0), (None, 0.0), (None, 0.0), ("ar", 1.0)]


def test_patterns_are_looked_for_once(spark):
    """Addresses count twice in an outcome, but each pattern stands in the plan once."""
    from quarrymill.plans import release

    plan = release.documents(spark, "/root/testdata/sf0.001").select("pii_outcome", "generic")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 3
    assert plan.count("split(") == 2  # an address and the words
