"""Samples made ready for release: their evidence, verdicts of quality, and what their task asks for."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions import selection, text
from quarrymill.functions.language import normalized_code
from quarrymill.functions.wording import bound

# Fixed values.
PAIR_TASKS = ("document_text_pair", "image_text_pair", "audio_text_pair", "video_text_pair")
SAFETY_TERMS = ("exploit", "gore", "nsfw", "porn", "terrorist")
GENERIC = ("image", "photo", "picture", "logo", "icon", "click here", "read more", "video", "audio")
UNKNOWN_LICENSES = ("unknown", "none", "unspecified")
UNSAFE, PERSONAL, USAGE, UNINFORMATIVE = "blocked_safety_content", "blocked_pii_content", "usage_rules_blocks_training", "generic_or_uninformative_caption"

#: What a task asks for: input modalities, target fields, and of how many of which modalities there must be evidence.
INPUTS = {
    "representation": "text", "text_pretrain": "text", "causal_text_pretrain": "text", "instruction_following": "text", "summarization": "text", "translation": "text",
    "classification": "text", "information_extraction": "text", "semantic_search": "text", "image_text_pair": "image text", "image_captioning": "image text",
    "object_recognition": "image", "image_classification": "image", "vqa": "image text", "ocr_parse": "image layout", "audio_text_pair": "audio text",
    "speech_transcription": "audio", "audio_summarization": "audio text", "audio_qa": "audio text", "document_text_pair": "document text", "pdf_text_pair": "document text",
    "document_summarization": "document text", "doc_qa": "document text", "table_extraction": "document text layout", "multimodal_evidence_qa": "text",
}
TARGETS = {
    "instruction_following": "instruction target_text", "summarization": "target_text", "translation": "target_text", "classification": "label", "information_extraction": "target_text",
    "semantic_search": "positive_id negative_ids", "image_text_pair": "target_text", "image_captioning": "target_text", "object_recognition": "object_boxes",
    "image_classification": "label", "vqa": "question target_text", "ocr_parse": "target_text layout_boxes", "audio_text_pair": "target_text", "speech_transcription": "target_text",
    "audio_summarization": "target_text", "audio_qa": "question target_text", "document_text_pair": "target_text", "pdf_text_pair": "target_text",
    "document_summarization": "target_text", "doc_qa": "question target_text", "table_extraction": "target_table_structure", "multimodal_evidence_qa": "target_text",
}


@dataclass(frozen=True)
class Demands:
    """What a release asks of its samples; scores by modality or task, nothing where a name is missing."""

    accepted_languages: tuple[str, ...] = ("en",)
    min_language_confidence: float = 0.0
    min_alignment: float = 0.3
    min_caption_quality: float = 0.35
    min_pairability: float = 0.3
    min_quality: dict[str, float] = field(default_factory=dict)
    min_context: dict[str, float] = field(default_factory=dict)
    min_alignment_by_modality: dict[str, float] = field(default_factory=dict)
    min_alignment_by_task: dict[str, float] = field(default_factory=dict)
    require_safety: bool = False
    known_license: bool = False
    license_evidence: bool = False
    license_url_or_terms: bool = False


#: Columns that the operators read, with their types; those that a table doesn't have are null.
READ = {
    "text": "string", "modality": "string", "task": "string", "language": "string", "language_confidence": "double", "language_script": "string", "quality_score": "double",
    "context_score": "double", "pairability_score": "double", "alignment_score": "double", "safety_status": "string", "pii_outcome": "string", "allow_training": "boolean",
    "license": "string", "license_url": "string", "terms_source": "string", "source_url": "string", "document_id": "string", "chunk_id": "string", "object_id": "string",
    "object_path": "string", "object_ids": "array<string>", "spans": "array<struct<page_number:int,text:string>>", "output_modalities": "array<string>", "image_dhash": "string",
    "image_phash": "string", "audio_chromaprint": "string", "video_phashes": "array<string>", "content_hash": "string",
}


def by_name(name: Column, values: dict[str, float], other: float | None = None) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("double"))
    for k, v in values.items():
        out = out.when(name == k, float(v))
    return out.otherwise(F.lit(other).cast("double"))


def filled(c: Column) -> Column:
    """Whether there is more than white space."""
    return ~selection.blank(c)


def generic_text(folded: Column) -> Column:
    """Of a folded text: empty, a stock phrase, two words of which one is stock, or more than 60 % of the words said before."""

    def of_words(words: Column) -> Column:
        return ((F.size(words) <= 2) & F.exists(words, lambda w: w.isin(*GENERIC))) | (1.0 - F.size(F.array_distinct(words)) / F.size(words) > 0.6)

    return (folded == "") | folded.isin(*GENERIC) | bound(F.split(folded, " "), of_words)


def first_script(t: Column) -> Column:
    """Latin or Other by the first letter, Unknown without one."""
    letter = F.regexp_extract(F.coalesce(t, F.lit("")), r"(\p{L})", 1)
    return F.when(letter == "", "Unknown").when(letter.rlike(r"\p{IsLatin}"), "Latin").otherwise("Other")


def usage_status(allowed: Column, name: Column, address: Column, terms: Column, demands: Demands) -> Column:
    """training_allowed, blocked or unknown: consent with a licence allows, refusal or missing evidence blocks."""
    known = filled(name) & ~F.lower(F.trim(name)).isin(*UNKNOWN_LICENSES)
    met = F.lit(True)
    if demands.known_license:
        met = met & known
    if demands.license_evidence:
        met = met & filled(address)
    if demands.license_url_or_terms:
        met = met & (filled(address) | filled(terms))
    agreed = F.coalesce(allowed, F.lit(False)) & (known if demands.known_license else filled(name)) & met
    return F.when(agreed, "training_allowed").when(~F.coalesce(allowed, F.lit(True)) | ~met, "blocked").otherwise("unknown")


#: What text_evidence adds.
EVIDENCE = ("language_script", "safety_labels", "content_hash", "emitted_text_sha256", "normalized_text_sha256", "text_shingle_profile", "document_layout_sha256", "generic")


def with_all_columns(samples: DataFrame) -> DataFrame:
    """The columns of READ in their types, null where the table lacks them."""
    has = set(samples.columns)
    return samples.withColumns({n: (F.col(n) if n in has else F.lit(None)).cast(t) for n, t in READ.items()})


def text_evidence(samples: DataFrame, shingle_width: int = 4) -> DataFrame:
    """The samples with the columns of EVIDENCE, which need texts and spans alone, so that a join for the other evidence needn't carry texts.

    Columns of READ that the table lacks are null, and other columns stay as they are; those of the new names are replaced, but a script and a content hash that are
    given stay. A null or empty text has no hashes of its own and is generic. No shuffle; profiles are made only where they are asked for.
    """
    body, given = F.coalesce("text", F.lit("")), lambda c: F.when(F.col(c) != "", F.col(c))
    s = with_all_columns(samples).withColumns({"_folded": text.folded(F.col("text")), "_low": F.lower(body)})
    s = s.withColumn("_words", F.when(F.col("_folded") != "", F.split("_folded", " ")).otherwise(F.array().cast("array<string>")))
    layout = F.array_join(F.transform(F.coalesce("spans", F.array().cast(READ["spans"])), lambda x: F.concat(F.coalesce(x["page_number"], F.lit(0)).cast("string"), F.lit(":"), F.length(F.coalesce(x["text"], F.lit(""))).cast("string"))), "|")
    s = s.withColumns({
        "language_script": F.coalesce(given("language_script"), first_script(F.col("text"))),
        "safety_labels": F.filter(F.array(*[F.when(F.contains("_low", F.lit(t)), t) for t in SAFETY_TERMS]), lambda x: x.isNotNull()),
        "content_hash": F.coalesce(given("content_hash"), F.sha2(F.concat_ws("\n", given("text"), given("object_id"), given("object_path"), given("source_url")), 256)),
        "emitted_text_sha256": F.when(body != "", F.sha2(body, 256)),
        "normalized_text_sha256": F.when(F.col("_folded") != "", F.sha2("_folded", 256)),
        "text_shingle_profile": F.when(F.col("_folded") != "", F.array_sort(text.shingles("_words", shingle_width))),
        "document_layout_sha256": F.when(F.col("modality") == "document", F.sha2(layout, 256)),
        "generic": generic_text(F.col("_folded")),
    })
    return s.select(*[F.col(f"`{c}`") for c in samples.columns if c not in EVIDENCE], *EVIDENCE)


def finalized(samples: DataFrame, demands: Demands, shingle_width: int = 4) -> DataFrame:
    """The samples with the columns of EVIDENCE, language, language_confidence, safety_status, pii_status, usage_status, alignment_score, source_object_ids,
    fingerprints_complete and quarantine_reason.

    Evidence of texts is taken from a table that has the columns already. Columns of READ that the table lacks are null, and other columns stay as they are. A
    null or empty text has no hashes and is generic. A null ``pii_outcome`` has not been inspected and blocks, as anything but accept
    does. A null quality or alignment counts as 0. Repeated rows stay. Columns alone, no shuffle.
    """
    if not set(EVIDENCE) <= set(samples.columns):
        samples = text_evidence(samples, shingle_width)
    s = with_all_columns(samples).withColumn("language", normalized_code(F.col("language")))
    own = F.coalesce("safety_status", F.lit(""))
    safety = F.when((F.size("safety_labels") > 0) | (own == "blocked"), "blocked").when((own == "passed") | F.col("modality").isin("text", "document"), "passed").otherwise("blocked" if demands.require_safety else "passed")
    pair = F.coalesce(F.col("task").isin(*PAIR_TASKS), F.lit(False))
    ids = F.concat(F.array("document_id", "chunk_id", "object_id"), F.coalesce("object_ids", F.array().cast("array<string>")))
    verdicts = {
        "language": F.col("language"),
        "language_confidence": F.coalesce("language_confidence", F.when(F.col("language").isNotNull(), 1.0).otherwise(0.0)),
        "safety_status": safety,
        "pii_status": F.when(F.col("pii_outcome") == "accept", "passed").otherwise("blocked"),
        "usage_status": usage_status(F.col("allow_training"), F.col("license"), F.col("license_url"), F.col("terms_source"), demands),
        "alignment_score": selection.alignment_score(pair, *[F.coalesce(c, F.lit(0.0)) for c in ("alignment_score", "quality_score")], F.col("pairability_score"), F.col("context_score")),
        "source_object_ids": F.array_distinct(F.filter(ids, lambda x: F.coalesce(x != "", F.lit(False)))),
    }
    s = s.withColumns(verdicts)
    named = F.concat(F.array("modality"), F.coalesce("output_modalities", F.array().cast("array<string>")))
    lacks = lambda medium, *evidence: F.coalesce(F.array_contains(named, medium), F.lit(False)) & ~F.forall(F.array(*evidence), lambda e: F.coalesce(e, F.lit(False)))
    missing = (
        lacks("image", filled(F.col("image_dhash")), filled(F.col("image_phash"))) | lacks("audio", filled(F.col("audio_chromaprint")))
        | lacks("video", F.size(F.coalesce("video_phashes", F.array().cast("array<string>"))) > 0) | lacks("document", F.col("document_layout_sha256").isNotNull())
    )
    quarantine = F.when(F.col("safety_status") == "blocked", UNSAFE).when(F.col("pii_status") == "blocked", PERSONAL).when(F.col("usage_status") == "blocked", USAGE).when(F.col("generic"), UNINFORMATIVE)
    out = s.withColumns({"fingerprints_complete": ~missing, "quarantine_reason": quarantine})
    new = [*verdicts, "fingerprints_complete", "quarantine_reason"]
    return out.select(*[F.col(f"`{c}`") for c in samples.columns if c not in new], *new)


def quality_reason(samples: DataFrame, demands: Demands) -> DataFrame:
    """Finalized samples with ``reason``, the first reason against their quality; null if there is none. Columns of READ that are missing are null: a
    score that is null counts as 0, but a context or pairability that is asked for must be there."""
    has = set(samples.columns)
    c = {n: F.col(n) if n in has else F.lit(None).cast(t) for n, t in READ.items()}
    score = lambda n: F.coalesce(c[n], F.lit(0.0))
    modality, task = F.coalesce(c["modality"], F.lit("")), F.coalesce(c["task"], F.lit(""))
    quality, context = by_name(modality, demands.min_quality), by_name(modality, demands.min_context)
    aligned = F.greatest(F.lit(float(demands.min_alignment)), by_name(modality, demands.min_alignment_by_modality, 0.0), by_name(task, demands.min_alignment_by_task, 0.0))
    spoken = selection.language_allowed(c["language"], c["language_confidence"], list(demands.accepted_languages), demands.min_language_confidence)
    held = F.col("quarantine_reason")
    reason = (
        F.when(task.isin(*PAIR_TASKS) & (score("pairability_score") < demands.min_pairability), "low_alignment_score")
        .when(quality.isNotNull() & (score("quality_score") < quality), "low_modality_quality")
        .when(context.isNotNull() & (c["context_score"].isNull() | (c["context_score"] < context)), "low_context_score")
        .when(score("alignment_score") < aligned, "low_alignment_score")
        .when(~spoken, "language_rules_reject")
        .when((F.col("safety_status") == "blocked") | (F.col("pii_status") == "blocked"), "safety_or_pii_blocked")
        .when(~F.col("fingerprints_complete"), "required_fingerprint_evidence_missing")
        .when(held.isNotNull(), F.when(held.isin(UNSAFE, PERSONAL, USAGE, UNINFORMATIVE), held).otherwise("safety_or_pii_blocked"))
        .when((modality == "image") & (score("quality_score") < demands.min_caption_quality), "low_caption_quality")
        .when(F.col("generic"), "generic_caption")
    )
    return samples.withColumn("reason", reason)


def task_errors(task: Column, has: Column, fields: Column, evidence: dict[str, tuple[int, tuple[str, ...]]] | None = None) -> Column:
    """What a sample lacks for its task: array of unknown_task_type:, missing_required_modality:, insufficient_evidence_modalities: and
    missing_required_field: with names.

    ``has`` are the modalities that it has, ``fields`` a map of target fields as text; those that are blank are missing. The target text may stand
    in ``answer``. ``evidence`` gives, for tasks on several media, how many of which modalities there must be. Null arrays and maps are empty.
    """
    has, fields = F.coalesce(has, F.array().cast("array<string>")), F.coalesce(fields, F.create_map().cast("map<string,string>"))
    named = lambda table: F.coalesce(F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[task], F.lit(""))
    wanted = lambda table: F.filter(F.split(named(table), " "), lambda x: x != "")
    told = lambda prefix, names: F.transform(names, lambda x: F.concat(F.lit(prefix), x))
    empty = lambda f: selection.blank(F.try_element_at(fields, f)) & ((f != "target_text") | selection.blank(F.try_element_at(fields, F.lit("answer"))))
    out = [told("missing_required_modality:", F.array_except(wanted(INPUTS), has))]
    for name, (least, media) in (evidence or {}).items():
        n = F.size(F.array_intersect(has, F.array(*[F.lit(m) for m in media])))
        out.append(F.when((task == name) & (n < least), F.array(F.concat(F.lit("insufficient_evidence_modalities:"), n.cast("string"), F.lit(f"/{least}")))).otherwise(F.array().cast("array<string>")))
    out.append(told("missing_required_field:", F.filter(wanted(TARGETS), empty)))
    unknown = F.array(F.concat(F.lit("unknown_task_type:"), F.coalesce(task, F.lit(""))))
    return F.when(F.coalesce(task.isin(*INPUTS), F.lit(False)), F.concat(*out)).otherwise(unknown)
