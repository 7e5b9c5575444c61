"""Language and script of texts by marker words and character ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marker words of each language.
MARKERS = {
    "en": "the and of to in for with from that this are was were have has project page contact normal extraction ordinary words",
    "nl": "de het een en van in is dat voor met op zijn niet als door deze tekst pagina project vandaag verwerking",
    "de": "der die das und ist nicht mit den von zu ein eine für auf im dem diese seite projekt verarbeitung",
    "fr": "le la les des et est dans pour avec une un que qui sur par cette page projet traitement",
    "es": "el la los las de y en que para con una un por esta página proyecto procesamiento",
    "pt": "o a os as de e em que para com uma um por esta página projeto processamento",
    "it": "il lo la gli le di e in che per con una un questa pagina progetto elaborazione",
}
SCRIPTS = {"Latin": r"\p{IsLatin}", "Cyrillic": r"\p{IsCyrillic}", "Arabic": r"\p{IsArabic}", "Devanagari": r"\p{IsDevanagari}", "Hiragana": r"\p{IsHiragana}", "Katakana": r"\p{IsKatakana}", "Hangul": r"\p{IsHangul}", "Han": r"\p{IsHan}"}
SCRIPT_LANGUAGE = {"Cyrillic": "ru", "Han": "zh", "Hiragana": "ja", "Katakana": "ja", "Arabic": "ar", "Devanagari": "hi", "Hangul": "ko"}
RANGES = {"ar": "[\\u0600-\\u06FF\\u0750-\\u077F]", "ru": "[\\u0400-\\u04FF]", "zh": "[\\u4E00-\\u9FFF]", "ja": "[\\u3040-\\u30FF]"}


def words_of(text: Column) -> Column:
    """Lower-case runs of two letters or more."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}{2,})"), 1)


def marker_words(words: Column) -> Column:
    """The few words that any language counts, so that each language doesn't look at all words again."""
    return F.filter(words, lambda w: w.isin(sorted({m for markers in MARKERS.values() for m in markers.split()})))


def marker_hits(words: Column) -> dict[str, Column]:
    def among(markers: str) -> Column:
        return F.size(F.filter(words, lambda w: w.isin(sorted(set(markers.split())))))

    return {lang: among(m) for lang, m in MARKERS.items()}


def best_marker_language(hits: dict[str, Column], n_words: Column) -> Column:
    """Struct language, confidence, mixed: most hits win, two at least, and none wins a tie at the top. Hits should be columns, as an
    expression would be computed anew for each use."""
    ordered = F.reverse(F.array_sort(F.array(*[F.struct(h.alias("n"), F.lit(-i).alias("at"), F.lit(lang).alias("lang")) for i, (lang, h) in enumerate(hits.items())])))
    best, second = ordered[0], ordered[1]["n"]
    total = sum(list(hits.values())[1:], list(hits.values())[0])
    mixed = (second > 0) & (second >= best["n"] * 0.65)
    share = F.greatest(F.least(F.lit(0.99), F.greatest(F.lit(0.35), best["n"] / F.greatest(F.lit(1), total))), F.least(F.lit(0.95), best["n"] / F.greatest(F.lit(6), n_words)))
    sure = F.bround(F.when(mixed, F.least(share, F.lit(0.75))).otherwise(share), 4)
    language = F.when(best["n"] >= 2, F.when((second > 0) & (second == best["n"]), F.lit(None)).otherwise(best["lang"])).when(total <= 0, "und")
    confidence = F.when(best["n"] >= 2, F.when((second > 0) & (second == best["n"]), 0.0).otherwise(sure)).when(total <= 0, 0.2).otherwise(0.0)
    return F.struct(language.alias("language"), confidence.alias("confidence"), mixed.alias("mixed"))


def script_counts(text: Column) -> dict[str, Column]:
    letters = F.regexp_replace(text, r"[^\p{L}]", "")
    return {s: F.regexp_count(letters, F.lit(c)) for s, c in SCRIPTS.items()}


def range_language(text: Column) -> Column:
    """Struct language, confidence by character ranges, two characters at least; null language else."""
    scored = F.array_sort(F.array(*[F.struct((-F.regexp_count(text, F.lit(c))).alias("n"), F.lit(i).alias("i"), F.lit(lang).alias("lang")) for i, (lang, c) in enumerate(RANGES.items())]))[0]
    return F.struct(F.when(scored["n"] <= -2, scored["lang"]).alias("language"), F.when(scored["n"] <= -2, F.least(F.lit(1.0), -scored["n"] / 4.0)).otherwise(0.0).alias("confidence"))


def reconciled(crawled: Column, crawled_confidence: Column, detected: Column, confidence: Column, mismatch_from: float = 0.65, trusted_from: float = 0.9) -> Column:
    """Struct language, mismatch, source: a sure detection overrules the crawler's language, an unsure one doesn't."""
    known = detected.isNotNull() & (detected != "und")
    mismatch = known & crawled.isNotNull() & (detected != crawled) & (confidence >= mismatch_from)
    language = F.when(mismatch, detected).when(crawled.isNotNull() & (crawled_confidence >= trusted_from), crawled).otherwise(F.coalesce(F.when(known, detected), crawled))
    return F.struct(language.alias("language"), mismatch.alias("mismatch"), F.when(language.isNull(), "none").when(mismatch, "detected").otherwise("crawler").alias("source"))


def normalized_code(code: Column) -> Column:
    """xx-YY to xx in lower case; no known language is null."""
    short = F.lower(F.trim(F.substring_index(F.replace(code, F.lit("_"), F.lit("-")), "-", 1)))
    return F.when(short.isin("", "unknown", "und", "none"), F.lit(None)).otherwise(short)


def inferred(text: Column, confidence: float = 0.65) -> Column:
    """Struct language, confidence without marker words: by character ranges, else by the script that most letters have; of several, the
    first of SCRIPTS. Latin and unknown scripts tell nothing, nor do null and empty texts."""
    t = F.coalesce(text, F.lit(""))
    ranged = range_language(t)
    counts = F.array(*[F.struct(n.alias("n"), F.lit(-i).alias("i"), F.lit(SCRIPT_LANGUAGE.get(s)).alias("language")) for i, (s, n) in enumerate(script_counts(t).items())])
    most = F.array_max(counts)
    known = (most["n"] > 0) & most["language"].isNotNull()
    language = F.coalesce(ranged["language"], F.when(known, most["language"]))
    return F.struct(language.alias("language"), F.when(ranged["language"].isNotNull(), ranged["confidence"]).when(known, confidence).otherwise(0.0).alias("confidence"))
