"""Column expressions over text. All run inside whole-stage code or Spark's own array functions; none calls Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
BOILERPLATE = "cookie cookies privacy subscribe subscription copyright login sign menu navigation footer share social terms conditions search contact newsletter".split()
CODE_MARKERS = ("{", "}", ";", "=>", "</", "def ", "class ")
MIN_CHARS, MAX_CHARS, SHORT_CHARS, MEDIUM_CHARS = 300, 200_000, 600, 1500
MIN_UNIQUE, MIN_ASCII, MAX_BOILERPLATE, BOILERPLATE_PENALTY_FROM = 60, 0.85, 0.65, 0.4
GOLD, SILVER, BRONZE, REJECT_CAP = 0.85, 0.65, 0.45, 0.25
TOKEN = r"[\p{L}\p{N}_]+"


def normalize_text(text: Column) -> Column:
    """Line ends to \\n, no control characters, single spaces, trimmed lines, at most one empty line in a row."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n")
    t = F.regexp_replace(t, r"[\x00-\x08\x0e-\x1f\x7f]", "")
    t = F.regexp_replace(t, r"[ \t\x0b\x0c]+", " ")
    t = F.regexp_replace(t, " ?\n ?", "\n")
    return F.regexp_replace(F.regexp_replace(t, r"^[ \n]+|[ \n]+$", ""), "\n{3,}", "\n\n")


def folded(text: Column) -> Column:
    """Single spaces, trimmed, lower case: the identity of short texts. A single space between words is passed over, not replaced."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\n\r\x0b\x0c]{2,}|[\t\n\r\x0b\x0c]", " ")))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TOKEN})"), 1)


def space_tokens(text: Column) -> Column:
    return F.filter(F.split(text, r"[ \t\n\r\x0b\x0c]+"), lambda x: x != "")


def ratio(part: Column, whole: Column) -> Column:
    """0 where there is no whole."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def ascii_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\x00-\x7F]", ""))


def occurrences(text: Column, needle: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(needle), F.lit("")))) / len(needle)).cast("long")


def code_ratio(text: Column) -> Column:
    """Code markers for each space-delimited token, 1 at most."""
    marks = sum((occurrences(text, m) for m in CODE_MARKERS[1:]), occurrences(text, CODE_MARKERS[0]))
    return F.least(F.lit(1.0), marks / F.greatest(F.lit(1), F.size(space_tokens(text))))


def repeats(words: Column) -> Column:
    """Tokens that equal the one before."""
    pairs = F.when(F.size(words) > 1, F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: a == b)).otherwise(F.array().cast("array<boolean>"))
    return F.size(F.filter(pairs, lambda same: same))


def boilerplate_ratio(words: Column) -> Column:
    return ratio(F.size(F.filter(words, lambda w: w.isin(BOILERPLATE))), F.size(words))


def quality_score(chars: Column, ascii_ratio: Column, control: Column, boilerplate: Column, unique: Column, repetition: Column, code: Column, confidence: Column, latin: Column) -> Column:
    """1 less penalties, between 0 and 1."""
    penalties = [
        (chars < SHORT_CHARS, 0.25),
        (chars < MEDIUM_CHARS, 0.1),
        (latin & (ascii_ratio < MIN_ASCII), 0.1),
        (control > 0.02, 0.1),
        (boilerplate > BOILERPLATE_PENALTY_FROM, 0.25),
        (unique < MIN_UNIQUE, 0.15),
        (repetition > 0.45, 0.15),
        (code > 0.35, 0.15),
        (confidence < 0.35, 0.1),
    ]
    score = F.lit(1.0)
    for when, cost in penalties:
        score = score - F.when(when, cost).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def reject_reason(chars: Column, boilerplate: Column, lang: Column) -> Column:
    """The first that holds, else null."""
    return (
        F.when(chars < MIN_CHARS, "text_too_short")
        .when(chars > MAX_CHARS, "text_too_long")
        .when((boilerplate > MAX_BOILERPLATE) & (chars < 3 * MIN_CHARS), "boilerplate_heavy")
        .when(lang.isNull() | (lang == ""), "language_missing")
    )


def bucket(score: Column, reason: Column) -> Column:
    return F.when(reason.isNotNull(), "reject").when(score >= GOLD, "gold").when(score >= SILVER, "silver").when(score >= BRONZE, "bronze").otherwise("reject")


def shingles(words: str, width: int) -> Column:
    """Distinct runs of ``width`` tokens of a column of tokens; fewer tokens are one shingle, none have none. A column's name is
    asked for, as an expression would be computed anew for each run."""
    run = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - width + 1)), lambda i: F.array_join(F.slice(words, i, width), " "))
    return F.when(F.size(words) > 0, F.array_distinct(run)).otherwise(F.array().cast("array<string>"))


def jaccard(left: Column, right: Column) -> Column:
    """Of sets as arrays: 1 if both are empty, 0 if one is."""
    both = F.size(F.array_intersect(left, right))
    union = F.size(left) + F.size(right) - both
    return F.when(union == 0, 1.0).otherwise(both / union)


def stable_id(prefix: str, *parts: Column) -> Column:
    """prefix_ and 16 hex digits of the SHA-256 of the parts, joined by 0x1F."""
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, 16))


def hash_fraction(key: Column) -> Column:
    """Between 0 and 1, from the first 64 bits of the key's SHA-256."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / float(0xFFFFFFFFFFFFFFFF)


def content_role(text: Column) -> Column:
    """Role of a document by its first heading or line."""
    head = F.lower(F.regexp_extract(text, r"^\s*#*\s*([^\n]{0,160})", 1))
    return F.when(head.rlike("licen[sc]e|copyright|terms"), "legal").when(head.rlike("readme|guide|tutorial|documentation"), "documentation").otherwise("content")
