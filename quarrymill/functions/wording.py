"""Headings, boundaries and identities of texts, as column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where a text may be cut, best first: fixed values.
BOUNDARIES = ("\n\n", "\n", ". ", "! ", "? ", "; ", ", ", " ")
FENCE = "```"
LEXICAL = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\n\x0B\f\r]"


def single_line(text: Column) -> Column:
    """One line without doubled spaces, case as it is; null where nothing is left."""
    t = F.trim(F.regexp_replace(text, r"[ \t\n\r\x0b\x0c]+", " "))
    return F.when(t != "", t)


def token_estimate(text: Column) -> Column:
    """Words and single other characters."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(LEXICAL))


def first_heading(text: Column, most: int = 160) -> Column:
    """The first line with more than #, without these; null if there is none."""
    h = F.rtrim(F.regexp_extract(F.coalesce(text, F.lit("")), r"^(?:[ \t\r]*#*[ \t\r]*\n)*[ \t\r]*#*[ \t\r]*([^\n]*)", 1))
    return F.when(h != "", F.substring(h, 1, most))


def code_blocks(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    return F.floor((F.length(t) - F.length(F.replace(t, F.lit(FENCE), F.lit("")))) / (2 * len(FENCE)))


def last_at(text: Column, needle: str) -> Column:
    """Characters before the last occurrence, -1 if there is none."""
    at = F.instr(F.reverse(text), needle[::-1])
    return F.when(at > 0, F.length(text) - at - len(needle) + 1).otherwise(-1)


def bound(value: Column, f) -> Column:
    """f(value) with the value computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def truncated(text: Column, most: int) -> Column:
    """At most ``most`` characters, without a code block that isn't closed, up to the best boundary in the second half, else the last space."""
    rtrim = lambda c: F.regexp_replace(c, r"[ \t\n\r\x0b\x0c]+$", "")

    def closed(cut: Column) -> Column:
        fence = last_at(cut, FENCE)
        odd = (((F.length(cut) - F.length(F.replace(cut, F.lit(FENCE), F.lit("")))) / len(FENCE)) % 2) == 1
        return F.when(odd & (fence > 0), rtrim(F.left(cut, fence))).otherwise(cut)

    def ended(cut: Column) -> Column:
        lowest = F.greatest(F.lit(1), F.least(F.length(cut) - 1, F.lit(int(most * 0.5))))
        end_after = lambda length: lambda at: F.when(at >= lowest, at + length)
        ends = [bound(last_at(cut, m), end_after(len(m.rstrip()))) for m in BOUNDARIES]
        space = last_at(F.regexp_replace(cut, r"[\t\n\r\x0b\x0c]", " "), " ")
        return rtrim(F.left(cut, F.coalesce(*ends, F.when(space >= 0, space), F.length(cut))))

    return F.when(F.length(text) <= most, text).otherwise(bound(bound(rtrim(F.substring(text, 1, most)), closed), ended))


def located(text: Column, evidence: Column) -> Column:
    """Characters before the evidence as it is, else in any case; null if it isn't there."""
    exact, folded = F.position(evidence, text), F.position(F.lower(evidence), F.lower(text))
    return F.when(exact > 0, exact - 1).when(folded > 0, folded - 1)


def joined_hyphens(text: Column) -> Column:
    """Text of a scan: words that a line end divides are whole again, spaces single, lines trimmed."""
    t = F.replace(F.replace(text, F.lit("ﬁ"), F.lit("fi")), F.lit("ﬂ"), F.lit("fl"))
    t = F.regexp_replace(t, r"(?<=[\p{L}\p{N}_])-[ \t\r\f\x0B]*\n[ \t\n\r\f\x0B]*(?=[\p{L}\p{N}_])", "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"[ \t]+", " "), " *\n *", "\n"), r"^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$", "")


def band_signals(hashes: Column, bands: int = 4) -> Column:
    """Of an array of distinct numbers the order statistics at equal steps, from the lowest; fewer numbers than bands give each."""
    ordered, n = F.array_sort(hashes), F.size(hashes)
    used = F.greatest(F.lit(1), F.least(F.lit(bands), n))
    picked = F.transform(F.sequence(F.lit(0), used - 1), lambda b: F.get(ordered, F.least(n - 1, F.floor(b * n / used).cast("int"))))
    return F.when(n > 0, picked).otherwise(F.array().cast("array<bigint>"))


def short_hash(text: Column) -> Column:
    """60 bits of the MD5."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def layout_hash(spans: Column) -> Column:
    """SHA-256 of the places and lengths of an array of texts."""
    return F.sha2(F.array_join(F.transform(spans, lambda s, i: F.concat(i.cast("string"), F.lit(":"), F.length(s).cast("string"))), "|"), 256)


def as_bool(value: Column) -> Column:
    """True or false as people write it; null for everything else."""
    v = F.lower(F.trim(value))
    return F.when(v.isin("1", "true", "yes", "y", "on"), True).when(v.isin("0", "false", "no", "n", "off"), False)


def clipped_box(box: Column, scale: float, left: float, top: float, width: float, height: float, flip: bool) -> Column:
    """A box (x0, y0, x1, y1) scaled, cut to a window, moved to its corner and mirrored; null if nothing is left."""
    x0, x1 = [F.least(F.greatest(box[c] * scale - left, F.lit(0.0)), F.lit(width)) for c in ("x0", "x1")]
    y0, y1 = [F.least(F.greatest(box[c] * scale - top, F.lit(0.0)), F.lit(height)) for c in ("y0", "y1")]
    a, b = (width - x1, width - x0) if flip else (x0, x1)
    return F.when((x1 > x0) & (y1 > y0), F.struct(a.alias("x0"), y0.alias("y0"), b.alias("x1"), y1.alias("y1")))


def clipped_interval(start: Column, end: Column, first: float, last: float, speed: float) -> Column:
    """An interval cut to a crop of time, moved to its start and sped up; null if nothing is left."""
    a, b = F.greatest(start, F.lit(first)), F.least(end, F.lit(last))
    return F.when(b > a, F.struct(((a - first) / speed).alias("start"), ((b - first) / speed).alias("end")))


def headings_in_order(headings: Column, text: Column) -> Column:
    """The headings that stand in the text, each sought behind the one before, and from the start if it isn't there; a place counts once.

    The state of the pass is the place behind the last heading, the places taken, and the headings kept. Empty and null headings are passed over;
    a null text has none. On Arrow batches: Spark's arrays are copied and looked through at each step of a fold, and its ``locate`` counts from the
    text's start each time, so that the time would grow with the square of a text.
    """

    @F.pandas_udf("array<string>")
    def run(lists: pd.Series, texts: pd.Series) -> pd.Series:
        def one(names: object, whole: str | None) -> list[str]:
            cursor, taken, kept = 0, set(), []
            for h in names if names is not None and whole else ():
                if h:
                    at = whole.find(h, cursor)
                    at = whole.find(h) if at < 0 else at
                    if at >= 0 and (at, len(h)) not in taken:
                        taken.add((at, len(h)))
                        kept.append(h)
                        cursor = at + len(h)
            return kept

        return pd.Series([one(a, b) for a, b in zip(lists, texts, strict=True)], dtype=object)

    return run(headings, F.when(F.size(headings) > 0, text))
