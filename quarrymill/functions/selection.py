"""Reject reasons and scores of samples, as one expression each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
BLOCKED_USAGE = "blocked deny_training disallow_training metadata_only no-training no_training opt_out restricted".split()
PAIR_TASKS = ("image_text_retrieval", "audio_text_retrieval", "video_text_retrieval")
BENEFITS = {"caption": 0.4, "transcript": 0.35, "frame_ocr": 0.35, "summary": 0.25, "alt_text": 0.2, "surrounding": 0.2, "parent_text": 0.1, "full_payload": 0.1}
CAPTION_MARKERS = ("<img", "<div", "<a ", "</", "href=", "src=")


def blank(c: Column) -> Column:
    return F.coalesce(F.trim(c) == "", F.lit(True))


def usage_blocked(usage: Column) -> Column:
    return F.lower(F.coalesce(usage, F.lit(""))).isin(BLOCKED_USAGE)


def permission_reject(source_url: Column, domain: Column, robots: Column, usage: Column, allow_training: Column, license_name: Column, require_license: bool = True) -> Column:
    """Why the source's rules forbid a sample, the first reason that holds; null if none does."""
    licensed = F.coalesce(allow_training, F.lit(False)) & ~blank(license_name)
    out = F.when(blank(source_url), "no_source").when(blank(domain), "no_domain").when(robots == "disallowed", "robots_disallowed").when(usage_blocked(usage), "usage_rules_blocked")
    return out.when(~licensed, "license_missing") if require_license else out


def alignment_score(pair: Column, own: Column, quality: Column, pairability: Column, context: Column) -> Column:
    """Of a task on pairs the weakest of its scores, of another the strongest; between 0 and 1, four digits."""
    weakest, strongest = F.least(F.lit(1.0), quality, pairability, context), F.greatest(own, quality, context)
    return F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(pair, weakest).otherwise(strongest))), 4)


def language_allowed(language: Column, confidence: Column, accepted: list[str], least: float) -> Column:
    """``accepted`` empty: all languages are."""
    if not accepted:
        return F.lit(True)
    return F.coalesce(language.isin([x.lower() for x in accepted]), F.lit(False)) & (F.coalesce(confidence, F.lit(1.0)) >= least)


def pairability(**has: Column) -> Column:
    """Sum of what is there to pair a medium with text, 1 at most; names as in BENEFITS."""
    total = F.lit(0.0)
    for name, gain in BENEFITS.items():
        if name in has:
            total = total + F.when(has[name], gain).otherwise(0.0)
    return F.least(F.lit(1.0), total)


def caption_garbage(text: Column) -> Column:
    """Markup in place of a caption: a marker, two angle brackets, or a quarter of the tokens like attributes."""
    t = F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\n\r\x0b\x0c]+", " ")))
    words = F.split(t, " ")
    odd = F.size(F.filter(words, lambda w: w.startswith("<") | w.endswith(">") | w.contains("=") | w.isin("href", "src", "rel", "class", "type")))
    marked = F.lit(False)
    for m in CAPTION_MARKERS:
        marked = marked | t.contains(m)
    return (t != "") & (marked | (F.regexp_count(t, F.lit("[<>]")) >= 2) | (odd / F.size(words) >= 0.25))


def crawl_priority(depth: Column, seed: Column, quality: Column, gain: Column, seed_priority: int = 10, discovered: int = 50, depth_penalty: int = 5, quality_scale: float = 12.0, gain_scale: float = 6.0, noise_scale: float = 8.0, low_gain: float = 0.2, low_gain_penalty: int = 6, least: int = 0, most: int = 100) -> Column:
    """Lower comes first: depth and noise raise it, a host's quality and gain lower it; halves round to even."""
    p = F.when(seed, seed_priority).otherwise(discovered) + depth * depth_penalty
    p = p - F.bround(quality * quality_scale) - F.bround(gain * gain_scale) + F.bround((1 - quality) * noise_scale) + F.when(gain < low_gain, low_gain_penalty).otherwise(0)
    return F.greatest(F.lit(least), F.least(F.lit(most), p)).cast("long")


def retry_delay(attempt: Column, base: float = 1.0, multiplier: float = 2.0, most: float = 60.0) -> Column:
    """Seconds before the next attempt, without jitter."""
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(multiplier), attempt))


def relevance(page: Column, category: Column, n_bytes: Column) -> Column:
    """Of a payload by kind, category and size, between 0 and 1, three digits."""
    score = F.lit(0.5) + F.when(page, 0.1).otherwise(0.0)
    score = score + F.when(category == "documentation", 0.2).when(category == "academic", 0.25).when(category == "media", 0.1).when(category == "boilerplate", -0.3).otherwise(0.0)
    score = score - F.when(n_bytes < 512, 0.2).otherwise(0.0) + F.when(n_bytes > 20_000, 0.05).otherwise(0.0)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 3)
