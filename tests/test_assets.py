"""Media of pages with their contexts, kinds and scores."""

import pytest
from pyspark.sql import functions as F

from quarrymill.operators import assets, elements

PAGE = r"""<html><head><meta property="og:image" content="/o.jpg"><meta name="twitter:player" content="https://vimeo.com/12"><meta name="author" content="x.jpg">
<link rel="icon" href="/f.ico"><link rel="alternate" type="application/rss+xml" href="/feed"><link rel=canonical href="/c"><link rel="preload" as="video" href="/l.bin">
<script>var p = {"a": "/m/clip.M3U8?x=1", 'b': '/m/clip.M3U8?x=1', c: "no.pdf", d: "f/t.vtt"};</script></head><body>
<figure><img src="a-logo.png" alt="A  b"><figure><img src="i.jpg"><figcaption>Inner</figcaption></figure><figcaption>Outer text</figcaption></figure>
<p>words <img src="/b.gif?kind=Pixel" data-srcset="s.webp 1x, t.webp 2x" alt=" "></p><div style="background-image: URL('bg one.png'); color: red"></div>
<video src="v.mp4" duration="3.5" poster="p.jpg"><source src="w.bin" type="video/webm"></video><audio src="x.mp3" data-duration="soon"></audio>
<iframe src="//www.youtube.com/embed/?v=k"></iframe><iframe src="https://www.youtube.com/embed/k"></iframe><iframe src="https://player.vimeo.com/9.png"></iframe>
<a href="/d.PDF#p2" type="application/pdf">Doc</a><a href="/page">Page</a><source src="lost.flac"><object data="javascript:x.pdf"></object></body></html>"""


def candidates(spark, pages, **options):
    table = spark.createDataFrame(pages, "page_id int, url string, html string")
    return assets.asset_candidates(elements.elements(table), "page_id", **options)


def test_candidates(spark):
    rows = candidates(spark, [(1, "http://h.org/q/w", PAGE), (1, "http://h.org/q/w", PAGE), (2, "", None), (3, None, ""), (4, "u", "<p>none</p>")]).collect()
    assert {r["page_id"] for r in rows} == {1}
    found = sorted((r["kind"], r["attribute"], r["address"], r["condition"]) for r in rows)
    assert found == sorted([
        ("image", "content", "/o.jpg", ""), ("video", "content", "https://vimeo.com/12", ""), ("feed", "href", "/feed", ""), ("video", "href", "/l.bin", ""),
        ("video", "text", "/m/clip.M3U8?x=1", ""), ("track", "text", "f/t.vtt", ""), ("image", "src", "a-logo.png", ""), ("image", "src", "i.jpg", ""),
        ("image", "src", "/b.gif?kind=Pixel", ""), ("image", "data-srcset", "s.webp", "1x"), ("image", "data-srcset", "t.webp", "2x"), ("image", "style", "bg one.png", ""),
        ("video", "src", "v.mp4", ""), ("image", "poster", "p.jpg", ""), ("video", "src", "w.bin", ""), ("audio", "src", "x.mp3", ""),
        ("video", "src", "//www.youtube.com/embed/?v=k", ""), ("embed", "src", "https://www.youtube.com/embed/k", ""), ("image", "src", "https://player.vimeo.com/9.png", ""),
        ("document", "href", "/d.PDF#p2", ""), ("audio", "src", "lost.flac", ""), ("document", "data", "javascript:x.pdf", ""),
    ])
    by = {r["address"]: r for r in rows}
    told = lambda a: (by[a]["caption"], by[a]["alt"], by[a]["surrounding"], by[a]["score"], by[a]["boost"])
    assert told("a-logo.png") == ("Outer text", "A b", "Inner Outer text", 15.0, 15)
    assert told("i.jpg") == ("Inner", None, "Inner", 45.0, 45)
    assert told("/b.gif?kind=Pixel") == (None, None, "words", -35.0, -35)
    assert told("v.mp4")[3] == 10.0 and told("p.jpg")[3] == 0.0 and told("x.mp3")[3] == 0.0 and told("/d.PDF#p2")[3] == 5.0
    assert [by[a]["embed"] for a in ("//www.youtube.com/embed/?v=k", "https://www.youtube.com/embed/k", "https://vimeo.com/12")] == [True, False, True]
    assert by["v.mp4"]["duration"] == 3.5 and by["x.mp3"]["duration"] is None


def test_whole_urls_icons_and_best(spark):
    page = '<link rel="icon" href="/i.png"><img src="r.png"><img src="../q/r.png" alt=x><img src="data:image/png;base64,AA"><img src="#f"><script></script>'
    found = candidates(spark, [(1, "http://h.org/q/w", page)], base="url", icons=True)
    assert sorted(r["address"] for r in found.collect()) == ["http://h.org/i.png", "http://h.org/q/r.png", "http://h.org/q/r.png"]
    best = {r["address"]: (r["score"], r["n"]) for r in assets.best_candidates(found, "page_id").collect()}
    assert best == {"http://h.org/i.png": (-0.0 + 0, 1), "http://h.org/q/r.png": (20.0, 2)}


@pytest.mark.parametrize(
    ("rel", "mime", "preload", "icons", "kind"),
    [
        ("", "image/png", None, False, None), (None, None, None, False, None), ("canonical alternate", "video/mp4", None, False, None), ("alternate", "application/json+oembed", None, False, None),
        ("icon", "image/png", None, False, None), ("icon", "image/png", None, True, "image"), ("icon", "image/svg+xml", None, True, None), ("Apple-Touch-Icon", None, None, True, "image"),
        ("enclosure", "AUDIO/mpeg", None, False, "audio"), ("stylesheet", "text/css", None, False, None), ("stylesheet", None, None, False, None), ("preload", "font/woff2", "font", False, None),
        ("preload", None, "Image", False, "image"), ("preload", None, None, False, None), ("alternate", None, None, False, "feed"), ("alternate", "text/html", None, False, "page"), ("next", None, None, False, None),
    ],
)
def test_link_kind(spark, rel, mime, preload, icons, kind):
    row = spark.range(1).select(assets.link_kind(assets.rels(F.lit(rel).cast("string")), F.lit(mime).cast("string"), F.lit(preload).cast("string"), icons).alias("k")).first()
    assert row["k"] == kind


def test_boost_is_bounded(spark):
    rows = spark.createDataFrame([(-90.0,), (90.0,), (2.5,), (3.5,)], "s double").select(assets.boost(F.col("s"))).collect()
    assert [r[0] for r in rows] == [-50, 80, 2, 4]


def test_costly_columns_are_computed_once(spark):
    """Neither what an element refers to nor whole URLs are computed a second time, for a filter."""
    df = candidates(spark, [(1, "http://h.org/q/w", PAGE)], base="url")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Filter")]
    assert filters and not any("transform(" in line or "regexp_extract" in line for line in filters)


def test_pages_in_batches_keep_their_columns(spark):
    """Pages with more elements than a task hands on at once, and repeated ones beside empty ones, all in one batch."""
    many = "<p style='x'>a</p>" * (elements.HANDED + 5)
    pages = [(1, "u", many), (2, None, None), (3, "v", "<b>x</b>"), (3, "v", "<b>x</b>"), (4, "w", "")]
    found = elements.elements(spark.createDataFrame(pages, "page_id int, url string, html string").coalesce(1))
    assert found.columns[:2] == ["page_id", "url"]
    assert {(r["page_id"], r["url"], r["tag"]): r["count"] for r in found.groupBy("page_id", "url", "tag").count().collect()} == {(1, "u", "p"): elements.HANDED + 5, (3, "v", "b"): 2}
    assert found.where("page_id = 1").agg(F.max("at"), F.min(F.col("attributes")["style"]), F.min("text")).first()[:] == (elements.HANDED + 4, "x", "a")
