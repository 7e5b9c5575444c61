"""Media that pages refer to, with what the page says about them: kinds, contexts and scores, from the element index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.functions import url
from quarrymill.operators import elements

# Fixed values.
SINGLE = {
    "img": "src data-src data-lazy-src data-original data-image data-url data-hi-res-src",
    "audio": "src data-src", "video": "src data-src", "source": "src data-src", "track": "src", "embed": "src data-src", "iframe": "src data-src", "object": "data", "a": "href",
}
SRCSETS = ("srcset", "data-srcset")
SKIPPED_RELS = "canonical dns-prefetch manifest modulepreload preconnect".split()
ICON_RELS = "icon apple-touch-icon apple-touch-icon-precomposed image_src".split()
FEED_TYPES = "application/rss+xml application/atom+xml application/xml text/xml".split()
ASIDE_TYPES = "application/javascript application/x-javascript text/javascript text/css text/x-scss text/x-less".split()
META_KEYS = {
    "image": "og:image og:image:url twitter:image twitter:image:src",
    "video": "og:video og:video:url og:video:secure_url twitter:player twitter:player:stream",
    "audio": "og:audio og:audio:url",
}
DECORATIVE = "logo icon sprite tracking pixel spacer beacon".split()
GAINS = {"caption": 30, "alt": 20, "surrounding": 15, "duration": 10, "mime_hint": 5, "decorative": -50}
LEAST_BOOST, MOST_BOOST = -50, 80
YOUTUBE = "youtube.com www.youtube.com m.youtube.com youtube-nocookie.com www.youtube-nocookie.com".split()
VIMEO = "vimeo.com www.vimeo.com player.vimeo.com".split()
NASA_PLUS = "plus.nasa.gov"
INLINE_EXTENSIONS = "mp4|webm|mov|m4v|m3u8|mp3|m4a|wav|aac|flac|ogg|opus|vtt|srt|ttml|pdf|docx?|pptx?|xlsx?|csv|tsv"

INLINE = rf"""(["'])((?:(?:https?:)?//|/|[A-Za-z0-9_.-]+/)[^"'<>\\\s]+?\.(?:{INLINE_EXTENSIONS})(?:\?[^"'<>\\\s]*)?)\1"""
BACKGROUND = r"""(?i)background(?:-image)?\s*:\s*url\(\s*(?:'([^']*)'|"([^"]*)"|([^'")]*))\s*\)"""
#: Kinds of what scripts name and url.KINDS doesn't.
INLINE_KINDS = {"video": "m3u8", "audio": "opus", "track": "vtt srt ttml", "document": "csv tsv"}


def stripped(c: Column) -> Column:
    """Single spaces and trimmed; null if nothing is left."""
    t = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    return F.when(t != "", t)


def rels(value: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(value, F.lit(""))), r"\s+"), lambda r: r != "")


def kind_of_address(address: Column) -> Column:
    """By the extension of the path; null if none is known."""
    ext = F.lower(F.regexp_extract(F.regexp_extract(address, r"^([^?#]*)", 1), r"\.([A-Za-z0-9]{2,5})$", 1))
    out = F.when(F.lit(False), "")
    for kinds in (url.KINDS, INLINE_KINDS):
        for name, extensions in kinds.items():
            out = out.when(ext.isin(extensions.split()), name)
    return out


def kind_of_type(mime: Column) -> Column:
    """By a MIME type in lower case; null if it names no medium."""
    return F.when(mime.startswith("image/"), "image").when(mime.startswith("audio/"), "audio").when(mime.startswith("video/"), "video").when(mime.isin("application/pdf", "application/msword") | mime.startswith("application/vnd."), "document")


def link_kind(rel: Column, mime: Column, preload: Column, icons: bool = False) -> Column:
    """What a link element in the head refers to: image, audio, video, document, feed, or null for what is no asset.

    ``rel`` has the tokens. A type decides first, then icons (only if asked for), preloads by what they are loaded as, and
    alternates, which without a known type are feeds. Styles, scripts, fonts and SVG images are no assets.
    """
    t, has = F.lower(F.trim(F.coalesce(mime, F.lit("")))), lambda *names: F.arrays_overlap(rel, F.array(*[F.lit(n) for n in names]))
    media, iconlike = kind_of_type(t), F.lit(icons)
    shown = F.when(t != "image/svg+xml", F.when(iconlike | ~has("icon", "image_src"), "image"))
    loaded = F.lower(F.coalesce(preload, F.lit("")))
    return (
        F.when((F.size(rel) == 0) | has(*SKIPPED_RELS) | t.contains("oembed"), F.lit(None).cast("string"))
        .when(t.startswith("image/"), shown)
        .when(media.isin("audio", "video"), media)
        .when(t.isin(ASIDE_TYPES) | t.startswith("font/"), None)
        .when(t.isin(FEED_TYPES), "feed")
        .when(has(*ICON_RELS), F.when(iconlike, "image"))
        .when(has("stylesheet"), None)
        .when(has("preload"), F.when(loaded.isin("image", "audio", "video"), loaded))
        .when(has("alternate", "enclosure"), F.coalesce(media, F.when(t.isin("text/html", "application/xhtml+xml", "text/plain"), "page"), F.lit("feed")))
    )


def meta_kind(*names: Column) -> Column:
    out = F.when(F.lit(False), "")
    for kind, keys in META_KEYS.items():
        hit = [F.lower(F.trim(F.coalesce(n, F.lit("")))).isin(keys.split()) for n in names]
        out = out.when(hit[0] if len(hit) == 1 else hit[0] | hit[1], kind)
    return out


def video_embed(address: Column) -> Column:
    """Whether a URL is the player of a known host; an image of that host is none, nor is a video file."""
    whole = F.when(F.startswith(address, F.lit("//")), F.concat(F.lit("https:"), address)).otherwise(address)
    host, path = F.lower(url.part(whole, 2)), url.part(whole, 3)
    asked = F.exists(url.parameters(whole), lambda p: p.rlike("^v=."))
    known = (host.isin(YOUTUBE) & path.isin("/embed", "/embed/", "/watch", "/v/") & asked) | (host.isin(VIMEO) & path.rlike("^/[0-9]+$")) | ((host == NASA_PLUS) & path.startswith("/watch/"))
    return F.coalesce(known & ~F.coalesce(kind_of_address(path) == "image", F.lit(False)), F.lit(False))


def backgrounds(style: Column) -> Column:
    """Addresses of background images in a style attribute."""
    found = [F.regexp_extract_all(F.coalesce(style, F.lit("")), F.lit(BACKGROUND), i) for i in (1, 2, 3)]
    return F.filter(F.transform(F.arrays_zip(*[f.alias(n) for f, n in zip(found, "abc", strict=True)]), lambda x: F.trim(F.concat(x["a"], x["b"], x["c"]))), lambda x: x != "")


def inline_media(script: Column) -> Column:
    """Distinct quoted addresses of media files in a script, in order."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(script, F.lit("")), F.lit("(?i)" + INLINE), 2))


def decorative(address: Column) -> Column:
    """Whether the path or the query has a word of DECORATIVE."""
    path, query = F.lower(F.regexp_extract(address, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)), F.lower(F.regexp_extract(address, r"\?([^#]*)", 1))
    return F.arrays_overlap(F.concat(F.split(path, "[/._-]"), F.split(query, "[&=]")), F.array(*[F.lit(d) for d in DECORATIVE]))


def asset_score(**has: Column) -> Column:
    """Sum of the gains of what is there, by the names of GAINS."""
    total = F.lit(0)
    for name, gain in GAINS.items():
        if name in has:
            total = total + F.when(has[name], gain).otherwise(0)
    return total.cast("double")


def boost(score: Column) -> Column:
    """The score as a whole number within its bounds, halves to even."""
    return F.bround(F.greatest(F.lit(float(LEAST_BOOST)), F.least(F.lit(float(MOST_BOOST)), score))).cast("int")


def entries(icons: bool) -> Column:
    """All that one element refers to: array of kind, attribute, address, condition. Needs the index's columns and _owner."""
    a, tag = F.col("attributes"), F.col("tag")
    one = lambda kind, name, address, condition=F.lit(""): F.struct(kind.alias("kind"), F.lit(name).alias("attribute"), address.alias("address"), condition.alias("condition"))
    of_source = F.when(F.col("_owner") == "picture", "image").otherwise(F.coalesce("_owner", kind_of_type(F.lower(F.coalesce(a["type"], F.lit(""))))))
    plain = F.when(tag == "img", "image").when(tag.isin("audio", "video", "track"), tag).when(tag == "source", of_source)
    single = []
    for name in sorted({n for names in SINGLE.values() for n in names.split()}):
        tags = [t for t, names in SINGLE.items() if name in names.split()]
        embedded = F.when(video_embed(a[name]), "video").otherwise(F.coalesce(kind_of_address(a[name]), F.lit("embed")))
        kind = F.coalesce(F.when(tag.isin("embed", "iframe", "object"), embedded).when(tag == "a", kind_of_address(a[name])).otherwise(plain), F.when(tag == "source", kind_of_address(a[name])))
        single.append(F.when(tag.isin(tags), one(kind, name, a[name])))
    single.append(F.when(tag == "video", one(F.lit("image"), "poster", a["poster"])))
    single.append(F.when(tag == "meta", one(meta_kind(a["property"], a["name"]), "content", a["content"])))
    single.append(F.when(tag == "link", one(link_kind(rels(a["rel"]), a["type"], a["as"], icons), "href", a["href"])))
    of_set = lambda name: F.transform(elements.srcset(a[name]), lambda x: one(F.lit("image"), name, x["address"], x["condition"]))
    many = [F.when(tag.isin("img", "source"), of_set(name)) for name in SRCSETS]
    many.append(F.when(a["style"].isNotNull(), F.transform(backgrounds(a["style"]), lambda x: one(F.lit("image"), "style", x))))
    many.append(F.when(tag == "script", F.transform(inline_media(F.col("text")), lambda x: one(kind_of_address(x), "text", x))))
    none = F.array().cast("array<struct<kind:string,attribute:string,address:string,condition:string>>")
    return F.filter(F.concat(F.array(*single), *[F.coalesce(m, none) for m in many]), lambda e: e["kind"].isNotNull() & (F.trim(F.coalesce(e["address"], F.lit(""))) != ""))


def asset_candidates(index: DataFrame, *keys: str, base: str | None = None, icons: bool = False) -> DataFrame:
    """The media that pages refer to: keys, at, tag, attribute, kind, address, condition, alt, caption, surrounding, mime_hint, duration,
    embed, score, boost.

    ``keys`` name a page and must not be null; elements of repeated pages of one name count once. ``base`` is a column with the page's URL: addresses
    become whole URLs, and those that can't are left out; without it they stay as written. The caption is that of the nearest
    figure; ``surrounding`` is the text of the nearest figure, else of the nearest block. Text, alt and type that are blank are null, and so are durations that are
    no number above 0. An embed is a player of a known host. Pages without media have no rows; a page that names an address twice has both.

    One shuffle, by page, of the elements concerned alone: the windows over figures, blocks and owners find the page's elements together.
    """
    of_page = [F.col(f"`{k}`") for k in keys]
    held = index.where(F.exists(F.array(*[F.lit(t) for t in sorted({*SINGLE, *elements.OWNERS, *elements.AROUND, "figure", "meta", "link", "script"})]), lambda t: t == F.col("tag")) | F.col("attributes").getItem("style").isNotNull())
    held = held.select(*keys, *([base] if base and base not in keys else []), "at", "tag", "owner", "figure", "block", "attributes", "text").repartition(*of_page).dropDuplicates([*keys, "at"])
    own = lambda of, tags: F.when(F.col("tag").isin(sorted(tags)), F.col("at")).otherwise(F.col(of))
    group = lambda name: Window.partitionBy(*of_page, name)
    text_of = lambda name: F.max(F.when(F.col("at") == F.col(name), F.col("text"))).over(group(name))
    held = held.withColumns({"_f": own("figure", ["figure"]), "_b": own("block", elements.AROUND), "_o": own("owner", elements.OWNERS)})
    held = held.withColumns({"_owner": F.max(F.when(F.col("at") == F.col("_o"), F.col("tag"))).over(group("_o")), "_figure": text_of("_f")})
    held = held.withColumn("caption", F.when(F.col("_f").isNotNull(), F.min_by(F.when(F.col("tag") == "figcaption", F.col("text")), F.when(F.col("tag") == "figcaption", F.col("at"))).over(group("_f"))))
    held = held.withColumn("_block", text_of("_b"))
    a = F.col("attributes")
    # Rows of outer explodes are filtered behind them: Spark would ask for the size of the array before it, and compute it twice.
    out = held.where(F.col("tag").isin(*SINGLE, "meta", "link", "script") | a["style"].isNotNull())
    out = out.withColumn("e", F.explode_outer(entries(icons))).where("e is not null").withColumn("address", F.trim("e.address"))
    if base:
        out = out.withColumn("_whole", F.explode_outer(F.array(url.resolved(F.col(f"`{base}`"), F.col("address"))))).where("_whole is not null").withColumn("address", F.col("_whole"))
    seconds = F.coalesce(a["duration"].try_cast("double"), a["data-duration"].try_cast("double"))
    out = out.select(
        *keys, "at", "tag", F.col("e.attribute").alias("attribute"), F.col("e.kind").alias("kind"), "address", F.col("e.condition").alias("condition"), stripped(a["alt"]).alias("alt"),
        F.when(F.col("tag") == "img", stripped(F.col("caption"))).alias("caption"), F.coalesce(stripped(F.col("_figure")), stripped(F.col("_block"))).alias("surrounding"),
        stripped(a["type"]).alias("mime_hint"), F.when(seconds > 0, seconds).alias("duration"), video_embed(F.col("address")).alias("embed"),
    )
    there = {name: F.col(name).isNotNull() for name in ("caption", "alt", "surrounding", "mime_hint")}
    timed = F.col("kind").isin("audio", "video") & F.col("duration").isNotNull()
    out = out.withColumn("score", asset_score(**there, duration=timed, decorative=decorative(F.col("address"))))
    return out.withColumn("boost", boost(F.col("score")))


def best_candidates(candidates: DataFrame, *keys: str) -> DataFrame:
    """One row for each address of a page: kind, score and place of its best candidate (of several, the first), and how many there were."""
    best = F.max_by(F.struct("kind", "tag", "at", "score", "boost"), F.struct(F.col("score"), -F.col("at"), F.col("kind")))
    return candidates.groupBy(*keys, "address").agg(best.alias("b"), F.count("*").alias("n")).select(*keys, "address", "b.*", "n")
