"""An index of the elements of HTML pages, from one parse of each, and what can be read from it with plain queries."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.sources.ship import ship

#: Elements deeper than this stand in the element at this depth.
MOST_DEPTH = 256
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: Blocks of markdown, elements that own images and sources, and elements that hold no text of a page.
BLOCKS = (*HEADINGS, "p", "li", "pre")
OWNERS = frozenset(["picture", "audio", "video"])
DROPPED = ("script", "style", "noscript", "template", "nav", "footer", "aside", "form")
#: Elements whose whole text the index has.
TEXTED = frozenset([*BLOCKS, "title", "a", "figure", "figcaption", "caption", "td", "th", "dt", "dd", "button", "option", "label"])
#: Of these, the ones whose text says what stands in them.
AROUND = frozenset([*BLOCKS, "figcaption", "caption", "td", "th", "dt", "dd"])
RAW = frozenset(["script", "style"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
#: What a start tag ends where the end tag was left out, and the elements that this doesn't reach beyond.
BLOCK_STARTS = frozenset("p div ul ol dl table section article main aside nav header footer form fieldset h1 h2 h3 h4 h5 h6 pre blockquote hr address details figure menu".split())
IMPLIED = {
    "p": (BLOCK_STARTS, frozenset(["button", "td", "th", "caption"])),
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th", "tr", "tbody", "tfoot"]), frozenset(["table"])),
    "th": (frozenset(["td", "th", "tr", "tbody", "tfoot"]), frozenset(["table"])),
    "tr": (frozenset(["tr", "tbody", "tfoot"]), frozenset(["table"])),
    "option": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "head": (frozenset(["body"]), frozenset()),
}
ENDED_BY = {start: tuple(t for t, (starts, _) in IMPLIED.items() if start in starts) for starts, _ in IMPLIED.values() for start in starts}

#: Comments and raw elements, which have no character references, or an ampersand with the reference that a semicolon ends.
REFERENCE = re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1|&(#[0-9]+;|#x[0-9a-f]+;|[a-z][a-z0-9]*;)?", re.IGNORECASE | re.DOTALL)

ELEMENT = "at int, parent int, last int, depth int, tag string, path string, owner int, figure int, block int, attributes map<string,string>, text string"


class ElementParser(HTMLParser):
    """Rows of ELEMENT, as lists; last and text are set when an element ends."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []
        self.open: list[int] = []
        self.count: dict[str, int] = {}
        self.texted: list[int] = []
        #: Open elements by what they are for those inside of them, and the sets that say so.
        self.nearest: tuple[tuple[frozenset[str], list[int]], ...] = ((OWNERS, []), (frozenset(["figure"]), []), (AROUND, []))
        self.words: dict[int, list[str]] = {}

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """A marked section ends at its first >, whatever its name."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def _end(self) -> str:
        row = self.rows[at := self.open.pop()]
        tag = row[4]
        self.count[tag] -= 1
        row[2] = len(self.rows) - 1
        if self.texted and self.texted[-1] == at:
            self.texted.pop()
        for _, held in self.nearest:
            if held and held[-1] == at:
                held.pop()
        return tag

    def _reach(self, tag: str, bounds: frozenset[str]) -> bool:
        """Whether such an element is open, with none of the bounds inside of it."""
        if not self.count.get(tag):
            return False
        if not any(self.count.get(b) for b in bounds):
            return True
        for at in reversed(self.open):
            if (t := self.rows[at][4]) == tag:
                return True
            if t in bounds:
                return False
        return False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]], single: bool = False) -> None:
        for ended in ENDED_BY.get(tag, ()):
            if self._reach(ended, IMPLIED[ended][1]):
                while self._end() != ended:
                    pass
        at, parent = len(self.rows), self.open[-1] if self.open else None
        path = f"{self.rows[parent][5]}/{tag}" if parent is not None else tag
        attributes: dict[str, str] = {}
        for name, value in attrs:
            attributes.setdefault(name, value or "")
        self.rows.append([at, parent, at, len(self.open), tag, path, *[held[-1] if held else None for _, held in self.nearest], attributes, None])
        if tag in TEXTED or tag in RAW:
            self.words[at] = []
        if tag not in VOID and not single and len(self.open) < MOST_DEPTH:
            self.open.append(at)
            self.count[tag] = self.count.get(tag, 0) + 1
            if tag in TEXTED:
                self.texted.append(at)
            for tags, held in self.nearest:
                if tag in tags:
                    held.append(at)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        """A slash closes what may stand alone in a page that is also XML; HTML's own elements stay open."""
        self.handle_starttag(tag, attrs, single=tag not in INLINE and tag not in BLOCK_STARTS)

    def handle_endtag(self, tag: str) -> None:
        if not self.count.get(tag):
            return
        if tag in INLINE:  # it doesn't end blocks that began inside of it
            for at in reversed(self.open):
                if (t := self.rows[at][4]) == tag:
                    break
                if t not in INLINE:
                    return
        elif not self._reach(tag, IMPLIED[tag][1] if tag in IMPLIED else frozenset()):
            return
        while self._end() != tag:
            pass

    def handle_data(self, data: str) -> None:
        if self.open and self.rows[self.open[-1]][4] in RAW:
            self.words[self.open[-1]].append(data)
        elif words := data.split():
            for at in self.texted:
                self.words[at] += words

    def result(self) -> list[list]:
        self.close()
        while self.open:
            self._end()
        for at, words in self.words.items():
            row = self.rows[at]
            row[-1] = "".join(words) if row[4] in RAW else " ".join(words)
        return self.rows


def unended_kept(html: str) -> str:
    """The page with the ampersands written out that begin no reference with a semicolon at its end; names that HTML doesn't have are none."""

    def kept(m: re.Match) -> str:
        name = m[2]
        return m[0] if m[0][0] == "<" or (name and (name[0] == "#" or name in html5)) else "&amp;" + m[0][1:]

    return REFERENCE.sub(kept, html)


#: Elements after which a task hands on what it has of a batch of pages.
HANDED = 4096


def element_rows(html: str | None, unended: bool) -> list[list]:
    """Rows of ELEMENT of one page."""
    if not html:
        return []
    parser = ElementParser()
    parser.feed(html if unended else unended_kept(html))
    return parser.result()


def elements(pages: DataFrame, html: str = "html", unended: bool = True) -> DataFrame:
    """A row for each element of each page, beside the page's other columns, in one parse of it, on Arrow batches of pages.

    ``at`` is its place in the page, ``parent`` the element around it, ``last`` the last one inside of it, so that descendants are the
    rows from at + 1 to last; ``path`` has the tags from the root; ``owner`` is the nearest picture, audio or video around it, ``figure`` the nearest figure, ``block`` the nearest of AROUND. ``text`` is the
    words of all that is inside, for elements of TEXTED, and the content of scripts and styles as it stands.

    A page that is null, empty or without a tag has no rows. End tags left out are implied as HTML says; those that nothing opened are passed
    over. Elements deeper than MOST_DEPTH stand in the element there. Repeated pages have rows each; page columns of the new names are
    replaced. As browsers do, references without a semicolon are decoded where HTML has such names (``&amp``), unless ``unended`` is false.
    """
    ship(pages.sparkSession)
    names = [x.split()[0] for x in ELEMENT.split(", ")]
    kept = [c for c in pages.columns if c != html and c not in names]
    rows = pages.select(*[pages[f"`{c}`"] for c in kept], pages[f"`{html}`"].alias("_page"))
    types = [pa.int32() if t == "int" else pa.string() if t == "string" else pa.map_(pa.string(), pa.string()) for _, t in (x.split() for x in ELEMENT.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed(batch: pa.RecordBatch, at: list[int], found: list[list]) -> pa.RecordBatch:
            page = batch.take(pa.array(at, pa.int64()))
            columns = [pa.array([list(x.items()) for x in v] if n == "attributes" else v, t) for n, t, v in zip(names, types, zip(*found, strict=True), strict=True)]
            return pa.RecordBatch.from_arrays([*page.columns[:-1], *columns], names=[*kept, *names])

        for batch in batches:
            at, found = [], []
            for i in range(batch.num_rows):
                of_page = element_rows(batch.column(batch.num_columns - 1)[i].as_py(), unended)
                at += [i] * len(of_page)
                found += of_page
                if len(found) >= HANDED:
                    yield handed(batch, at, found)
                    at, found = [], []
            if found:
                yield handed(batch, at, found)

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], *T.StructType.fromDDL(ELEMENT).fields]))


def within(path: Column, tags: tuple[str, ...]) -> Column:
    return path.rlike(f"(^|/)({'|'.join(tags)})(/|$)")


def titles(index: DataFrame) -> DataFrame:
    """The elements <title> in a page's head, or at its top."""
    return index.where((F.col("tag") == "title") & ~within(F.col("path"), ("svg", "body")))


def links(index: DataFrame) -> DataFrame:
    """Links with target, text, rel, and whether they ask not to be followed."""
    a = index.where(F.col("tag").isin("a", "area") & (F.trim(F.coalesce(F.col("attributes")["href"], F.lit(""))) != ""))
    rel = F.split(F.lower(F.trim(F.coalesce(F.col("attributes")["rel"], F.lit("")))), r"\s+")
    return a.withColumn("target", F.trim(F.col("attributes")["href"])).withColumn("rel", rel).withColumn("nofollow", F.array_contains("rel", "nofollow"))


def headings(index: DataFrame) -> DataFrame:
    """Headings with words, and their level."""
    h = index.where(F.col("tag").isin(*HEADINGS) & (F.col("text") != "") & ~within(F.col("path"), DROPPED))
    return h.withColumn("level", F.substring("tag", 2, 1).cast("int"))


def srcset(value: Column) -> Column:
    """Addresses of a list of candidates, each with what stands behind it (a width, a density or nothing)."""
    parts = F.filter(F.split(F.trim(F.coalesce(value, F.lit(""))), r",\s+|,$"), lambda x: F.trim(x) != "")
    return F.transform(parts, lambda x: F.struct(F.element_at(F.split(F.trim(x), r"\s+"), 1).alias("address"), F.coalesce(F.get(F.split(F.trim(x), r"\s+"), F.lit(1)), F.lit("")).alias("condition")))


#: Attributes with an address, and the kind of what stands there, by tag. A source has the kind of its owner.
REFERENCES = {"img": (("src", "data-src"), "image"), "audio": (("src",), "audio"), "video": (("src",), "video"), "embed": (("src",), "embed"), "object": (("data",), "embed"), "iframe": (("src",), "embed"), "track": (("src",), "track"), "source": (("src",), "")}


def references(index: DataFrame, *keys: str) -> DataFrame:
    """Media of a page: keys, at, kind, address, condition, owner; posters of videos are images. A source without an owner has the kind other.

    ``keys`` name a page; repeated pages of one name count once."""
    a = F.col("attributes")
    entry = lambda kind, address, condition="": F.struct(F.lit(kind).alias("kind") if isinstance(kind, str) else kind.alias("kind"), address.alias("address"), F.lit(condition).alias("condition"))
    of_owner = index.where(F.col("tag").isin(*OWNERS)).select(*keys, F.col("at").alias("owner"), F.when(F.col("tag") == "picture", "image").otherwise(F.col("tag")).alias("_kind")).distinct()
    held = index.where(F.col("tag").isin(*REFERENCES)).dropDuplicates([*keys, "at"]).join(of_owner, [*keys, "owner"], "left")
    kind = F.when(F.col("tag") == "source", F.coalesce("_kind", F.lit("other")))
    for tag, (_, name) in REFERENCES.items():
        kind = kind.when(F.col("tag") == tag, name) if name else kind
    image = F.when(F.col("tag") == "img", "image").otherwise(kind)
    single = [F.when(F.col("tag") == tag, entry(kind, a[name])) for tag, (names, _) in REFERENCES.items() for name in names]
    many = F.transform(srcset(a["srcset"]), lambda x: F.struct(image.alias("kind"), x["address"].alias("address"), x["condition"].alias("condition")))
    found = F.concat(F.array(*single, F.when(F.col("tag") == "video", entry("image", a["poster"]))), many)
    out = held.select(*keys, "at", "owner", F.explode(F.filter(found, lambda x: F.trim(F.coalesce(x["address"], F.lit(""))) != "")).alias("e"))
    return out.select(*keys, "at", "e.kind", F.trim("e.address").alias("address"), "e.condition", "owner")


def markdown(index: DataFrame, *keys: str, sections: tuple[str, ...] = ("main", "article")) -> DataFrame:
    """Keys, ``markdown``, ``headings`` (array) and ``n_code_blocks`` of each page's main section: the first element of the first of ``sections``
    that the page has, else its body, else the whole page.

    Headings, paragraphs, list items and preformatted blocks follow in page order; a block inside another one stands there, too, and once
    more by itself. What is in DROPPED elements is left out. Pages without any element have no row.
    """
    order = F.coalesce(*[F.when(F.col("tag") == s, i) for i, s in enumerate((*sections, "body"))])
    sized = index.where(order.isNotNull() & ~within(F.col("path"), DROPPED)).groupBy(*keys).agg(F.min(F.struct(order.alias("o"), F.col("at"), F.col("last"))).alias("s"))
    blocks = index.where(F.col("tag").isin(*BLOCKS) | F.col("parent").isNull())
    joined = blocks.join(sized, list(keys), "left").where("s is null or at between s.at and s.last or parent is null")
    inside = F.col("tag").isin(*BLOCKS) & F.coalesce(F.col("at").between(F.col("s.at"), F.col("s.last")), F.lit(True)) & (F.col("text") != "") & ~within(F.col("path"), DROPPED)
    block = F.when(F.col("tag").isin(*HEADINGS), F.concat(F.repeat(F.lit("#"), F.substring("tag", 2, 1).cast("int")), F.lit(" "), F.col("text"))).when(F.col("tag") == "pre", F.concat(F.lit("```\n"), F.col("text"), F.lit("\n```"))).otherwise(F.col("text"))
    held = joined.groupBy(*keys).agg(F.array_sort(F.collect_list(F.when(inside, F.struct("at", "tag", "text", block.alias("block"))))).alias("b"))
    texts = lambda rows, field: F.transform(rows, lambda x: x[field])
    heads = F.filter("b", lambda x: x["tag"].isin(*HEADINGS))
    return held.select(*keys, F.array_join(texts(F.col("b"), "block"), "\n\n").alias("markdown"), texts(heads, "text").alias("headings"), F.size(F.filter("b", lambda x: x["tag"] == "pre")).cast("long").alias("n_code_blocks"))


def link_context(index: DataFrame, *keys: str, words: int = 12) -> DataFrame:
    """Links with the heading before them and the first words of the block around them."""
    by_page = Window.partitionBy(*keys).orderBy("at")
    marked = index.where(F.col("tag").isin("a", *BLOCKS))
    marked = marked.withColumn("heading", F.last(F.when(F.col("tag").isin(*HEADINGS), F.col("text")), ignorenulls=True).over(by_page))
    around = F.last(F.when(F.col("tag").isin(*BLOCKS), F.struct("at", "last", "text")), ignorenulls=True).over(by_page)
    found = links(marked.withColumn("_block", around))
    block = F.when(F.col("_block.last") >= F.col("at"), F.array_join(F.slice(F.split("_block.text", " "), 1, words), " "))
    return found.select(*keys, "at", "target", F.col("text"), F.coalesce("heading", F.lit("")).alias("heading"), F.coalesce(block, F.lit("")).alias("context"), "nofollow")
