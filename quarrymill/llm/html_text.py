"""The main text of web pages by the distribution of text over their lines."""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import map_batches, packed, unpacked

#: Elements whose content is no markup, and comments, declarations and CDATA.
RAW = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:script|style|noscript|template|textarea|title|iframe|svg|math|object|select)(?![\w:-])(?:[^>]*[\s\"'])?/>"
    r"|<(script|style|noscript|template|textarea|title|iframe|svg|math|object|select)(?![\w:-])[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(/?)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.S | re.I)
#: Elements that don't end a line.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no part of an article.
OUTSIDE = frozenset("nav footer aside form button dialog menu head fieldset".split())
ARTICLE = frozenset("article main".split())
#: Names in a class, id or role that mark a block as no part of an article, and those of reader comments.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu sidebar widget breadcrumb breadcrumbs footer header masthead "
    "cookie cookies consent notice notices alert popup modal overlay subscribe subscription newsletter signup login share sharing social related recommended "
    "form search pagination pager toolbar skip contentinfo complementary dialog".split()
)
COMMENTS = frozenset("comment comments commentlist reply replies respond response responses disqus discussion".split())
#: Other parts that a marked name may have, as in site-footer or comment-list; any other part makes it another word, as social in social-science.
COMMON = frozenset(
    "site page main global top bottom left right primary secondary sub article post entry user reader list area wrap wrapper container outer inner box block blocks section bar item items row col column columns "
    "panel links link posts articles stories icons buttons button slot unit text title body content thread count form policy js the".split()
)
#: Elements that never hold the page's text, even if it is most of it; a wrapper with <main> in it is kept all the same.
NEVER = OUTSIDE - {"form", "fieldset"}
#: Elements whose end tag may be left out: what start tags end them, and the elements that these don't reach beyond.
IMPLIED = {
    "p": (frozenset("p div ul ol dl table section article main aside nav header footer form fieldset h1 h2 h3 h4 h5 h6 pre blockquote hr address details figure figcaption menu dialog".split()), frozenset("button td th caption".split())),
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "td": (frozenset("td th tr tbody tfoot".split()), frozenset(["table"])),
    "th": (frozenset("td th tr tbody tfoot".split()), frozenset(["table"])),
    "tr": (frozenset("tr tbody tfoot".split()), frozenset(["table"])),
    "head": (frozenset("body header nav main article section div p".split()), frozenset()),
}
ENDS = {start: tuple(tag for tag, (starts, _) in IMPLIED.items() if start in starts) for starts, _ in IMPLIED.values() for start in starts}
#: Lines summed together, and the score of a window at a surge on a page with much text.
WINDOW, SURGE = 3, 80
#: Of several articles, those with less than this part of the largest text are teasers.
SHARE = 8


def marked(name: str) -> str:
    """comment or mark, if a name of a class, id or role says so, else an empty string."""
    parts = [x for x in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if x]
    for kind, words in (("comment", COMMENTS), ("mark", MARKS)):
        if not words.isdisjoint(parts) and all(x in words or x in MARKS or x in COMMENTS or x in COMMON and len(parts) > 1 for x in parts):
            return kind
    return ""


def is_outside(tag: str, attributes: str, in_article: bool) -> str:
    """Why the element is no part of an article: hidden, its kind of element, a comment, a mark, or an empty string.

    Inside an article an id marks comments alone, as its sections are named by what they are about."""
    found = set()
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        low = value.lower()
        if name == "hidden" or name == "aria-hidden" and low == "true" or name == "style" and re.search(r"display\s*:\s*none", low):
            return "hidden"
        if name in ("class", "id", "role") and tag not in ("body", "html", *ARTICLE):
            kinds = {marked(x) for x in value.split()}
            found |= kinds - {"mark"} if name == "id" and in_article else kinds
    if "comment" in found:
        return "comment"
    if tag in OUTSIDE or tag == "header" and not in_article:
        return "element"
    return "mark" if "mark" in found else ""


def ends_of(tags: list[tuple[int, int, bool, str, str, bool]]) -> list[int]:
    """For each start tag the index of the first tag after its element. An end tag that is left out is implied by the end of
    the elements around it, or by a start tag that ends p, li and their like."""
    ends, stack = [i + 1 for i in range(len(tags))], []
    count: dict[str, int] = {}

    def pop(until: str, end: int) -> None:
        while True:
            tag, i = stack.pop()
            count[tag] -= 1
            ends[i] = end + 1 if tag == until and tags[end][2] and tags[end][3] == tag else end
            if tag == until:
                return

    def reached(tag: str) -> bool:
        """Whether one is open, with none of what it doesn't reach beyond above it."""
        if not count.get(tag):
            return False
        bounds = IMPLIED[tag][1] if tag in IMPLIED else ()
        if not any(count.get(x) for x in bounds):
            return True
        for open_tag, _ in reversed(stack):
            if open_tag == tag:
                return True
            if open_tag in bounds:
                return False
        return False

    for k, (_, _, closing, tag, _, single) in enumerate(tags):
        if tag in INLINE or tag in VOID and tag != "hr":
            continue
        if closing:
            if reached(tag):
                pop(tag, k)
            continue
        for ended in ENDS.get(tag, ()):
            if reached(ended):
                pop(ended, k)
        if not single and tag not in VOID:
            stack.append((tag, k))
            count[tag] = count.get(tag, 0) + 1
    for _, i in stack:
        ends[i] = len(tags)
    return ends


def lines_of(page: str) -> list[tuple[str, int, int, int]]:
    """The page's lines without markup: text, its characters outside links and in links, and the number of the article or main
    element in which it stands, 0 for none.

    What stands in other elements than the article's leaves an empty line, which divides the text around it. A form or a block
    with a mark in its class, id or role is not left out if it holds <main>, half of the text of all articles, or, on a page
    without any, half of the page's text outside links. Comments are left out however long, unless they hold <main>.
    """
    out: list[tuple[str, int, int, int]] = []
    text: list[str] = []
    plain = linked_chars = links = articles = region = 0

    def flush() -> None:
        nonlocal plain, linked_chars
        line = " ".join(html.unescape("".join(text)).split())
        if line:
            out.append((line, plain, linked_chars, region if articles else 0))
        text.clear()
        plain = linked_chars = 0

    def take(part: str) -> None:
        nonlocal plain, linked_chars
        if part:
            text.append(part)
            n = len(part.strip())
            if links:
                linked_chars += n
            else:
                plain += n

    page = RAW.sub(" ", page)
    tags = [(m.start(), m.end(), bool(m[1]), m[2].lower(), m[3], bool(m[4]) or m[3].endswith("/")) for m in TAG.finditer(page)]
    ends = ends_of(tags)
    # Before each tag: characters outside links, those of them in articles, and <main> elements so far.
    sums, at, linked, depth, all_plain, in_articles, mains = [], 0, False, 0, 0, 0, 0
    for start, end, closing, tag, attributes, single in tags:
        n = 0 if linked else len(page[at:start].strip())
        all_plain, in_articles, at = all_plain + n, in_articles + (n if depth else 0), end
        sums.append((all_plain, in_articles, mains))
        if tag == "a":
            linked = not closing and "href" in attributes.lower()
        elif tag in ARTICLE and not single:
            depth, mains = max(0, depth + (-1 if closing else 1)), mains + (tag == "main" and not closing)
    n = 0 if linked else len(page[at:].strip())
    sums.append((all_plain + n, in_articles + (n if depth else 0), mains))
    any_article = any(tag in ARTICLE and not closing for _, _, closing, tag, _, _ in tags)

    def holds_text(k: int, tag: str, why: str) -> bool:
        (plain_0, article_0, main_0), (plain_1, article_1, main_1) = sums[k], sums[ends[k]]
        if main_1 > main_0:
            return True
        if why == "comment" or tag in NEVER or tag == "header":
            return False
        if any_article:
            return article_1 > article_0 and 2 * (article_1 - article_0) >= sums[-1][1]
        return 2 * (plain_1 - plain_0) > sums[-1][0]

    at = k = 0
    while k < len(tags):
        start, end, closing, tag, attributes, single = tags[k]
        take(page[at:start])
        at, k = end, k + 1
        if tag == "a":
            links = 0 if closing or "href" not in attributes.lower() else 1
        if tag in INLINE:
            continue
        if tag == "br":
            take(" ")
            continue
        flush()
        if not closing and tag not in VOID and not single:
            why = is_outside(tag, attributes, articles > 0)
            if why and (why == "hidden" or not holds_text(k - 1, tag, why)):
                k = ends[k - 1]
                at = tags[k - 1][1] if k and tags[k - 1][2] and tags[k - 1][3] == tag else tags[k][0] if k < len(tags) else len(page)
                links = 0
                out.append(("", 0, 0, region if articles else 0))
                continue
        if tag in ARTICLE and not single:
            region += not closing and not articles
            articles = max(0, articles + (-1 if closing else 1))
    take(page[at:])
    flush()
    return out


def score(line: tuple[str, int, int, int]) -> int:
    """Of a line in an article all its characters; outside, those in links count against the others."""
    _, plain, linked, region = line
    return plain + linked if region else plain - linked


def main_text(page: str | None) -> str:
    """Lines between surge and dive, on every page. A surge is a window of WINDOW lines that scores SURGE, or half of the page's best
    window where that is less, or anything within an article; it dives where a window scores nothing. No window reaches into or out of an article, nor over a gap outside of articles.
    Nothing between surge and dive is left out.

    Of several articles, those under the largest text by SHARE are teasers. A run of lines outside of articles must have as much text as all
    articles, else it is none of the main text; on a page without articles, runs are chosen by their windows alone.
    """
    runs: list[list[tuple[str, int, int, int]]] = [[]]
    for line in lines_of(page or ""):
        if not line[0] and not line[3] or runs[-1] and runs[-1][-1][3] != line[3]:
            runs.append([])
        if line[0]:
            runs[-1].append(line)
    runs = [r for r in runs if r]
    sizes: dict[int, int] = {}
    for run in runs:
        sizes[run[0][3]] = sizes.get(run[0][3], 0) + sum(map(score, run))
    sizes.pop(0, None)
    windows = [[sum(map(score, run[i : i + WINDOW])) for i in range(len(run))] for run in runs]
    best = {run[0][3]: 0 for run in runs}
    for run, sums in zip(runs, windows, strict=True):
        best[run[0][3]] = max(best[run[0][3]], *sums)
    outside = [sum(max(0, x) for x in map(score, run)) for run in runs if not run[0][3]]
    articles = sum(sizes.values())
    largest = max([*sizes.values(), *(n for n in outside if n >= articles)], default=0)
    kept = []
    for run, sums in zip(runs, windows, strict=True):
        region = run[0][3]
        if region and sizes[region] * SHARE < largest or not region and sizes and sum(max(0, x) for x in map(score, run)) < max(articles, SURGE):
            continue
        least, i = 1 if region else max(1, min(SURGE, best[region] / 2)), 0
        while i < len(run):
            if sums[i] < least or not region and score(run[i]) <= 0:
                i += 1
                continue
            end = i
            while end < len(run) and sums[end] > 0:
                end += 1
            while not region and end > i and score(run[end - 1]) <= 0 and end == len(run):
                end -= 1
            kept += [line[0] for line in run[i:end]]
            i = end + 1
    return " ".join(kept)


def html_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The rows of ``pages`` with ``text`` (main text of the whole page, empty if none) and ``n_chars``. No shuffle.

    Null and empty pages have an empty text. Repeated rows and ties get equal texts; input columns named text or n_chars are
    replaced. The time is in proportion to the page's length.
    """
    rows = packed(pages, page=pages[f"`{html_col}`"])
    kind = rows.schema["row"].dataType.simpleString()

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(x) for x in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "main"])

        return step

    return unpacked(map_batches(rows, f"row {kind}, main string", start), pages.columns, text=F.col("main"), n_chars=F.length("main").cast("long"))
