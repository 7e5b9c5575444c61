"""Operators against brute-force versions, libraries and each other, on small fixtures with awkward rows."""

import hashlib
import random
import re
from array import array

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from quarrymill.llm import byte_bpe, html_text, license_scan, near_dedup, quality_rules, token_counts
from quarrymill.llm.byte_bpe import ByteBpe, bpe_decode, bpe_encode, read_ranks
from quarrymill.llm.chat_format import chat_format
from quarrymill.llm.decontaminate import decontaminate, scan, automaton_of, windows_of, words_of
from quarrymill.llm.line_dedup import line_dedup
from quarrymill.llm.near_dedup import near_dedup as near
from quarrymill.llm.quality_classifier import pool_adjacent, quality_scores, statistics
from quarrymill.llm.token_counts import Counter

SCHEMA = "doc_id long, text string, n_lines string, row string, id string, x string"
LONG = "many words here and there " * 20_000


def frame(spark, rows):
    """Extra columns clash with the operators' own and working names."""
    return spark.createDataFrame([(i, t, "a", "b", "c", None) for i, t in rows], SCHEMA)


AWKWARD = [(1, None), (2, ""), (3, "   \n\t\n"), (4, LONG), (5, "same line of text\nother"), (5, "same line of text\nother"), (6, "Same line of text  \nunlike"), (None, "same line of text"), (None, None), (7, "é" * 9 + "\nshort"), (8, "é" * 10), (9, "é" * 10)]


def test_line_dedup(spark):
    got = {(r.doc_id, r.x, r.text, r.n_lines, r.n_dropped) for r in line_dedup(frame(spark, AWKWARD)).collect()}
    assert (5, None, "same line of text\nother", 2, 0) in got
    assert (6, None, "unlike", 2, 1) in got
    assert (None, None, "", 1, 1) in got and (None, None, "", 1, 0) in got
    assert (8, None, "é" * 10, 1, 0) in got and (9, None, "", 1, 1) in got and (7, None, "é" * 9 + "\nshort", 2, 0) in got
    assert (1, None, "", 1, 0) in got and (4, None, LONG, 1, 0) in got
    assert line_dedup(frame(spark, AWKWARD)).count() == len(AWKWARD)
    three = line_dedup(frame(spark, [(1, "one line again"), (2, "one line again"), (3, "one line once more")]), min_docs=3)
    assert {r.n_dropped for r in three.collect()} == {0}
    assert line_dedup(frame(spark, [])).count() == 0


def pieces():
    rng = random.Random(3)
    parts = ["a", "b", " ", "\n", "\t", "é", "1", "aaaa", "   ", "\x1c", "\xa0", "\x85", "漢", "字", "!", "...", "the", "'s", "　", "🎉", "́", "<|endoftext|>"]
    for _ in range(400):
        yield "".join(rng.choice(parts) for _ in range(rng.choice([0, 3, 20, 200])))
    for p in ("a", " ", "ab", "漢", "\n ", "é"):
        yield p * 5000
    yield "".join(rng.choice("abcdeéghijk") for _ in range(30_000))


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def test_bpe_is_the_librarys(bpe, library):
    for text in pieces():
        ids = bpe.encode(text)
        assert ids == array("I", library.encode_ordinary(text)).tobytes()
        assert bpe.decode(ids) == text.encode()


def test_bpe_joins_any_cut(bpe):
    rng = random.Random(5)
    for _ in range(300):
        piece = bytes(rng.choice(b"aabbcdeth ") for _ in range(rng.randint(2, 90)))
        cut = rng.randint(1, len(piece) - 1)
        assert bpe.join(bpe.leaf(piece[:cut]), bpe.leaf(piece[cut:])) == bpe.leaf(piece) == bpe.merged(piece)


def test_bpe_frames(spark):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    docs = frame(spark, AWKWARD).withColumn("token_ids", F.lit(1))
    out = bpe_decode(bpe_encode(docs, path, P.PATTERN), path, P.PATTERN).collect()
    assert len(out) == len(AWKWARD)
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in out)
    assert bpe_encode(frame(spark, []), path, P.PATTERN).count() == 0


def test_token_counts(spark):
    path = P.path("word_bpe_49k.json")
    library = token_counts.loaded(path)
    counter = Counter(path)
    texts = list(pieces()) + [None, "<|endoftext|> a<|startoftext|>b", LONG]
    expected = [len(library.encode(t or "", add_special_tokens=False)) for t in texts]
    assert counter.counts(texts) == expected == counter.counts(texts)
    out = {(r.doc_id, r.n_bytes, r.over_limit) for r in token_counts.token_counts(frame(spark, AWKWARD), path).collect()}
    assert (4, len(LONG), True) in out and (1, 0, False) in out and (8, 20, False) in out


def brute_repeats(words):
    wins = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = {i + k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(8)}
    return len(hit)


def test_quality_signals(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 120))) for _ in range(40)] + [None, "", " \n ", "A|b!! C\x0bd\n\nA|b!! C\x0bd\nx", LONG]
    rows = quality_rules.quality_rules(frame(spark, list(enumerate(texts)))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r.doc_id] or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", t) if w]
        lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        if len(words) < 1000:
            assert r.n_repeat_words == brute_repeats(words)
        assert r.base_failed == (len(words) < 20 or 100 * r.n_repeat_words > 30 * len(words))
        assert not (r.base_failed and r.kept)
    assert quality_rules.quality_rules(frame(spark, [])).count() == 0


def pattern(**votes):
    """A vote pattern of RULES; rules that aren't named abstain."""
    names = [r.name for r in quality_rules.RULES]
    assert set(votes) <= set(names)
    return tuple(votes.get(n, 0) for n in names)


FINE = {"varied": 1, "sentences": 1, "length": 1}


def test_estimates_decide_conflicts():
    """The same conflicting votes are followed or outweighed, as the rule agrees with others elsewhere or not; all-must-pass rejects both."""
    disputed = pattern(**FINE, line_copies=-1)
    faulty = [(pattern(**FINE, symbols=-1, symbol_share=-1, line_copies=-1), 100), (pattern(**FINE, plain=1), 1000)]
    careless = [(pattern(**FINE, symbols=-1, symbol_share=-1), 100), (pattern(**FINE, plain=1), 900), (disputed, 100)]
    trusted, doubted = quality_rules.estimated([*faulty, (disputed, 1)]), quality_rules.estimated(careless)
    assert trusted.odds(disputed) < 0 < doubted.odds(disputed)
    at = [r.name for r in quality_rules.RULES].index("line_copies")
    assert trusted.accuracy()[at][1] > 0.95 > doubted.accuracy()[at][1]


def test_verdicts(spark):
    """Verdicts against all-must-pass: faulty texts go, texts with a doubtful vote only stay, short ones fail the base."""
    rng = random.Random(5)
    prose = lambda n: ". ".join(" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(8)).capitalize() for _ in range(n // 8)) + "."
    copied = [p + ("\n" + p.split(". ")[0]) for p in (prose(160).replace(". ", ".\n", 1) for _ in range(4))]
    texts = {"fine": [prose(200) for _ in range(60)], "short": [prose(40) for _ in range(20)], "symbols": [prose(100).replace(" ", "## ") for _ in range(8)], "shouts": [prose(100).upper().replace(" ", "!! ") for _ in range(8)], "base": ["few words only."], "copied": copied}
    kinds = [k for k, v in texts.items() for _ in v]
    rows = quality_rules.quality_rules(frame(spark, list(enumerate(t for v in texts.values() for t in v)))).collect()
    kept = {k: {r.kept for r in rows if kinds[r.doc_id] == k} for k in texts}
    assert kept == {"fine": {True}, "short": {True}, "symbols": {False}, "shouts": {False}, "base": {False}, "copied": {True}}
    votes = spark.createDataFrame([(r.doc_id, *[r[c] for c in quality_rules.SIGNALS]) for r in rows], ["doc_id", *quality_rules.SIGNALS]).select("doc_id", *quality_rules.votes()).collect()
    assert {kinds[v[0]] for v in votes if -1 in v[1:]} == {"short", "symbols", "shouts", "base"}  # all-must-pass rejects the short ones, too
    assert "text" not in quality_rules.quality_rules(frame(spark, [(1, "x")]), with_text=False).columns


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var x="</p>";</script></head><body><nav><ul><li><a href=x>Menu</a></li></ul></nav><!-- <p>no</p> -->
<div class="ad">Buy</div><article><h1>Head &amp; <i>sh</i>oulders</h1><p><b>One
 two<br>three<p>Is.</p><div class="comments"><p>I disagree</p></div><aside>side</aside></article><footer>&copy; f</footer></body></html>"""


def test_html(spark):
    assert html_text.main_text(PAGE) == "Head & shoulders One two three Is."
    plain = "<body><ul><li><a href=a>Home</a><li><a href=b>About</a></ul><p>" + "long text here " * 10 + "</p><p>and short.</p><form><p>Name</p></form></body>"
    assert html_text.main_text(plain) == ("long text here " * 10).strip() + " and short."
    assert [html_text.main_text(x) for x in (None, "", "<p", "no markup")] == ["", "", "", "no markup"]
    pages = spark.createDataFrame([(1, "u", PAGE, "old"), (2, None, None, "old"), (3, "", "", None)], "page_id long, url string, html string, text string")
    assert {(r.page_id, r.n_chars) for r in html_text.html_text(pages).collect()} == {(1, 34), (2, 0), (3, 0)}


BODY = "<p>" + "real body words here " * 20 + "</p>"
WORDS = ("real body words here " * 20).strip()


def test_html_windows_run_on_every_page():
    teasers = "<div><article><h3>One</h3>teaser</article><article>Two teaser</article></div>"
    assert html_text.main_text(f"<body>{BODY}{teasers}</body>") == WORDS
    assert html_text.main_text(f"<div>{BODY}</div><aside>side</aside><p>Copyright 2020 Example</p>") == WORDS
    assert html_text.main_text(f"<article>{BODY}<ul><li><a href=a>A</a><li><a href=b>B</a></ul></article><p>Copyright 2020</p>") == WORDS + " A B"
    assert html_text.main_text("<article><h1><a href=x>Title</a></h1><p>Hi.</p><aside>side</aside><p>So.</p></article><p>Copyright</p>") == "Title Hi. So."


@pytest.mark.parametrize(
    "page",
    [
        f"<div class='content-sidebar-wrap'><main>{BODY}</main></div><div class='sidebar'><article>side</article></div>",
        f"<div class='page has-sidebar'>{BODY}<div class='sidebar'>side</div></div>",
        f"<div class='content ad-free'>{BODY}</div>",
        f"<form id='all'>{BODY}</form>",
        f"<article><div class='share-wrap'>{BODY}</div></article>",
        f"<article><ul><li class='share'>Share</ul>{BODY}</article>",
        f"<ul><li class='share'>Share<li>{WORDS}</ul>",
        f"<article><p class='notice'>note{BODY}</article>",
        f"<article><div class='notice'>note</article><article>{BODY}</article>",
        f"<article><div class='notice'><ul><li>note</div>{BODY}</article>",
        f"<article><svg class='i'/>{BODY}<svg><path/></svg></article>",
        f"<article><svg/>{BODY}</article>",
        f"<article hidden>no</article>{BODY}",
    ],
)
def test_html_keeps_articles(page):
    assert html_text.main_text(page) == WORDS


def brute_windows(page):
    """Surge and dive over the same lines, each looked at on its own: it is kept if a surge goes on to it, and, outside of articles, if it stands
    before a line of text or the dive."""
    groups = [[]]
    for line in html_text.lines_of(page):
        if line[0] and groups[-1] and groups[-1][-1][3] == line[3]:
            groups[-1].append(line)
        elif line[0]:
            groups.append([line])
        elif not line[3] or groups[-1] and groups[-1][-1][3] != line[3]:
            groups.append([])
    groups = [g for g in groups if g]
    value = lambda x: x[1] + x[2] if x[3] else x[1] - x[2]
    window = lambda g, i: sum(value(x) for x in g[i : i + 3])
    text = lambda g: sum(max(0, value(x)) for x in g)
    total = {r: sum(text(g) for g in groups if g[0][3] == r) for r in {g[0][3] for g in groups} - {0}}
    articles = sum(total.values())
    largest = max([0, *total.values(), *(text(g) for g in groups if not g[0][3] and text(g) >= articles)])
    out = []
    for g in groups:
        r = g[0][3]
        if r and total[r] * 8 < largest or not r and total and text(g) < max(80, articles):
            continue
        best = max(window(x, i) for x in groups if x[0][3] == r for i in range(len(x)))
        for i in range(len(g)):
            begun = any(window(g, s) >= (1 if r else max(1, min(80, best / 2))) and (r or value(g[s]) > 0) and all(window(g, k) > 0 for k in range(s, i + 1)) for s in range(i + 1))
            dives = next((k for k in range(i, len(g)) if window(g, k) <= 0), None)
            if begun and (r or dives is not None or any(value(x) > 0 for x in g[i:])):
                out.append(g[i][0])
    return " ".join(out)


def test_html_windows_against_brute_force():
    rng = random.Random(6)
    piece = lambda: rng.choice(["<p>" + "word " * rng.randint(1, 40) + "</p>", "<p>Hi.</p>", "<ul><li><a href=x>link of some length</a></ul>", "<div class='ad'>buy</div>", "<nav><a href=y>menu</a></nav>", "<h2>Head</h2>"])
    seen = set()
    for _ in range(400):
        page = "".join(piece() for _ in range(rng.randint(0, 5)))
        for _ in range(rng.randint(0, 2)):
            page += "<article>" + "".join(piece() for _ in range(rng.randint(0, 6))) + "</article>" + "".join(piece() for _ in range(rng.randint(0, 4)))
        got = html_text.main_text(page)
        assert got == brute_windows(page)
        seen.add(got)
    assert len(seen) > 200


def test_html_frames(spark):
    long = "<article>" + "<p>many words</p>" * 50_000 + "</article>"
    rows = [(1, PAGE, "a", 1), (1, PAGE, "a", 1), (2, None, "b", 2), (3, long, "c", 3), (4, "<main><b>unclosed", "d", 4)]
    got = html_text.html_text(spark.createDataFrame(rows, "page_id long, html string, row string, main int")).collect()
    assert sorted((r.page_id, r.n_chars, r.row, r.main) for r in got) == [(1, 34, "a", 1), (1, 34, "a", 1), (2, 0, "b", 2), (3, 50_000 * 11 - 1, "c", 3), (4, 8, "d", 4)]
    assert html_text.html_text(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_html_deep_pages_take_linear_time():
    assert html_text.main_text("<div class='comments'><ul><li><p>x" * 20_000) == ""
    assert html_text.main_text("<div class='ad'><ul><li><p>x" * 20_000).startswith("x x x")


def brute_components(rows, words=5, least=75):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().translate(near_dedup.LOWER).split()
        sets[i] = {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    component = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                    low = min(component[a], component[b])
                    component[a] = component[b] = low
    return sets, component


def test_near_dedup(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(6):  # chains of edits, so that groups are linked through their middle only
        words = [rng.choice("abcdefghijklmnop") * rng.randint(1, 3) for _ in range(80)]
        for _ in range(7):
            words = list(words)
            words[rng.randrange(80)] = "new" + str(rng.random())
            words[rng.randrange(80)] = "new" + str(rng.random())
            rows.append((len(rows), " ".join(words)))
    rows += [(100, None), (101, ""), (102, "two words"), (103, "Two  WORDS"), (104, LONG), (105, LONG), (106, rows[0][1])]
    rng.shuffle(rows)
    sets, component = brute_components(rows)
    got = near(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), component[i], component[i] == i) for i in sets}


def test_near_dedup_awkward(spark):
    rows = [(5, "a b c d e f g"), (5, "h i j k l m n"), (3, "A b c d e f g"), (9, "h i j k l m n"), (None, "a b c d e f g"), (None, None)]
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in near(frame(spark, rows)).collect())
    assert got == [(-1, -1, True), (-1, -1, True), (3, 3, True), (5, 3, False), (5, 3, False), (9, 3, False)]
    assert near(frame(spark, [])).count() == 0


def test_circulant_signature():
    rng = np.random.default_rng(0)
    whole = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    a, b = np.unique(whole[:3500]), np.unique(whole[500:])
    same = (near_dedup.circulant_signature(a) == near_dedup.circulant_signature(b)).mean()
    assert abs(same - 0.75) < 0.15


def test_decontaminate(spark):
    items = [(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (10, "Tiny, item"), (2, None), (3, "..."), (None, "w5 w6"), (1, "Tiny item")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = ["x W1 w2-w3 w4 w5 w6 w7 w8 w9 w10 y", "tiny\nitem and tiny items", None, "", "w5w6 w5", "w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 tiny item", "é tiny item é", LONG]
    docs = frame(spark, list(enumerate(texts)))
    got = {r.doc_id: r for r in decontaminate(docs, bench).collect()}
    assert [got[i].n_hit for i in range(8)] == [10, 2, 0, 0, 0, 12, 2, 0]
    assert got[5].items == ["", "1", "10"] and got[0].items == ["", "1"]
    span = got[6].spans[0]
    assert texts[6][span.start : span.end] == "tiny item" and texts[0][got[0].spans[0].start : got[0].spans[0].end] == "W1 w2-w3 w4 w5 w6 w7 w8 w9 w10"
    joined = {r.doc_id: r for r in decontaminate(docs, bench, part_bytes=64).collect()}
    assert all(joined[i][c] == got[i][c] for i in got for c in ("n_words", "n_hit", "items", "spans"))
    assert {r.n_hit for r in decontaminate(docs, bench.limit(0)).collect()} == {0}
    assert decontaminate(docs.limit(0), bench).count() == 0
    twice = decontaminate(docs.union(docs).union(docs), bench, part_bytes=64).where("doc_id = 5").collect()
    assert len(twice) == 3 and {(r.n_hit, tuple(r.items)) for r in twice} == {(12, ("", "1", "10"))}


def test_scan_against_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        items = {str(i): " ".join(rng.choice("abc") for _ in range(rng.randint(0, 14))).encode() for i in range(4)}
        passages = {}
        for i, t in items.items():
            for p in set(windows_of(t, 10)):
                passages.setdefault(p, []).append(i)
        text = " ".join(rng.choice("abc") for _ in range(40)).encode()
        w, hit, who = words_of(text), set(), set()
        for p, whose in passages.items():
            k = p.split()
            for at in range(len(w) - len(k) + 1):
                if w[at : at + len(k)] == k:
                    hit |= set(range(at, at + len(k)))
                    who |= set(whose)
        n, runs, items_hit = scan(automaton_of(passages), text)
        assert (n, {i for a, b in runs for i in range(a, b)}, items_hit) == (40, hit, who)


def test_classifier(spark):
    rng = random.Random(0)
    docs, labels = [], []
    for i in range(600):
        good = rng.random() < 0.7
        words = [rng.choice(["stone", "river", "cloud", "lamp", "tree"]) + str(rng.randint(0, 99)) for _ in range(60)]
        docs.append((i, " ".join(w if good else w + "###" for w in words)))
        labels.append((i, int(good)))
    docs += [(10_000, None), (10_001, ""), (None, "x")]
    labels += [(99_999, 1), (0, None), (None, 1)]
    scored = quality_scores(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(scored) == len(docs) and all(0 <= r.score <= 1 for r in scored)
    held = [(r.predicted, dict(labels)[r.doc_id]) for r in scored if r.held_out and r.doc_id is not None and r.doc_id < 1000 and r.doc_id]
    assert len(held) > 60 and sum(a == b for a, b in held) / len(held) > 0.97
    constant = quality_scores(frame(spark, docs), spark.createDataFrame([], "doc_id long, quality int")).collect()
    assert len({r.score for r in constant}) == 1
    assert quality_scores(frame(spark, []), spark.createDataFrame(labels, "doc_id long, quality int")).count() == 0


def test_statistics_and_isotonic():
    assert all(np.isfinite(statistics(t)).all() for t in (None, b"", b"\n\n", "é\x00".encode(), LONG.encode()))
    assert pool_adjacent(np.array([1, 1, 1, 0, 2.0]), np.array([0, 1, 0, 0, 2.0])).tolist() == [0, 0.5, 0.5, 0.5, 1]


def test_licenses(spark):
    mit = license_scan.TEMPLATES["mit"][2]
    rows = [(1, "x y z\nReleased under the  MIT license\nmore"), (2, mit.replace(". ", ".\n")), (3, "Licensed under nothing at all really"), (4, None), (5, ""), (6, "intro\n\n" + mit.replace("persons", "people") + "\n\nend"), (7, "Released under the MIT License.\nLicensed under CC BY-NC 4.0.")]
    got = {r.doc_id: r for r in license_scan.license_scan(frame(spark, rows)).collect()}
    assert [got[i].license for i in range(1, 8)] == ["mit", "mit", None, None, None, "mit", "cc-by-nc-4.0"]
    assert got[7].licenses == ["cc-by-nc-4.0", "mit"] and got[7].n_notices == 2 and got[4].license_score == 0
    for t in (t for ts in license_scan.TEMPLATES.values() for t in ts):
        grams = license_scan.template_bigrams(t)
        first, n_first, second, n_second = license_scan.least_words(grams, 80)
        for side, n in ((0, n_first), (1, n_second)):  # all bigrams of the most common n - 1 words are too few
            counts = sorted((sum(g.split()[side] == w for g in grams) for w in {g.split()[side] for g in grams}), reverse=True)
            assert all(200 * min(sum(counts[: n - 1]), m) < 80 * (len(grams) + m) for m in range(license_scan.size_bounds(len(grams), 80)[0], 4 * len(grams)))
    for n in range(1, 40):
        lo, hi = license_scan.size_bounds(n, 80)
        assert all((200 * min(n, m) >= 80 * (n + m)) == (lo <= m <= hi) for m in range(1, 120))


def brute_licenses(text, least=80):
    """All runs of lines and paragraphs, without any pruning."""
    text = text or ""
    paragraphs = re.split(r"\n[\x20\x09-\x0D]*\n", text)
    units = {*text.split("\n"), text, *(" ".join(paragraphs[i : j + 1]) for i in range(len(paragraphs)) for j in range(i, len(paragraphs)))}
    best = {}
    for unit in units:
        g = set(license_scan.template_bigrams(unit))
        for name, texts in license_scan.TEMPLATES.items():
            for t in map(license_scan.template_bigrams, texts):
                if g and 200 * len(g & set(t)) >= least * (len(g) + len(t)):
                    best[name] = max(best.get(name, 0), 200 * len(g & set(t)) / (len(g) + len(t)))
    return best


def test_licenses_over_paragraphs(spark):
    rng = random.Random(3)
    texts = [None, "", "word " * 30_000, "x\n\n" * 400]
    for name in license_scan.TEMPLATES:
        for t in license_scan.TEMPLATES[name]:
            words = t.split()
            for _ in range(3):  # cut in paragraphs, with edits, inside other paragraphs
                w = [x if rng.random() > 0.04 else "edited" for x in words]
                cuts = sorted(rng.sample(range(1, len(w)), min(3, len(w) - 1)))
                parts = [" ".join(w[a:b]) for a, b in zip([0, *cuts], [*cuts, len(w)], strict=True)]
                texts.append("\n \n".join(["Some title", "Copyright of somebody", *parts, "And an end\nof two lines"]))
    texts += texts[-2:]
    got = {r.doc_id: r for r in license_scan.license_scan(frame(spark, list(enumerate(texts)))).collect()}
    found = 0
    for i, t in enumerate(texts):
        best = brute_licenses(t) if i != 3 else {}
        assert got[i].licenses == sorted(best)
        assert abs(got[i].license_score - max(best.values(), default=0)) < 1e-9
        found += len(best) > 0 and got[i].license in best
    assert found > 20
    assert license_scan.license_scan(frame(spark, [])).count() == 0


def test_chat(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "no"), (4, 1, "assistant", "no"), (4, 0, "user", "hi"), (4, 0, "user", "hi"), (5, 0, None, None), (None, 0, "user", "x"), (6, None, "user", "alone")]
    got = {r.conv_id: (r.n_turns, r.n_copies, r.rendered) for r in chat_format(spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, turns int")).collect()}
    assert {k: v[:2] for k, v in got.items()} == {1: (2, 1), 3: (2, 2), 5: (1, 1), 6: (1, 1)}
    assert got[1][2] == "<|user|>\nhi\n<|end|>\n<|assistant|>\nyes\n<|end|>\n"
    assert chat_format(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    clean = lambda k: " ".join(f"word{k}x{i}" for i in range(60))
    passage = " ".join(f"question{i}" for i in range(12))
    shared = "a line that two documents share"
    docs = [(1, clean(1) + "\n" + shared), (2, clean(2) + "\n" + shared), (3, clean(3)), (4, clean(3) + " end"), (5, clean(5) + " " + passage), (6, "### " * 80), (7, None)]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert sorted(out) == [1, 2, 3] and all(r.round_trip for r in out.values())
    assert out[2].text == clean(2) and out[1].text == docs[0][1] and out[2].n_chars == len(clean(2))
    assert hashlib.sha256(bytes(out[3].token_ids)).digest() == hashlib.sha256(byte_bpe.loaded(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).encode(clean(3))).digest()
