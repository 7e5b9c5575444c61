"""The element index against a brute-force tree, markdown, links, references, and walks over nested JSON against recursion."""

import json
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from quarrymill.operators import elements, nested

PAGE = """<!DOCTYPE html><html lang=en><head><title>A &amp; b</title><script type="application/ld+json">{"a": "</p>"}</script></head>
<body><nav><a href="/n" rel="NoFollow me">N</a><p>menu</p></nav><main><h1>One <b>two</b></h1><p>First<p>Second <a href=" /x ">link here</a>
<ul><li>item<li>next <p>inside</p></ul><pre>code  here</pre><h2></h2>
<picture><source srcset="a.webp 1x, b.webp 2x"><img src="a.jpg" srcset="c.jpg 100w"></picture>
<video poster=p.png><source src=v.mp4><track src=t.vtt></video><source src="lost.bin"><img data-src="lazy.png" style="x"></main><footer><p>foot</p></footer>"""


def index(spark, *pages):
    return elements.elements(spark.createDataFrame([(i, p, 7) for i, p in enumerate(pages)], "page_id int, html string, tag int"))


def test_index(spark):
    rows = {r["at"]: r for r in index(spark, PAGE).collect()}
    assert [rows[i]["at"] for i in range(len(rows))] == list(range(len(rows)))
    for r in rows.values():
        if r["parent"] is not None:
            p = rows[r["parent"]]
            assert p["at"] < r["at"] <= r["last"] <= p["last"] and r["depth"] == p["depth"] + 1 and r["path"] == f"{p['path']}/{r['tag']}"
        else:
            assert r["path"] == r["tag"]
    assert [r["text"] for r in rows.values() if r["tag"] == "p"] == ["menu", "First", "Second link here", "inside", "foot"]
    assert [r["text"] for r in rows.values() if r["tag"] == "li"] == ["item", "next inside"]
    assert {rows[r["owner"]]["tag"] for r in rows.values() if r["tag"] == "img" and r["owner"]} == {"picture"}
    assert [r["text"] for r in rows.values() if r["tag"] == "script"] == ['{"a": "</p>"}']


def test_titles_links_headings_markdown(spark):
    i = index(spark, PAGE, None, "", "no tag at all", "<p>alone")
    assert [(r["page_id"], r["text"]) for r in elements.titles(i).collect()] == [(0, "A & b")]
    found = sorted((r["target"], r["text"], r["nofollow"]) for r in elements.links(i).collect())
    assert found == [("/n", "N", True), ("/x", "link here", False)]
    assert [(r["level"], r["text"]) for r in elements.headings(i).collect()] == [(1, "One two")]
    rows = {r["page_id"]: r for r in elements.markdown(i, "page_id").collect()}
    assert set(rows) == {0, 4}
    assert rows[0]["markdown"] == "# One two\n\nFirst\n\nSecond link here\n\nitem\n\nnext inside\n\ninside\n\n```\ncode here\n```"
    assert rows[0]["headings"] == ["One two"] and rows[0]["n_code_blocks"] == 1
    assert rows[4]["markdown"] == "alone"
    context = {r["target"]: (r["heading"], r["context"]) for r in elements.link_context(i, "page_id", words=2).collect()}
    assert context == {"/n": ("", ""), "/x": ("One two", "Second link")}


CUT = '<title>a &amp;&amp</title><body title="?x=1&copy=2"><h1>b &amp;&amp</h1><p>c &#38; &#38 &notit; &lt;<script>x && y</script><!-- & -->'


def test_headings_keep_references_without_an_end(spark, tmp_path):
    from quarrymill.plans import markup

    spark.createDataFrame([(1, "https://a.example/", CUT)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert sorted((r["kind"], r["text"]) for r in markup.element_headings(spark, str(tmp_path)).collect()) == [("h1", "b &&amp"), ("title", "a &&amp")]
    assert [r["headings"] for r in markup.page_markdown(spark, str(tmp_path)).collect()] == ["b &&amp"]
    by_tag = {r["tag"]: r for r in markup.index(spark, str(tmp_path)).collect()}
    assert by_tag["p"]["text"] == "c & &#38 &notit; <" and by_tag["script"]["text"] == "x && y" and by_tag["body"]["attributes"]["title"] == "?x=1&copy=2"
    assert [r["text"] for r in elements.titles(index(spark, CUT)).collect()] == ["a &&"]


def test_references(spark):
    found = sorted((r["kind"], r["address"], r["condition"]) for r in elements.references(index(spark, PAGE), "page_id").collect())
    assert found == [
        ("image", "a.jpg", ""), ("image", "a.webp", "1x"), ("image", "b.webp", "2x"), ("image", "c.jpg", "100w"), ("image", "lazy.png", ""), ("image", "p.png", ""),
        ("other", "lost.bin", ""), ("track", "t.vtt", ""), ("video", "v.mp4", ""),
    ]


class Plain(HTMLParser):
    """Start tags alone, in order."""

    def __init__(self):
        super().__init__()
        self.tags = []

    def handle_starttag(self, tag, attrs):
        self.tags.append(tag)


def tree(rows):
    """Depth, path and last from the parents alone."""
    depth, path, last = {}, {}, {}
    for r in rows:
        depth[r[0]] = 0 if r[1] is None else depth[r[1]] + 1
        path[r[0]] = r[4] if r[1] is None else f"{path[r[1]]}/{r[4]}"
    for r in reversed(rows):
        last[r[0]] = max(last.get(r[0], r[0]), r[0])
        if r[1] is not None:
            last[r[1]] = max(last.get(r[1], 0), last[r[0]])
    return depth, path, last


def test_malformed_pages():
    rng = random.Random(5)
    parts = ["<p>", "</p>", "<div>", "</div>", "<b>", "</b>", "<ul>", "<li>", "</ul>", "<table>", "<tr>", "<td>", "</table>", "<a href='x'>", "</a>", "<br/>", "<svg/>", "<h1>", "</h2>", "<![if x]>", "<!-- c", "-->", "<", "&amp", "word ", "<script>1<2</script>", "<img src=", "<video>", "</video>", "</>"]
    for _ in range(400):
        page = "".join(rng.choice(parts) for _ in range(rng.randrange(40)))
        parser = elements.ElementParser()
        parser.feed(page)
        rows = parser.result()
        depth, path, last = tree(rows)
        assert all((r[3], r[5], r[2]) == (depth[r[0]], path[r[0]], last[r[0]]) for r in rows)
        if "<!--" not in page and "<![" not in page:
            plain = Plain()
            plain.feed(page)
            plain.close()
            assert [r[4] for r in rows] == plain.tags
    deep = elements.ElementParser()
    deep.feed("<div>" * 5000 + "x" + "</div>" * 5000)
    assert max(r[3] for r in deep.result()) == elements.MOST_DEPTH


def leaves(value, path="$"):
    kind = "null" if value is None else "boolean" if isinstance(value, bool) else "string" if isinstance(value, str) else "number" if isinstance(value, (int, float)) else "array" if isinstance(value, list) else "object"
    if isinstance(value, dict) and value:
        return [x for k, v in value.items() for x in leaves(v, f"{path}.{k}")]
    if isinstance(value, list) and value:
        return [x for i, v in enumerate(value) for x in leaves(v, f"{path}[{i}]")]
    return [(path, kind, value if isinstance(value, str) else json.dumps(value) if kind in ("number", "boolean") else None)]


def random_json(rng, depth):
    kind = rng.randrange(7 if depth else 5)
    if kind < 5:
        return [None, True, rng.randrange(-99, 99), "täxt \" \\ \n", rng.choice(["", "x"])][kind]
    if kind == 5:
        return {rng.choice("abcdef") + str(i): random_json(rng, depth - 1) for i in range(rng.randrange(4))}
    return [random_json(rng, depth - 1) for _ in range(rng.randrange(4))]


def test_walk(spark):
    rng = random.Random(1)
    docs = [(i, json.dumps(random_json(rng, 4))) for i in range(30)]
    bad = [(100, None), (101, "{"), (102, "[" * 12 + "]" * 12), (103, json.dumps(list(range(60))))]
    found, aside = nested.walk(spark.createDataFrame(docs + bad, "id long, j string"), "id", "j", most_depth=8, most_nodes=50)
    assert sorted(map(tuple, aside.collect())) == [(100, "malformed"), (101, "malformed"), (102, "too_deep"), (103, "too_many")]
    expected = sorted((i, *x) for i, j in docs for x in leaves(json.loads(j)))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_walk_of_nothing(spark):
    found, aside = nested.walk(spark.createDataFrame([], "id long, j string"), "id", "j")
    assert found.count() == 0 and aside.count() == 0


def test_walk_writes_leaves_once(spark, monkeypatch):
    """A table of four levels' leaves and one of what is set aside; before, each level was written with its values."""
    written, keep = [], nested.Scratch.keep
    monkeypatch.setattr(nested.Scratch, "keep", lambda self, df: written.append(df.columns) or keep(self, df))
    found, aside = nested.walk(spark.createDataFrame([(1, '{"a": {"k": 1}, "b": [{"x": 1.5, "y": "2"}, {}]}')], "id long, j string"), "id", "j")
    assert sorted((r["path"], r["kind"], r["value"]) for r in found.collect()) == [("$.a.k", "number", "1"), ("$.b[0].x", "number", "1.5"), ("$.b[0].y", "string", "2"), ("$.b[1]", "object", None)]
    assert aside.count() == 0 and len(written) == 2


def test_walk_in_rounds(spark):
    """Documents that end inside, at the end and after rounds of levels; values are counted through all of them."""
    chain = lambda n, end: "[1," * n + end + "]" * n
    docs = [(10 * n + i, chain(n, end)) for n in (3, 4, 5, 8, 9) for i, end in enumerate(("[]", "{}", "null", '"s"'))]
    aside = [(100, chain(10, "1")), (101, chain(9, "[2]")), (102, chain(9, "[" + "3," * 12 + "3]")), (103, chain(8, "[" + "3," * 12 + "3]")), (104, chain(3, "1")), (104, "[1")]
    held = [(103 + 100, chain(8, "[" + "3," * 11 + "3]"))]
    found, out = nested.walk(spark.createDataFrame(docs + held + aside, "id long, j string"), "id", "j", most_depth=9, most_nodes=29)
    assert sorted(map(tuple, out.collect())) == [(100, "too_deep"), (101, "too_deep"), (102, "too_deep"), (103, "too_many"), (104, "malformed")]
    expected = [(i, *x) for i, j in docs + held for x in leaves(json.loads(j))]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    twice = spark.createDataFrame([(1, chain(6, "1")), (1, chain(6, "1")), (2, chain(6, "1"))], "id long, j string")
    found, out = nested.walk(twice, "id", "j", most_nodes=25)
    assert [tuple(r) for r in out.collect()] == [(1, "too_many")] and {r["id"] for r in found.collect()} == {2}


MEDIA = {
    "@type": "VideoObject", "name": " Film ", "contentUrl": "https://x.example/f.mp4", "thumbnailUrl": ["t.jpg", "u.png"], "embedUrl": "https://x.example/embed",
    "caption": {"@type": "ImageObject", "url": "c.vtt", "description": "D", "image": {"@id": "q"}}, "author": {"@type": "Person", "name": "P", "image": "p.jpg"}, "url": "no",
}


def media(value, kind=None, under=None, said=(None, None)):
    """By recursion; address and kind before suffixes."""
    out = []
    if under:
        url = value if isinstance(value, str) else next((value[k] for k in nested.ADDRESS_KEYS if isinstance(value.get(k), str) and value[k]), None) if isinstance(value, dict) else None
        if url and url.strip():
            out.append((url.strip(), under, *said))
    if isinstance(value, list):
        return out + [x for v in value for x in media(v, kind, under, said)]
    if not isinstance(value, dict):
        return out
    for t in value.get("@type") if isinstance(value.get("@type"), list) else [value.get("@type")]:
        own = next((k for k in ("image", "video", "audio") if str(t).lower().endswith(k + "object")), None)
        if own:
            kind = own
            break
    if kind in ("image", "video", "audio"):
        said = tuple((value.get(k) or "").strip() or s for k, s in zip(("name", "description"), said))
    for k, v in value.items():
        key = k.lower()
        here = kind if key in nested.INHERITED_KEYS and kind else next((m for m, names in nested.MEDIA_KEYS.items() if key in names), None)
        out += media(v, here or kind, here, said)
    return out


@pytest.mark.parametrize("doc", [MEDIA, [MEDIA, {"image": MEDIA}], {"@type": ["Thing", "AudioObject"], "encoding": [{"contentUrl": "a.mp3"}, "b"]}, {}, [], None])
def test_media_objects(spark, doc):
    found = nested.media_objects(spark.createDataFrame([(1, json.dumps(doc)), (2, "{"), (3, None)], "id long, j string"), "id", "j")
    suffixes = {".mp4": "video", ".mp3": "audio", ".jpg": "image", ".png": "image"}
    expected = [(u, next((k for s, k in suffixes.items() if u.endswith(s)), kind), n, d) for u, kind, n, d in media(doc)]
    got = [(r["address"], r["kind"], r["name"], r["description"]) for r in found.where(F.col("address") != "c.vtt").collect()]
    assert sorted(map(str, got)) == sorted(str(x) for x in expected if x[0] != "c.vtt")
