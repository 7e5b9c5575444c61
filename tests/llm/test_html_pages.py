"""Pages marked by hand: what a reader takes for the article, written down beside each page."""

import pytest

from quarrymill.llm.html_text import main_text, marked

LONG = "This paragraph is about the matter at hand and goes on for a good while, so that it is text."
P, Q = f"<p>{LONG}</p>", LONG
MENU = "<ul>" + "".join(f"<li><a href=/{i}>Section number {i}</a></li>" for i in range(8)) + "</ul>"
REFS = "<ul>" + "".join(f"<li><a href=/r{i}>Ref {i}</a></li>" for i in range(3)) + "</ul>"

PAGES = [
    # whole articles, with their links
    (f"<article>{P}<h2>References</h2>{REFS}</article>", f"{Q} References Ref 0 Ref 1 Ref 2"),
    (f"<article>{P}{REFS}{P}</article>", f"{Q} Ref 0 Ref 1 Ref 2 {Q}"),
    (f"<article>{P}<p><a href=x>Read the whole report</a></p></article>", f"{Q} Read the whole report"),
    (f"<main><h1><a href=/>Title</a></h1>{P}</main>", f"Title {Q}"),
    (f"<article><header><h1>Title</h1></header>{P}<footer>Filed under x</footer></article>", f"Title {Q}"),
    (f"<article><h1>A</h1><p>B</p><p>C</p><p>D</p><p>E</p>{P}{P}<p>F</p></article>", f"A B C D E {Q} {Q} F"),
    # names that only look like marks
    (f"<article>{P}<section class='social-science'>{P}</section></article>", f"{Q} {Q}"),
    (f"<article>{P}<section id='login'>{P}</section>{P}{P}</article>", f"{Q} {Q} {Q} {Q}"),
    (f"<article>{P}<section id='search'><h2>Search</h2>{P}</section></article>", f"{Q} Search {Q}"),
    (f"<article>{P}<p class='shareholder-value'>{LONG}</p></article>", f"{Q} {Q}"),
    (f"<article>{P}<div class='no-comments'>{P}</div></article>", f"{Q} {Q}"),
    (f"<div class='page has-sidebar'>{P}</div>", Q),
    # marks, alone and with common parts
    (f"<article>{P}<div class='ad'>Buy now</div>{P}</article>", f"{Q} {Q}"),
    (f"<article>{P}<div class='related-posts'>{REFS}</div></article>", Q),
    (f"<article>{P}<aside>By the way</aside>{P}</article>", f"{Q} {Q}"),
    (f"<article>{P}<div class='newsletter_signup_box'>Get our letter</div>{P}</article>", f"{Q} {Q}"),
    (f"<article>{P}<p class='cookieNotice'>We use cookies</p></article>", Q),
    (f"<article>{P}<form><p>Your name</p><input></form></article>", Q),
    (f"<article>{P}<div hidden>secret</div><div style='display: none'>secret</div><div aria-hidden=true>x</div></article>", Q),
    # comments, however long
    (f"<article><p>Short body.</p></article><section class='comments'><article>{P}{P}{P}</article></section>", "Short body."),
    (f"<article>{P}</article><div class='responses'>{P}{P}{P}</div>", Q),
    (f"<article>{P}<section id='comments'>{P}{P}</section></article>", Q),
    (f"<div>{P}</div><ol class='comment-list'><li>{P}{P}{P}</ol>", Q),
    (f"<div>{P}</div><div id='disqus_thread'>{P}{P}{P}</div>", Q),
    (f"<body><h1>Title</h1>{P}<div class='user-comments'><p>Nice one.</p></div></body>", f"Title {Q}"),
    # short pages
    ("<body><div><p>This is a short note.</p></div></body>", "This is a short note."),
    ("<body><nav><a href=/>Home</a></nav><p>Moved.</p><footer>Imprint</footer></body>", "Moved."),
    ("<article><p>Hi.</p></article>", "Hi."),
    ("Just text", "Just text"),
    # pages without articles: windows decide
    (f"<div>{MENU}</div><div><h1>Title</h1>{P}{P}</div><div>{MENU}</div>", f"Title {Q} {Q}"),
    (f"<div>{MENU}</div>{P}<p>See <a href=x>this page</a> for more on all of it.</p>{P}", f"{Q} See this page for more on all of it. {Q}"),
    (f"<table><tr><td>{MENU}</td><td>{P}{P}</td></tr></table>", f"{Q} {Q}"),
    (f"<header>Site</header><div>{P}<ul><li>one point</li><li>another point</li></ul>{P}</div><div class='site-footer'>Imprint</div>", f"{Q} one point another point {Q}"),
    (f"<div>{P}<p><a href=x>A link on a line of its own</a></p>{P}</div>", f"{Q} A link on a line of its own {Q}"),
    (f"<p>{LONG}<aside>side</aside><p>Copyright 2020</p>", Q),
    # more than one article
    (f"<article>{P}{P}</article><article><h3>Next</h3></article>", f"{Q} {Q}"),
    (f"<div>{P}{P}{P}</div><article>One</article><article>Two</article>", f"{Q} {Q} {Q}"),
    (f"<article>{P}</article><p>Copyright 2020 Example Company</p>", Q),
    (f"<article>{P}</article><div>{MENU}</div>", Q),
    (f"<article>{P}</article><article>{P}</article>", f"{Q} {Q}"),
    # character references, white space, raw elements
    (f"<article><p>a&amp;b &lt;i&gt; &#233;&nbsp;x</p><script>var s = '<p>no</p>'</script><style>p {{}}</style>{P}</article>", f"a&b <i> é x {Q}"),
    (f"<article><p>one\n\t two<br>three</p><pre>a  b</pre><!-- no -->{P}</article>", f"one two three a b {Q}"),
]


@pytest.mark.parametrize(("page", "text"), PAGES, ids=range(len(PAGES)))
def test_page(page, text):
    assert main_text(page) == text


def test_windows_decide_without_articles():
    """Without the windows, the menus' lines would be in the text as well."""
    page = f"<div>{MENU}</div><div>{P}{P}</div>"
    assert "Section" not in main_text(page) and main_text(f"<article>{page}</article>").startswith("Section")


def test_names():
    assert [marked(x) for x in ("site-footer", "commentList", "reply", "social", "social-science", "article", "content", "posts", "ad-free", "main-nav", "thread")] == ["mark", "comment", "comment", "mark", "", "", "", "", "", "mark", ""]
