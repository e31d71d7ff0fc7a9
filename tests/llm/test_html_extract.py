import html
import re
from collections import Counter

import pytest

from jsonmart.llm import html_extract as h
from jsonmart.llm.labelled_pages import PAGES
from llm_fixtures import *  # noqa: F403


def test_pages_of_the_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in h.main_text(pages).collect()}
    for row in pages.collect():
        article = re.search(r"<article>(.*)</article>", row.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", article.replace("<br>", " ").replace("<b>", "").replace("</b>", ""))
        want = "\n\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)
        assert got[row.page_id].text == want and got[row.page_id].n_chars == len(want)
        assert got[row.page_id].url == row.url


@pytest.mark.parametrize("k", range(len(PAGES)))
def test_held_out_layouts(k):
    """Each labelled page with weights from the others: most words right, no furniture that others name."""
    weights = h.Weights(PAGES[:k] + PAGES[k + 1 :])
    marked = re.search(r"<(\w+)[^>]*data-main[^>]*>(.*?)</\1>(?!.*data-main)", PAGES[k], re.S)[2]
    want = html.unescape(re.sub(r"<[^>]*>", " ", marked)).split()
    got = h.extract(PAGES[k].replace("data-main", ""), weights).split()
    assert set(want) <= set(got) and len(got) <= 1.5 * len(want)


def test_held_out_words_over_all_layouts():
    right = got_all = want_all = 0
    for k, page in enumerate(PAGES):
        stack, want = h.Stack(), Counter()
        for kind, value, attributes in h.tokens(page):
            if kind == "open":
                stack.open(value, "data-main" in attributes or any(stack.marks))
            elif kind == "close":
                stack.close(value)
            elif any(stack.marks):
                want.update(html.unescape(value).split())
        got = Counter(h.extract(page.replace("data-main", ""), h.Weights(PAGES[:k] + PAGES[k + 1 :])).split())
        right, got_all, want_all = right + (got & want).total(), got_all + got.total(), want_all + want.total()
    assert right == want_all and right >= 0.95 * got_all


HELD_OUT = """<!doctype html><html><body class="page">
<div class="skip-link menu"><a href="#m">Menu</a></div><header><a href="/">Site name</a><p>Site claim of the day</p></header>
<ul class="nav nav-main"><li><a href="1">One</a><li><a href="2">Two</a></ul>
<div id="cookie-banner"><p>This site uses cookies &amp; trackers for a better service to you all.</p></div>
<div class="wrapper"><div class="story-body"><h1>Bees &amp; b&eacute;ton</h1><p>First   paragraph with <a href="x">a link</a> and
<b>bold</b>text.<br>Same block.</p><div class="ad-slot"><p>Advert words that nobody should ever keep here</p></div>
<p>Second paragraph &lt;kept&gt; as text, with <!-- no comment --> words.<p>Third, unclosed, paragraph of some words
<script>var x = "<p>not text</p>";</script><style>p{}</style></div>
<div class="sidebar"><p>Some popular stories and other things to read now</p></div></div>
<section id="comments"><h2>3 comments</h2><p>I disagree with all of this and so does my neighbour.</p></section>
<form><p>Write to us with your opinion about this</p><textarea>words</textarea></form><footer><p>All rights reserved 2020</p></footer>"""


def test_held_out_page():
    assert h.extract(HELD_OUT).split("\n\n") == [
        "Bees & béton",
        "First paragraph with a link and boldtext. Same block.",
        "Second paragraph <kept> as text, with words.",
        "Third, unclosed, paragraph of some words",
    ]


def test_article_element_wins():
    page = ("<body><div><p>Some words outside that are fairly many in number</p></div><article><header><h1>Title</h1></header>"
            "<p>x</p><aside><p>also read this</p></aside><p>y</p></article><div><p>after the end of it</p></div></body>")  # fmt: skip
    assert h.extract(page) == "Title\n\nx\n\ny"


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("<p>", ""), ("plain words only", "plain words only"), ("<!-- open", ""), ("<script>x", ""),
    ("a < b and c > d words", "a < b and c > d words"), ("<p>one<p>two", "one\n\ntwo"), ("</div></p>word", "word"),
    ('<p title="a > b">inside</p>', "inside"), ('<p title="open>inside</p>', "inside"), ("<nav>menu words</nav>", ""),
])
def test_odd_pages(page, text):
    assert h.extract(page) == text


def test_long_page_is_linear():
    import time

    began = time.time()
    n = len(h.extract("<article>" + "<p>some words of a paragraph</p>" * 50000 + "<p title=\"" * 200))
    assert n > 1_000_000 and time.time() - began < 20


def test_rows(spark):
    rows = [(1, "u", "<p>a b</p>", 1), (1, "u", "<p>a b</p>", 1), (None, None, None, None), (2, None, "", 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long")
    got = sorted(tuple(r) for r in h.main_text(pages).collect() if r.page_id)
    assert got == [(1, "u", "a b", 3), (1, "u", "a b", 3), (2, None, "", 0)]
    assert h.main_text(pages).count() == 4 and h.main_text(pages.limit(0)).count() == 0


def test_clashing_names(spark):
    rows = [(1, "u", "<p>a b</p>", "x", 7, "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long, TEXT_ string")
    assert [tuple(r) for r in h.main_text(pages).collect()] == [(1, "u", "a b", 3)]


def test_deep_pages_are_linear():
    import time

    began = time.time()
    for opened in ("<div>", "<div><p>", "<td>", "<ul><li>", "<b>", "<section><h1>"):
        assert h.extract(opened * (100_000 // opened.count("<")) + "word") == "word"
    assert time.time() - began < 12


def test_short_article_with_a_long_thread():
    article = "<h1>Mill</h1><p>The mill stands still since the flood of May.</p>"
    thread = "<p>I like the wheel and the miller too.</p>" * 45
    for name in ('class="comments"', 'id="comments"', 'class="replies"', 'class="discussion"'):
        page = f'<body><div class="post">{article}</div><div {name}>{thread}</div></body>'
        assert h.extract(page) == "Mill\n\nThe mill stands still since the flood of May."
    assert h.extract(f'<body><div class="comments">{thread}</div></body>') == ""


def test_menus_without_a_list():
    menu = "".join(f'<a href="{k}">Entry number {k}</a> ' for k in range(30))
    for name in ("nav", "menu", "topnav", "navigation"):
        assert h.extract(f'<body><div class="{name}">{menu}</div><div>{BODY}</div></body>') == "\n\n".join(PROSE)


PROSE = [f"Paragraph {k} tells how the miller of the valley kept the old wheel turning through a dry summer." for k in range(6)]
BODY = "".join(f"<p>{p}</p>" for p in PROSE)
MENU = '<nav class="menu"><a href="/">Home</a> <a href="/a">About</a></nav>'
COMMENTS = '<section class="comments" id="comments"><h3>Comments</h3>' + "<p>I like the wheel and the miller too.</p>" * 40 + "</section>"


@pytest.mark.parametrize("page", [
    f'<body><div id="page" class="hfeed site"><header class="site-header"><p>Claim</p></header>{MENU}<div class="entry-content">{BODY}</div>'
    f"{COMMENTS}</div></body>",
    f'<body><div id="page" class="site"><div><article>{BODY}</article>{COMMENTS}</div></div></body>',
    f'<body><div class="has-sidebar"><main>{BODY}</main><div class="sidebar"><p>Popular</p></div></div></body>',
    f'<body><form id="aspnetForm" method="post">{MENU}<div>{BODY}</div><footer><p>Imprint</p></footer></form></body>',
    f'<body><form>{MENU}<div class="site"><div>{BODY}</div></div></form></body>',
    "<body>" + MENU + "".join(f'<div class="elementor-widget"><div class="elementor-widget-container"><p>{p}</p></div></div>' for p in PROSE),
    f"<html><head><title>Mill</title><meta name=a><body><div>{BODY}</div></body></html>",
    f"<html><head><title>Mill</title><div>{BODY}</div></html>",
    f'<table><tr><td class="menu"><a href="/">Home</a><td>{BODY}</table>',
    f'<table><tr><td class="menu"><a href="/">Home</a><tr><td>{BODY}</table>',
    f"<body><div><select><option>One<option>Two</select>{BODY}</div></body>",
    "<body><div>" + "".join(f'<p title="a hidden gem">{p}</p>' for p in PROSE) + "</div></body>",
    f'<body><div class="relative hidden md:block">{BODY}</div></body>',
    f'<body><div data-css="display: none">{BODY}<p hidden>not seen</p><p style="color:red;display : none">nor this</p>'
    '<p aria-hidden="true">nor that</p></div></body>',
])
def test_wrappers_named_like_furniture(page):
    assert h.extract(page) == "\n\n".join(PROSE)


def test_long_comments_are_no_article():
    assert h.extract(f"<body><div><h1>Mill</h1>{BODY}</div>{COMMENTS}</body>") == "\n\n".join(["Mill", *PROSE])
