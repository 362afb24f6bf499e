import re
import time
from html import unescape
from itertools import product

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import html_text


def cost(odds, edges, side):
    own = sum(max(w, 0) if not s else max(-w, 0) for w, s in zip(odds, side, strict=True))
    return own + sum(w for a, b, w in edges if side[a] != side[b])


weights = st.integers(-6, 6).map(lambda x: x / 2)


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_cut_is_minimal(data):
    odds = data.draw(st.lists(weights, min_size=1, max_size=8))
    node = st.integers(0, len(odds) - 1)
    edges = data.draw(st.lists(st.tuples(node, node, st.integers(1, 6).map(lambda x: x / 2)), max_size=14))
    edges = [(a, b, w) for a, b, w in edges if a != b]
    best = min(cost(odds, edges, side) for side in product([False, True], repeat=len(odds)))
    assert abs(cost(odds, edges, html_text.minimum_cut(odds, edges)) - best) < 1e-6
    assert abs(cost(odds, edges, html_text._max_flow_side(odds, edges)) - best) < 1e-6


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>no</article>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1><p>Your daily news, every day of the week and more.</p></header>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav>
<div class="cookie-notice">We use cookies to make this site work better for all of our readers.</div>
<!-- <p>hidden</p> --><div id="main-content"><h1>A&nbsp;title &amp; more</h1>
<p>First <b>para</b>graph  with
 a <a href="x">link</a> and "a &lt; b", which is long enough to be told from a menu.<p>Yes.
<p>Another paragraph follows here<br>with two lines, and it is of good length as well.</p>
<div class="ad-slot">Buy now! The best offers of the whole year wait for you.</div>
<p>The last words.</p></div>
<aside class="related"><h3>Related</h3><p>Some other article of which this is the summary line, to be read later.</p></aside>
<section id="comments"><h2>Comments</h2><p>I think this is a very good article, thank you for writing all of it.</p></section>
<form><p>Leave a reply, please fill in all of the fields below and press send.</p><textarea>draft</textarea></form>
<footer><p>Copyright 2024, all rights reserved by the owner of this site.</p></footer></body></html>"""


def test_a_page_without_an_article_element():
    assert html_text.main_text(PAGE) == (
        'A title & more First paragraph with a link and "a < b", which is long enough to be told from a menu. Yes. '
        "Another paragraph follows here with two lines, and it is of good length as well. The last words."
    )


def test_odd_pages():
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p></p>") == ""
    assert html_text.main_text("<article>a<p>b<p>c</article><footer>d") == "a b c"
    assert html_text.main_text('<article><p title="a > b" class=\'x>\'>one</p>two</article>') == "one two"
    assert html_text.main_text("<article>x <script>never closed") == "x"
    assert html_text.main_text("<article>5 < 6 &copy &unknown; &#8364;&#x20AC;</article>") == "5 < 6 © &unknown; €€"
    assert html_text.main_text("<article><p>Short.</p></article><nav>" + "<li><a>x</a>" * 20_000 + "</nav>") == "Short."
    long = "<article>" + "<p>word of a text</p>" * 50_000 + "</article>"
    assert html_text.main_text(long) == " ".join(["word of a text"] * 50_000)
    assert len(html_text.main_text("<div>" * 20_000 + "some text that is long enough, it should be. " * 5)) > 100


def test_pages_give_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.row.page_id: r for r in html_text.extract(pages, ["page_id", "url"]).collect()}
    for page in pages.collect():
        article = re.search(r"<article>(.*)</article>", page.html, re.S)[1]
        blocks = [re.sub(r"</?b>", "", b) for b in re.split(r"</?(?:p|h1|br)>", article)]
        expected = " ".join(" ".join(unescape(b).split()) for b in blocks if b.strip())
        got = found[page.page_id]
        assert (got.text, got.n_chars, got.row.url) == (expected, len(expected), page.url)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "u", None, "t"), (1, "u", None, "t"), (None, None, "<article>x", None), (2, "u", "", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html_text.extract(pages, ["page_id", "text"]).collect()
    assert sorted((str(r.row.page_id), r.row.text or "", r.text, r.n_chars) for r in found) == [
        ("1", "t", "", 0), ("1", "t", "", 0), ("2", "t", "", 0), ("None", "", "x", 1)
    ]
    assert html_text.extract(pages.limit(0), ["page_id"]).count() == 0


def test_elements_that_are_not_closed_or_only_begin_like_hidden_ones():
    for start in ("<video-js id=a>", "<video-player>x</video-player>", "<select-box>", "<template-x>", "<svg-icon>"):
        assert html_text.main_text(f"<article><p>one {start}</p><p>two</p></article>").endswith("two")
    for name in ("video", "audio", "canvas", "select", "svg", "object", "template", "noscript"):
        page = f"<article><p>one</p><{name} src='x'><p>two</p></article><article>three <{name}>no</{name}> four</article>"
        assert html_text.main_text(page) == "one two three four"
        assert html_text.main_text(f"<article>one <{name}>no <p>no</{name}> two<{name}/> three</article>") == "one two three"
    assert html_text.main_text("<article>one<template><article>no</article></template> two</article>") == "one two"
    assert html_text.main_text("<article>one<svg><svg>no</svg>no</svg> two<script>no</script x> three</article>") == "one two three"
    assert html_text.main_text("<article>" + "<p>a<svg><video>" * 20_000 + "</article>") == " ".join("a" * 20_000)


def test_wrappers_of_the_article_do_not_make_it_boilerplate():
    article = "<article><h1>Title</h1><p>A paragraph of the text, of a good length.</p><p>Short</p></article>"
    text, nav = "Title A paragraph of the text, of a good length. Short", "<nav><a href=x>Home</a></nav>"
    for name in ("has-sidebar", "no-sidebar", "with-header", "menu-open", "page-legal", "content no-comments", "search forms"):
        assert html_text.main_text(f"<body>{nav}<div class='{name}'>{article}</div></body>") == text
        assert html_text.main_text(f"<div id=x class='{name}'><section class='{name}'>{nav}{article}</section></div>") == text
        assert html_text.main_text(f"<div class='{name}'>{article}</div><div class='{name}'>{article}</div>") == f"{text} {text}"
    main = article.replace("article", "main")
    assert html_text.main_text(f"<form id=aspnet>{nav}{main}<footer>All rights reserved.</footer></form>") == text
    teaser = "<article><h2>Other</h2><p>What another page is about.</p></article>"
    for other in (f"<aside>{teaser}</aside>", f"<section id=comments>{teaser}</section>", f"<div class=related-posts>{teaser}</div>"):
        assert html_text.main_text(f"<div class=has-sidebar>{article}{other}</div>") == text
        assert html_text.main_text(f"<div class=has-sidebar>{article}</div>{other}") == text
        page = f"<div id=content><p>{'Long sentences of the page itself. ' * 9}</p></div>{other}"
        assert html_text.main_text(page) == ("Long sentences of the page itself. " * 9).strip()


def test_short_pages_without_marks_are_content():
    assert html_text.main_text("<div><h1>Title</h1><p>Tiny.</p><p>Also tiny.</p></div>") == "Title Tiny. Also tiny."
    assert html_text.main_text("<ul><li>Mix.</li><li>Bake.</li><li>Eat</li></ul>") == "Mix. Bake. Eat"
    page = "<nav><a href=x>Home</a></nav><div><p>Tiny.</p></div><footer>All rights reserved.</footer>"
    assert html_text.main_text(page) == "Tiny."


def test_broken_markup_takes_linear_time():
    for unit in ("<script ", "<a ", "<select ", "<select '", "<a '>", "</script ", "<!-- ", "<a x='>'<"):
        for tail in ("", ">", '">'):
            start = time.perf_counter()
            html_text.main_text("<article>x</article>" + unit * (4_000_000 // len(unit)) + tail)
            assert time.perf_counter() - start < 10, (unit, tail)
    start = time.perf_counter()
    html_text.main_text("<div>" * 200_000 + "</section>" * 200_000)
    assert time.perf_counter() - start < 10
    assert html_text.main_text("<article>one <!-- two") == "one"
    assert html_text.main_text("<article>one <a two") == "one <a two"


def test_weights_are_the_likeliest():
    rng = np.random.default_rng(5)
    x = np.column_stack([np.ones(300), rng.integers(0, 3, 300), rng.random((300, 2)), rng.integers(0, 2, 300)])
    y, count = rng.integers(0, 2, 300), rng.integers(1, 4, 300).astype(float)

    def loss(w):
        n = count * 200 / np.bincount(y, count)[y]
        own = (n * np.logaddexp(0, np.where(y == 1, -1, 1) * (x @ w))).sum()
        return own + ((w - np.array(html_text.PRIOR)) ** 2).sum() / (2 * html_text.VARIANCE)

    best = np.array(html_text.most_likely(x, y, count))
    for i, step in product(range(5), (-0.01, 0.01)):
        assert loss(best) < loss(best + step * np.eye(5)[i])
    assert html_text.most_likely(x, np.ones(300, int), count) == html_text.PRIOR


def test_weights_learnt_from_marked_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    weights = html_text.fit(pages)
    assert weights == html_text.fit(pages.repartition(7))
    assert weights != html_text.PRIOR and weights.boiler < -5
    assert html_text.fit(pages.limit(0)) == html_text.fit(pages.selectExpr("'<p>x' html")) == html_text.PRIOR
    for page in pages.collect():
        article = html_text.main_text(page.html)
        assert html_text.main_text(page.html, weights) == article
    bare = [re.sub("</?article>", "", p.html) for p in pages.collect()]
    alone = [html_text.main_text(p.html) for p in pages.collect()]
    same = sum(html_text.main_text(p, weights) == text for p, text in zip(bare, alone, strict=True))
    assert same >= 0.9 * len(bare), same
