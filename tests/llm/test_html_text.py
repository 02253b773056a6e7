"""Main text of pages by hand, and of the given ones against their article element."""

import html
import re

import pytest

from fieldsync.llm.catalog import op9_html_text
from fieldsync.llm.html_text import main_text, with_main_text

LONG = "A paragraph with quite some text in it, as articles have, number"


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("only text &amp; more", "only text & more"),
        ("<p>a<p>b<script>x</script", "a\nb"),
        ("<!-- x --><style>p{}</style>", ""),
        (
            f"<html><head><title>T</title></head><body><header><h1>Site</h1></header><nav><a href=x>Home</a></nav><main><h1>Head&eacute;</h1><p>{LONG}\n 1<p>Short.<div class='ad'>Buy</div>"
            f"<p>{LONG} <b>2<br>on</p><form>Sign up</form></main><aside>{LONG} 3</aside><section id=comments><p>{LONG} 4</section><footer>(c)</footer>",
            f"Headé\n{LONG} 1\nShort.\n{LONG} 2 on",
        ),
        (
            f"<body><div id='cookie-notice'>{LONG} 0</div><div class=page><div id=menu><ul><li><a>One</a><li><a>Two</a></ul></div><div class='post-content'><h2>T</h2><p>{LONG} 1</p><p>End.</p></div></div>"
            f"<div class='sidebar'><p>{LONG} 5</p></div></body>",
            f"T\n{LONG} 1\nEnd.",
        ),
        (f"<article hidden>{LONG}</article><article><p>{LONG} x</p></article>", f"{LONG} x"),
        ("<table><tr><td>a<td>b</table>" + "<div>" * 3000 + "deep", None),
    ],
)
def test_page(page, text):
    made = main_text(page)
    assert text is None or made == text


def test_given_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    for r in op9_html_text(spark, "/root/testdata/sf0.01").collect():
        article = re.search("<article>(.*?)</article>", pages[r.page_id], re.DOTALL)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("<(?:/?p|/?h1)>", article.replace("<br>", " ")))
        assert r.text == "\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (2, "", "a"), (None, "<p>" + "x " * 100_000, "b")]
    made = with_main_text(spark.createDataFrame(rows, "page_id long, html string, url string")).collect()
    assert [(r.page_id, len(r.text)) for r in made] == [(1, 0), (2, 0), (2, 0), (None, 199_999)]
    assert with_main_text(spark.createDataFrame([], "page_id long, html string")).collect() == []


MENU = "<div class=menu><a href=x>Home</a></div>"


@pytest.mark.parametrize(
    "page, text",
    [
        (  # a plain container within a named one
            f"<body>{MENU}<div class='post-content'><p>{LONG} 1<div class='box'><p>{LONG} 2</div><p>{LONG} 3</div><div>Imprint</div>",
            f"{LONG} 1\n{LONG} 2\n{LONG} 3",
        ),
        (  # table cells and sections within a named one
            f"<div class=entry><p>{LONG} 1<table><tr><td>{LONG} 2<td>b</table><section><p>{LONG} 3</section></div>",
            f"{LONG} 1\n{LONG} 2\nb\n{LONG} 3",
        ),
        (  # short sections between long ones, without names
            f"<body>{MENU}<div><section><p>{(LONG + ' ') * 20}1</section><section><p>Short.</section><section><p>{(LONG + ' ') * 20}3</section></div><div><a href=y>Imprint</a></div>",
            f"{(LONG + ' ') * 20}1\nShort.\n{(LONG + ' ') * 20}3",
        ),
        (  # lists of links and linked references in an article
            f"<article><p>{LONG} 1<ul><li><a href=a>Reference one</a><li><a href=b>Reference two</a></ul><p><a href=c>{LONG} 2</a></article><div><a href=y>Imprint</a></div>",
            f"{LONG} 1\nReference one\nReference two\n{LONG} 2",
        ),
        (f"<main><p>{LONG} 1<article><p>{LONG} 2</article></main><div>Imprint</div>", f"{LONG} 1\n{LONG} 2"),
        (f"<article><p>{LONG} 1</article><div>Imprint</div><article><p>{LONG} 2</article>", f"{LONG} 1\n{LONG} 2"),
    ],
)
def test_regions_are_whole(page, text):
    assert main_text(page) == text


ARTICLE = f"<h1>Head</h1><p>{LONG} 1</p><p>Short.</p><p>{LONG} 2</p>"
TEXT = f"Head\n{LONG} 1\nShort.\n{LONG} 2"


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<body><div class='layout has-sidebar'>{MENU}<div>{ARTICLE}</div></div>", TEXT),
        (f"<body><div id='page' class='site no-sidebar'><div>{ARTICLE}</div><div class=sidebar><p>{LONG}</div></div>", TEXT),
        (f"<body>{MENU}<div class='article share-enabled'>{ARTICLE}</div><div class=widget>{LONG}</div>", TEXT),
        (f"<body><form id='aspnetForm'>{MENU}<div>{ARTICLE}</div></form>", TEXT),
        (f"<body><div class='widget-page'><div class=promo>{LONG}</div><div>{ARTICLE}</div></div>", TEXT),
        (f"<body><div class='form-wrapper'>{ARTICLE}<form>Sign up</form><div id=comments><p>{LONG * 30}</div></div>", TEXT),
        (f"<body><div><a href=x>Home</a><a href=y>About</a></div><div><p>{LONG} 1</div><div><p>{LONG} 2</div><div><a href=z>Imprint</a></div>", f"{LONG} 1\n{LONG} 2"),
        (f"<body><article class='related-post'>{ARTICLE}</article><div class='related'>{LONG}</div>", TEXT),
    ],
)
def test_names_are_no_verdict(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page", ["<b>" * 200_000 + "x" + "</i>" * 200_000, "<b><div>" + "<i>" * 100_000 + "x" + "</b>" * 100_000, "<i>" * 100_000 + "<p>x</p>" * 100_000, "x<!-- " + "y" * 8_000_000, "<li><b>" * 100_000])
def test_hostile_pages_take_linear_time(page):
    import time

    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 30
