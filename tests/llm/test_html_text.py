"""Main text of hand-made pages, alone and by their host's consensus."""

import time

import pytest

from stmtscope.llm import html_text
from stmtscope.llm.html_text import Page, main_texts

MENU = '<nav><ul><li><a href="/a">Menu one</a></li></ul></nav>'
BODY = "<p>The first paragraph is long enough to count as text &amp; more.</p><p>Second   one<br>here &lt;b&gt; with <a href='x'>a link</a>."
WANT = "The first paragraph is long enough to count as text & more.\n\nSecond one here <b> with a link."


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<html><head><title>T</title><script>x('</p>')</script></head><body>{MENU}<article><h1>T &copy;</h1>{BODY}</article><footer>&copy; f</footer>", f"T ©\n\n{WANT}"),
        (f"<body><header>Site</header><div class='post-12'>{BODY}<div class='ad'>Buy now, it is so very cheap today only</div></div><div id=sidebar><p>side</p></div>", WANT),
        (f"<div class=content><!-- <p>no</p> --><form><p>f</p></form>{BODY}</p><section class=comments><p>Nice post, I liked it very much indeed, thanks</p></section></div>", WANT),
        (f"<main><div hidden>secret</div><style>p {{}}</style>{BODY}</main><aside>{BODY}</aside>", WANT),
        ("", ""),
        ("<p>bare</p> text 1 < 2 &amp", "bare\n\ntext 1 < 2 &"),
        ("<script>only()", ""),
        ("<a href='x", ""),
        ("﻿<p>  </p>", "﻿"),
    ],
)
def test_one_page(html, text):
    page = Page(html)
    assert page.text(page.best_path()) == text


@pytest.mark.parametrize("heavy_hosts", [1000, 0])
def test_consensus(spark, monkeypatch, heavy_hosts):
    monkeypatch.setattr(html_text, "HEAVY_HOSTS", heavy_hosts)
    page = "<body><div class='story'>{}</div><div class='box9'>{}</div></body>"
    long, short = "Story words that go on and on for the whole of a line. ", "Box words. "
    rows = [(i, f"http://h.com/{i}", page.format(long * 3, short)) for i in range(8)]
    # On this page the box is the longest part; the host's other pages tell what it is.
    rows.append((8, "https://H.com/odd", page.format(long, short * 60)))
    rows.append((9, "http://h.com/else", "<body><article><p>Another layout.</p></article></body>"))
    rows += [(10, None, "<p>no url</p>"), (None, "http://h.com/n", None), (11, "nonsense", ""), (11, "nonsense", "")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, path string").repartition(4)
    got = main_texts(pages).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    assert by_id[8].text == long.strip()
    assert by_id[9].text == "Another layout." and by_id[10].text == "no url"
    assert by_id[None].text == "" and by_id[11].text == ""
    assert all(r.n_chars == len(r.text) for r in got)
    assert main_texts(pages.where("false")).collect() == []


ARTICLE = "<p>The only article of this page has a sentence or two.</p><p>And it ends here, after some more words.</p>"
ARTICLE_TEXT = "The only article of this page has a sentence or two.\n\nAnd it ends here, after some more words."


@pytest.mark.parametrize(
    "html",
    [
        f"<body><div class='content has-sidebar'>{ARTICLE}</div></body>",
        f"<body><div class='wrap no-sidebar'>{ARTICLE}</div></body>",
        f"<body><div class='page-with-menu'>{ARTICLE}</div></body>",
        f"<body><div class='post share-enabled'>{ARTICLE}</div></body>",
        f"<body><div class='has-header'><article>{ARTICLE}</article></div></body>",
        f"<body><form action=x>{MENU}<div>{ARTICLE}</div></form></body>",
        f"<body><div class=menu><main>{ARTICLE}</main></div></body>",
        f"<body><div class=popup>{ARTICLE}</div><p>x</p></body>",
    ],
)
def test_wrappers_keep_the_article(html):
    assert Page(html).main_text(None) == ARTICLE_TEXT
    assert Page(html).main_text(["/html/body/other"]) == ARTICLE_TEXT


@pytest.mark.parametrize(
    "html",
    [
        f"<body><article>{ARTICLE}</article><div class='site-menu'>Home About us</div></body>",
        f"<body><article>Short.</article><div class='ad'>{ARTICLE}</div></body>",
        f"<body><div class=story>{ARTICLE}</div><div class='cookie-banner'>We use cookies</div><form>Your name</form></body>",
    ],
)
def test_named_parts_go(html):
    assert Page(html).main_text(None) in (ARTICLE_TEXT, "Short.")


def test_formulas_stay():
    assert Page("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be.</p></article>").main_text(None) == "Let x=2 be."


def test_a_host_with_two_templates(spark):
    one = "<body><article>Long words of an article that go on, number {0}. And on.</article><div class=box>Teaser</div></body>"
    two = "<body><article>Teaser</article><section class=essay><p>An essay of many words stands here instead, number {0}.</p></section></body>"
    rows = [(i, "http://h.com/", (one if i < 12 else two).format(i)) for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_texts(pages).collect()}
    assert all(f"number {i}." in got[i] for i in range(20))
    assert not any("Teaser" in t for t in got.values())


@pytest.mark.parametrize("part", ["<a ", '<a b="', "<div class='x", "</section>", "<div>", "<body>", "<!--", "<script ", "&"])
def test_broken_markup_is_read_in_linear_time(part):
    source = "<div>" * 2000 + part * (2_000_000 // len(part))
    begin = time.perf_counter()
    Page(source).main_text(None)
    assert time.perf_counter() - begin < 10


def test_long_page():
    html = "<article>" + "<p>word</p>" * 20_000 + "<div>" * 3000 + "deep" + "</article>"
    page = Page(html)
    assert page.text("/article").count("\n\n") == 20_000
