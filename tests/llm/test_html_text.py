import time
from html.parser import HTMLParser

import pytest

from sparkwarden.llm import html_text as H
from sparkwarden.llm.common import table

BODY = "<p>First, a sentence of some length, with commas, and more.</p><p>Second &amp; last&nbsp;one,\n\n of&#32;them &copy; all.</p>"
WANT = "First, a sentence of some length, with commas, and more.\nSecond & last one, of them © all."

CASES = {
    "article": (f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><a href=/>Home</a></nav><article><h1>Head</h1>{BODY}</article><footer>(c)</footer>", "Head\n" + WANT),
    "unclosed": (f"<div id=content><h2>Head</h2><p><b>Bold<br><p>Next {BODY}", "Head\nBold\nNext\n" + WANT),
    "sidebar": (f"<div class='wrap content-with-sidebar'><div class=text>{BODY}</div><div class=sidebar><p>Buy, buy, buy, now, and again, please.</p></div></div>", WANT),
    "comments": (f"<main>{BODY}<section id=comments><p>I, for one, disagree, strongly, with all of it.</p></section><div class=article-comments><p>x</p></div></main>", WANT),
    "adverts": (f"<article><!-- ad --><div class='ad'><p>Cheap, cheap, cheap.</p></div>{BODY}<div class=ad-slot>x</div></article>", WANT),
    "scripts": (f"<script>var t='</p>';</script><div>{BODY}<script>if (a<b) x('<p>no</p>')</script><noscript>no</noscript></div>", WANT),
    "form and header": (f"<header><p>Site, name, and, slogan.</p></header><div>{BODY}<form><p>Your, name, please.</p><input name=x></form></div>", WANT),
    "menu without a name": (f"<div><div><a href=a>One</a> <a href=b>Two</a> <a href=c>Three</a></div><div>{BODY}</div></div>", WANT),
    "article header": (f"<article><header><h1>Head</h1></header>{BODY}</article>", "Head\n" + WANT),
    "list and quote": (f"<article>{BODY}<ul><li>one<li>two <b>bold</b></ul><blockquote>said</blockquote></article>", WANT + "\none\ntwo bold\nsaid"),
    "table": (f"<article>{BODY}<table><tr><td>a<td>b<tr><td>c</table></article>", WANT + "\na\nb\nc"),
    "hidden": (f"<article>{BODY}<p hidden>no</p><div style='display: none'>no</div></article>", WANT),
    "no markup": ("just  text\n here", "just text here"),
    "null": (None, ""),
    "empty": ("", ""),
    "only markup": ("<div><p></p></div>", ""),
    "open comment": (f"<div>{BODY}</div><!-- never closed <p>no, no, no</p>", WANT),
    "two sections": (f"<section><h2>One</h2>{BODY}</section><section><h2>Two</h2><p>Short.</p></section>", f"One\n{WANT}\nTwo\nShort."),
    "closing remark": (f"<div>{BODY}</div><div>Plain closing remark.</div>", WANT + "\nPlain closing remark."),
    "open menu": (f"<nav><a href=x>Home</a><article>{BODY}</article><nav><a href=y>Up</a></nav>", WANT),
    "open advert in main": (f"<main><div class=ad>Buy, buy<p>now<article>{BODY}</article></main>", WANT),
    "teaser in a closed aside": (f"<aside><article><p>Other, text, here.</p></article></aside><div>{BODY}</div>", WANT),
    "quotes in tags": (f"<div title='a > b' class=\"x\">{BODY}</div>", WANT),
    "open quote": (f"<div>{BODY}</div><p>x <a title=\"y</p>", WANT + '\nx <a title="y'),
    "link in prose": ("<article><p>See, for this, <a href=x>the page</a>, and more.</p></article>", "See, for this, the page, and more."),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text(name):
    page, want = CASES[name]
    assert H.main_text(page) == want


def test_long_and_deep_pages():
    text = ", ".join(["word"] * 200_000)
    assert H.main_text(f"<article><p>{text}</p></article>") == text
    assert H.main_text("<div>" * 3000 + "deep, text") == "deep, text"
    assert H.main_text("<b>" * 3000 + "<" * 3000)


HOSTILE = [
    "<a ", "<ul><li>", "<b><div>", '<a "', "<a \"'", "<!", "</script ", "<script></script ", "<nav><article>", "<p>", "<p><b>", "<!--->x",
    "<a href=x>", "<dl><dt>", "<table><tr><td>", "&lt", "<h1><section>", "<div class=ad>",
]


@pytest.mark.parametrize("part", HOSTILE)
def test_time_grows_with_the_page(part):
    """A square would take minutes here."""
    for tail in ("", ">", '"'):
        begin = time.process_time()
        H.main_text(part * (200_000 // len(part)) + tail)
        assert time.process_time() - begin < 8


def test_headings_below_a_deep_wall():
    begin = time.process_time()
    H.main_text("<h1><section>" + "<b>" * 40_000 + "<h2></h2>" * 15_000)
    assert time.process_time() - begin < 8


class ArticleOnly(HTMLParser):
    """Another way to the text of pages that mark their article: all blocks inside it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.lines = 0, [""]

    def handle_starttag(self, tag, attributes):
        self.depth += tag == "article"
        if tag in ("p", "h1", "div"):
            self.lines.append("")
        if tag == "br":
            self.lines[-1] += " "

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        if tag in ("p", "h1", "div"):
            self.lines.append("")

    def handle_data(self, data):
        if self.depth:
            self.lines[-1] += data


def test_whole_table_against_another_parser(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages").collect()
    found = {r.page_id: r.text for r in H.op3_html_text(spark, "/root/testdata/sf0.01").collect()}
    assert len(found) == len(pages) > 100
    for page in pages:
        parser = ArticleOnly()
        parser.feed(page.html or "")
        assert found[page.page_id] == "\n".join(x for x in (" ".join(line.split()) for line in parser.lines) if x)


def test_rows(spark):
    page = CASES["article"][0]
    rows = [(1, "u", page, "x"), (1, "u", page, "y"), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in H.extract(pages, ["page_id", "url"]).collect()), key=str)
    want = "Head\n" + WANT
    assert got == [(1, "u", want, len(want))] * 2 + [(None, None, "", 0)]
    assert H.extract(pages.limit(0), ["page_id", "url"]).count() == 0
