"""HTML extraction against the articles of the test pages, cut out another way, and on odd pages."""

import html
from html.parser import HTMLParser

import pytest

from shoplens.llm import html_text
from shoplens.llm.queries import QUERIES
from tests.conftest import SF_CHECK


class Article(HTMLParser):
    """Text inside <article>, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.pieces = False, []

    def handle_starttag(self, tag, attrs):
        self.inside = self.inside or tag == "article"
        self.pieces.append("" if tag == "b" else " ")

    def handle_endtag(self, tag):
        self.inside = self.inside and tag != "article"
        self.pieces.append("" if tag == "b" else " ")

    def handle_data(self, data):
        if self.inside:
            self.pieces.append(data)


def article(source):
    p = Article()
    p.feed(source or "")
    p.close()
    return " ".join("".join(p.pieces).split())


def pages_table(spark, rows):
    """(page_id, url, html) and columns whose names clash with outputs and helpers."""
    return spark.createDataFrame([(*r, "t", 1, "h", "p") for r in rows],
                                 "page_id bigint, url string, html string, text string, n_chars int, host string, path string")


def extracted(spark, rows):
    out = html_text.extract(pages_table(spark, rows)).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in out)
    return sorted((r["page_id"], r["text"]) for r in out if r["page_id"] is not None)


def test_query_finds_the_articles_of_all_pages(spark):
    want = {(r["page_id"], r["url"], article(r["html"]), len(article(r["html"])))
            for r in spark.read.parquet(f"{SF_CHECK}/pages.parquet").collect()}
    df = QUERIES["op13_html_extraction"](spark, SF_CHECK)
    assert df.dtypes[:4] == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    rows = df.collect()
    assert {tuple(r)[:4] for r in rows} == want and len(rows) == len(want)
    assert all(r["by_host"] for r in rows)


BODY = "<h1>Title</h1><p>First &amp; best,   of\n them &lt;all&gt;.</p><p>Second<br>line <b>bo</b>ld &#8212; &eacute;nd</p>"
TEXT = "Title First & best, of them <all>. Second line bold \u2014 \u00e9nd"


@pytest.mark.parametrize("page", [
    f"<article>{BODY}</article>",
    f"<body><nav><a href=/>Home</a></nav><main>{BODY}</main><footer>&copy; x</footer></body>",
    f"<div class='menu'><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div><div class=content>{BODY}</div>",
    f"<aside>Side words here</aside><article>{BODY}<section id=comments><p>Reader: no!</p></section></article>",
    f"<div class=\"cookie-notice\"><p>{'We use cookies. ' * 40}</p></div><article>{BODY}<div class=ad>Buy</div></article>",
    f"<article><script>var a='<p>x</p>';</script><style>p{{}}</style>{BODY}<form><input><label>Mail</label></form></article>",
    f"<article><!-- <p>hidden</p> -->{BODY}<p hidden>not shown</p><span class='share'>Share</span></article>",
    f"<html><body><div class='content no-sidebar'>{BODY}</div>",
    f"<header><p>Site</p></header><article>{BODY.replace('</p>', '')}</article>",
    f"<nav><li>never closed<article title='a > b' data-class='ad'>{BODY}</article>",
    f"<div class=page><div class=wrap><article>{BODY}</article></div><div class=sidebar-1>x</div></div>",
])
def test_parts_left_out(page):
    assert html_text.main_text(page)[0] == TEXT


def test_hosts_agree_on_a_path(spark):
    """A page whose own best container is another one follows its host."""
    def usual(i):
        return f"<div class=b{i}><p>{'main words ' * 20}</p></div><div class=x><p>short</p></div>"
    odd = "<div class=b9><p>few</p></div><div class=x><p>" + "long extra text " * 30 + "</p></div>"
    rows = [(i, f"http://A.example/{i}", usual(i)) for i in range(9)] + [(9, "https://u@a.example:80/9", odd)]
    out = dict(extracted(spark, rows))
    assert out[9] == "few" and out[3] == ("main words " * 20).strip()
    assert html_text.main_text(odd)[0].startswith("long extra")
    # on a host of its own the page decides; without the host's container, too
    other = [(9, "https://b.example/9", odd), *rows[:9], (10, "http://a.example/", "<article><p>else</p></article>")]
    out = dict(extracted(spark, other))
    assert out[9].startswith("long extra") and out[10] == "else"


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "", ""), (3, "no url", "plain &amp; text"), (3, "no url", "plain &amp; text"), (4, "http://h/", "<<p>a<b"),
            (5, "http://h/", "<script>never closed <p>x</p>"), (6, "http://h/", "<div class=ad>only this</div>"), (None, None, "<p>x"),
            (7, "http://h/", "<p a=\"unclosed>x</p><p>y</p>"), (8, "http://h/", "<!-- open"), (9, "http://h/", "<div>" * 500 + "deep"),
            (10, "x://l", "<article>" + "<p>word &amp; more</p>" * 50_000 + "</article>")]
    out = extracted(spark, rows)
    assert len(out) == 11
    assert out[0] == (1, "") and out[1] == (2, "") and out[2] == out[3] == (3, "plain & text")
    got = dict(out)
    assert got[5] == "" and got[6] == "only this" and got[8] == "" and got[9] == "deep"
    assert got[10] == " ".join(["word & more"] * 50_000)


def test_empty_table(spark):
    assert html_text.extract(pages_table(spark, [])).collect() == []


def test_character_references():
    for ref in ("&nbsp;", "&amp;amp;", "&#x41;", "&notaname;", "&copy"):
        assert html_text.main_text(f"<p>a{ref}b</p>")[0] == " ".join(f"a{html.unescape(ref)}b".split())
