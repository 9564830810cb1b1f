"""Main text against pages built from known parts, over several site layouts."""

from __future__ import annotations

import html
import random
import re

import pytest
from llm_cases import SF001
from pyspark.sql import functions as F

from fraudmart.llm import html_extract as hx
from fraudmart.llm.common import read

PAGES = "page_id long, url string, html string"
WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike".split()


def sentence(rnd, n=18):
    return " ".join(rnd.choice(WORDS) for _ in range(n)).capitalize() + "."


def article(rnd, n=5):
    return [sentence(rnd, rnd.randint(8, 40)) for _ in range(n)]


def ps(parts):
    return "".join(f"<p>{html.escape(t)}</p>" for t in parts)


JUNK = ('<header><h1>Site</h1></header><nav><ul><li><a href=/a>News today</a><li><a href=/b>Sport</a></ul></nav>'
        '<div class="cookie-notice">We use cookies to make this site better for you and your friends.</div>')
TAIL = ('<aside><p>Aside text that tells about other things at some length.</p></aside>'
        '<form><p>Name</p><input><textarea>type here</textarea><button>Send</button></form>'
        '<footer>&copy; All rights reserved by the site and its owners.</footer><script>var a="</p><p>no";</script>')


def comments(rnd, kind, n):
    return f'<section class="{kind}">' + "".join(
        f'<article class="comment-{i}"><p>{sentence(rnd, 30)}</p></article>' for i in range(n)) + "</section>"


def layouts(rnd, parts, i):
    body = ps(parts)
    yield f"<html><head><title>t</title></head><body>{JUNK}<article>{body}</article>{comments(rnd, 'comments', 9)}{TAIL}</body></html>"
    yield f'{JUNK}<div class="wrap-{i}"><div class="post-{i} x"><div class=text>{body}</div></div><div class="sidebar">{ps(article(rnd, 3))}</div></div>{TAIL}'
    yield f'<body class="has-sidebar"><table><tr><td id=left><ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul><td id=body{i}>{body}</table>{TAIL}'
    yield f'<BODY>{JUNK}<MAIN><SECTION>{ps(parts[:2])}</SECTION><!-- <p>no</p> --><SECTION>{ps(parts[2:])}</SECTION></MAIN>{TAIL}'


@pytest.mark.parametrize("kind", range(4))
def test_layouts_by_consensus(spark, kind):
    rnd, rows, want = random.Random(kind), [], {}
    for i in range(40):
        parts = article(rnd, rnd.randint(2, 7))
        rows.append((i, f"https://Host{kind}.example/{i}?q=1", list(layouts(rnd, parts, i))[kind]))
        want[i] = " ".join(parts)
    out = {r["page_id"]: r["text"] for r in hx.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert out == want


def test_the_host_outvotes_a_page_with_long_unnamed_replies(spark):
    rnd, rows = random.Random(5), []

    def page(parts, extra):
        return f'{JUNK}<div class="a1">{ps(parts)}</div><div class="b2">{ps(extra)}</div>{TAIL}'

    for i in range(12):
        rows.append((i, "http://h.example/x", page(article(rnd, 8), [sentence(rnd, 9)])))
    short = article(rnd, 2)
    odd = page(short, article(rnd, 30))
    rows.append((99, "http://h.example/odd", odd))
    out = {r["page_id"]: r["text"] for r in hx.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert out[99] == " ".join(short)
    assert hx.extract(odd) != out[99]  # the page alone cannot tell


def test_text_rules():
    def text(x):
        return hx.extract(f"<body><article>{x}</article>")
    assert text("<p>A&amp;amp;B &lt;i&gt; &#8364;&nbsp;5</p>") == "A&amp;B <i> € 5"
    assert text("<p>one\n two\t<b>th</b>ree<br>four<p>five") == "one two three four five"
    assert text("<p>1 < 2 and <3</p><p>a<span class=ad>BUY</span> b</p>") == "1 < 2 and <3 a b"
    assert text("<ul><li>x<li>y</ul><dl><dt>t<dd>d</dl><pre> k  l </pre>") == "x y t d k l"
    assert text("<p style='display: none'>no</p><p hidden>no</p><p>yes</p>") == "yes"
    assert text('<p title="a > b">q</p></div></b><p>r') == "q r"
    assert text("<header><h1>Title</h1></header><p>t</p><footer>f</footer>") == "Title t"
    assert text("<p>see <a href=x>this one</a></p><ul><li><a>One</a><li><a>Two</a><li><a>Three</a></ul>") == "see this one"
    assert hx.extract(None) == hx.extract("") == hx.extract("<p></p>") == ""
    assert hx.extract("plain text only") == "plain text only"
    assert hx.extract("<p>a</p><script>never ends <p>b") == "a"
    assert hx.extract("<p>a</p><!-- never ends <p>b") == "a"
    assert hx.extract('<form action=x><p>One long paragraph of text.</p><p>Two more words.</p><p>Three.</p></form>').startswith("One")


def test_long_and_broken_pages_end():
    assert len(hx.extract("<p>word " * 20000)) == 5 * 20000 - 1
    assert hx.extract("<div>" * 3000 + "deep text") == "deep text"
    hx.extract('<a href="' * 3000)
    hx.extract("<!--" * 5000)
    hx.extract("<" * 50000 + "&" * 50000)


def test_odd_rows_and_clashing_columns(spark):
    page = "<article><p>Some article text that is long enough.</p></article>"
    rows = [(1, None, page), (2, "http://x.example/", None), (3, "http://x.example/", ""), (3, "http://x.example/", ""),
            (None, "::bad url", page), (4, "", page), (5, "http://x.example/", page), (None, None, None)]
    pages = spark.createDataFrame(rows, PAGES).withColumns({"host": F.lit("h"), "path": F.lit("p"), "text": F.lit("t"),
                                                            "share": F.lit(1), "score": F.lit(2)})
    text = "Some article text that is long enough."
    out = sorted((r["page_id"] or 0, r["url"] or "", r["text"]) for r in hx.main_text(pages).collect())
    assert out == sorted((r[0] or 0, r[1] or "", text if r[2] == page else "") for r in rows)
    assert hx.main_text(spark.createDataFrame([], PAGES)).count() == 0


def test_shared_pages_equal_their_articles(spark):
    pages = read(spark, SF001, "pages")

    def plain(source):
        inner = re.search(r"<article>(.*?)</article>", source, re.S)[1]
        spaced = re.sub(r"<(/?p|br|/?h1)\b[^>]*>", " ", inner)
        return " ".join(html.unescape(re.sub(r"<[^>]*>", "", spaced)).split())

    want = {r["page_id"]: plain(r["html"]) for r in pages.collect()}
    out = hx.main_text(pages)
    assert {r["page_id"]: r["text"] for r in out.collect()} == want
    assert [r["path"] for r in hx.host_paths(pages).select("path").distinct().collect()] == ["body>article"]
