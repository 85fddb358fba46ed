"""Main text of pages: made pages of several builds, and the given ones by their markup."""

from __future__ import annotations

import html
import random
import re
from pathlib import Path

import pytest

from kinbridge.llm import main_text
from kinbridge.llm.catalog import QUERIES

DATA = "/root/testdata/sf0.001"

TOP = """<!DOCTYPE html><html><head><title>T &amp; x</title><meta charset=utf-8>
<style>p{}</style></head><body class="home with-sidebar"><header class="site"><h1>Site</h1>
<nav><a href=/>Home</a></nav></header><div id="cookie-notice">We use cookies, accept them all
please now.</div><div class="menu"><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div>"""
ARTICLE = """<h2>The &quot;big&quot; title</h2><div class="byline">By A. Writer</div>
<p>First   paragraph with a <a href=x>link here</a> and
 more text that goes on &mdash; for a while, and then some.</p><script>var a="<p>no</p>";</script>
<p>Second one is long as well<br>and breaks, with <em>some</em><b>bold</b> words in it<!-- no > -->.
<p>Third unclosed, 3 &lt; 4 a < b, with enough words to count as text.<ul><li>item one<li>item two
</ul><blockquote>Quote of someone, rather long.</blockquote><table><tr><td>a<td>b<tr><td>c</table>"""
TAIL = """<aside class="sidebar"><p>About us, some words in here that are long enough to be dense.
</p></aside><section id="comments"><h3>Comments</h3><div class="comment"><p>Great article, I really
liked it, it is so long and dense that it could be text too, yes indeed.</p></div></section>
<div class="newsletterSignup"><form><input><button>Go</button></form></div>
<div class="advertisement">Buy now this very nice thing.</div>
<footer><p>&copy; 2020 Company, all rights reserved, words.</p></footer></body></html>"""
LINES = [
    'The "big" title',
    "By A. Writer",
    "First paragraph with a link here and more text that goes on — for a while, and then some.",
    "Second one is long as well and breaks, with somebold words in it.",
    "Third unclosed, 3 < 4 a < b, with enough words to count as text.",
    "item one",
    "item two",
    "Quote of someone, rather long.",
    "a",
    "b",
    "c",
]


@pytest.mark.parametrize(
    "build",
    [
        "<article>%s</article>",
        '<main><article class="post">%s</article></main>',
        '<div id="content"><div class="post-body">%s</div></div>',
        '<div class="columns"><div class="entry">%s</div><div><a href=1>x y</a> <a href=2>z</a></div></div>',
        "%s",
    ],
)
def test_builds_of_pages(build):
    assert main_text.main_text(TOP + build % ARTICLE + TAIL).split("\n") == LINES


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain &amp; more", "plain & more"),
        ("<p>a</p><p>b", "a\nb"),
        ("<article></article><div class=ad>Buy</div>", ""),
        ("<article><p> x&nbsp;&#10; y</p></article>", "x y"),
        ('<a title="open>text', "text"),
        ("<div>" * 3000 + "x" + "</div>" * 10, "x"),
        ("<article><header><h1>T</h1><nav>n</nav></header><p>x</p><footer>f</footer></article>", "T\nx"),
        ("text <!-- never closed <p>x", "text"),
        ("a <script>if (1 < 2) '</p>'</SCRIPT > b", "a b"),
    ],
)
def test_small_pages(page, text):
    assert main_text.main_text(page) == text


def test_links_lose_against_text():
    links = "".join(f"<li><a href={i}>Some link of several words, number {i}</a></li>" for i in range(60))
    body = "".join(f"<p>Paragraph {i} of the text, with a number of words.</p>" for i in range(4))
    page = f"<body><div><ul>{links}</ul></div><div><div>{body}</div></div></body>"
    got = main_text.main_text(page).split("\n")
    assert got == [f"Paragraph {i} of the text, with a number of words." for i in range(4)]


def test_hostile_pages_end():
    rng = random.Random(4)
    for page in ('<a "' * 50_000, "<div><p>" * 30_000 + "x", "<b>" * 30_000, "<" * 100_000):
        main_text.main_text(page)
    pieces = ["<p>", "</p>", "<li>", "<td>", "</table>", "<a href='", '"', ">", "x", "<!--", "-->", "<b>"]
    for _ in range(300):
        main_text.main_text("".join(rng.choices(pieces, k=rng.randint(0, 60))))


def marked(page: str) -> str:
    """The given pages mark their article; its blocks are h1 and p."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    inside = re.sub("<br>", " ", re.sub("</?b>", "", inside))
    blocks = (" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:p|h1)>", inside))
    return "\n".join(b for b in blocks if b)


@pytest.mark.skipif(not Path(DATA).exists(), reason="needs the given tables")
def test_given_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    got = QUERIES["op13_main_text"](spark, DATA).collect()
    assert len(got) == len(pages)
    for row in got:
        assert row.text == marked(pages[row.page_id].html)
        assert (row.url, row.n_chars) == (pages[row.page_id].url, len(row.text))


def test_rows_keep_their_columns(spark):
    rows = [(1, None, "t"), (None, "<p>x", "t"), (1, None, "t"), (2, "<p>" + "y " * 50_000, None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = main_text.with_text(pages, "main").collect()
    found = [(r.page_id, r.text, r.main) for r in got]
    assert found == [(1, "t", ""), (None, "t", "x"), (1, "t", ""), (2, None, ("y " * 50_000).strip())]
    assert main_text.with_text(pages.limit(0), "main").collect() == []
