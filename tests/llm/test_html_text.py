"""Main text of pages: any input gives a text, valid pages keep theirs, and time grows with the page."""

import html
import re
import time

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings, strategies as st

from claimtree.llm import html_text
from claimtree.llm.html_text import main_text

ARTICLE = (
    "<article><h1>Title here</h1><p>One two, three four five six seven eight nine ten eleven.</p>"
    "<p>More text, of the same kind, that is long enough.</p></article>"
)
WANT = "Title here One two, three four five six seven eight nine ten eleven. More text, of the same kind, that is long enough."
PARTS = [
    "<![", "<!", "<!--", "-->", "]]>", "<p>", "</p>", "<div>", "</div>", "<b>", "</b>", "<", "&", "&amp", "&#0;", ">", "word, ", "<nav>",
    "<form>", "</form>", "<head>", "</head>", "<body>", "<script>", "</script>", "<a href='", '"', "<li>", "<td>", "<tr>", "<table>",
    "\x00", "<?", "</", "<é>", "<title>", "</title>", "<svg/>", "<option>", "=", "/", "<textarea>", "</TextArea >", "<main>",
]


@settings(max_examples=600, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(PARTS), max_size=40).map("".join), st.binary(max_size=80).map(lambda b: b.decode("latin-1"))))
def test_never_fails(page):
    text = main_text(page)
    assert text == " ".join(text.split())


@pytest.mark.parametrize("page", ["<![foo[abc]]>", "<![", "<!", "<!--", "<!-- x", "</", "<", "&", "", None, "<![CDATA[x]]>", "<a b='", "<é"])
def test_malformed_declarations(page):
    assert isinstance(main_text(page), str)
    assert main_text((page or "") + "<p></p>" + ARTICLE) .endswith(WANT) or page in ("<a b='", "<!-- x", "<!--")


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><meta charset=utf-8><title>x</title><body>{ARTICLE}", f"<head><title>x</title>{ARTICLE}",
        f"<html><head><script>var a = '<p>';</script>{ARTICLE}</html>", f"<body><form action=x method=post>{ARTICLE}</form></body>",
        f"<nav><ul><li><a href=x>menu</a></li></ul>{ARTICLE}", f"<body><nav><a href=x>menu</a>{ARTICLE}</body>",
        f"<div class=ad>Buy it now{ARTICLE}", f"<!DOCTYPE html [<!ENTITY x 'y'>]>{ARTICLE}", f"<p>{ARTICLE}</b></i></section>",
        f"<title>never closed {ARTICLE}", f"<!-- never closed {ARTICLE}", f"{ARTICLE}<form><p>Write to us, it is short.</p></form>",
        f"<a title='a > b'></a>{ARTICLE}", f"<img src=\"data:{'x' * 70_000}\">{ARTICLE}", f"<form><p>Name, street, town and country</p></form>{ARTICLE}",
        f"{ARTICLE}<aside><p>{'Another long text, beside the article. ' * 40}</p></aside>",
    ],
)
def test_valid_pages_keep_their_text(page):
    assert main_text(page) == WANT


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 20_000 + "</i></section></p>" * 20_000 + ARTICLE, "<b>" * 20_000 + "text" + "</b>" * 20_000, "<!--" * 50_000, "<a " * 50_000,
        "<a x=\"" * 50_000 + ">", "<" * 100_000, "</" * 50_000, "<![" * 50_000, "<title>" * 50_000, "<li><ul>" + "<b>" * 20_000 + "<li></li>" * 20_000,
        "<table>" * 10_000 + "<td>" * 10_000, "<a" + " " * 100_000 + "b" + " " * 100_000 + ">", "<!--" * 20_000 + ">" * 20_000, "<a '\">" * 30_000,
    ],
)
def test_time_grows_with_the_page(page):
    start = time.perf_counter()
    main_text(page)
    assert time.perf_counter() - start < 5


def plain_text(page):
    """The element ``article`` of a given page, which nests nothing but paragraphs, breaks and inline marks."""
    inside = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
    return " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", inside))).split())


def test_every_given_page():
    rows = pq.read_table("/root/testdata/sf0.1/pages.parquet").column("html").to_pylist()
    assert [k for k, page in enumerate(rows) if main_text(page) != plain_text(page)] == []


def test_table_cases(spark):
    """Empty tables, repeated rows, NULL pages, and a column named like the result."""
    rows = [(1, ARTICLE, "old"), (1, ARTICLE, "old"), (2, None, "old"), (None, "<![", None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    found = html_text.extract(pages)
    assert found.columns == ["page_id", "html", "text"]
    assert sorted((r.page_id or 0, r.text) for r in found.collect()) == [(0, "<!["), (1, WANT), (1, WANT), (2, "")]
    assert html_text.extract(pages.where("false")).count() == 0
