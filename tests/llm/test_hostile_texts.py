"""Texts and pages that once stopped a job, stalled it or lost their article."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from adfacts.llm.html_text import main_text, main_text_column
from adfacts.llm.line_dedup import without_recurring_lines
from adfacts.llm.pii import pseudonymised

ARTICLE = "<h1>The title</h1>" + "<p>Running text of some length, without any links in it at all.</p>" * 6
TEXT = "\n".join(["The title"] + ["Running text of some length, without any links in it at all."] * 6)


@pytest.mark.parametrize(
    "text",
    ["a@" + "b." * 100_000, "a%" * 200_000, "a" * 500_000 + "@", "1-" * 200_000, "+1 " * 100_000, "a@b..com a@.b.com"],
)
def test_no_text_stops_the_pseudonyms(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    start = time.monotonic()
    (row,) = pseudonymised(df, key="k").collect()
    assert row.text == text and row.found == []
    assert time.monotonic() - start < 60


def test_addresses_are_found_as_before(spark):
    text = "see ab.cd+x@mail.example-site.co.uk, (q@x.io) and 50%off@shop.de."
    (row,) = pseudonymised(spark.createDataFrame([(text,)], "text string"), key="k").collect()
    assert [f.value for f in row.found] == ["ab.cd+x@mail.example-site.co.uk", "q@x.io", "50%off@shop.de"]


def test_long_tokens_in_lines(spark):
    token = "a" * 1_000_000
    rows = [(i, f"7 {token}\nThe same line again here\n{i * 'x'}") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    start = time.monotonic()
    found = {r.doc_id: r.dropped_lines for r in without_recurring_lines(df).collect()}
    assert found == {0: [], 1: [1], 2: [1], 3: [1]}
    assert time.monotonic() - start < 60


def test_columns_that_are_called_like_results(spark):
    rows = [(i, f"a line that comes again\nmail a@b.org{i * ' x'}", "x", 5) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id int, text string, found string, dropped_lines int")
    made = pseudonymised(df, key="k")
    assert made.columns == ["doc_id", "text", "found", "dropped_lines", "found_"]
    assert all(r.found == "x" and len(r.found_) == 1 for r in made.collect())
    cleaned = without_recurring_lines(df)
    assert cleaned.columns == ["doc_id", "text", "found", "dropped_lines", "dropped_lines_"]
    assert {r.doc_id: (r.dropped_lines, r.dropped_lines_) for r in cleaned.collect()}[1] == (5, [0])


@pytest.mark.parametrize(
    "page",
    [
        f"<![foo[<article>{ARTICLE}</article>",
        f"<!--[if IE]><p>old</p><![endif]--><article>{ARTICLE}<![endif]--></article>",
        f"<div class='layout sidebar-right'>{ARTICLE}<div class='sidebar'>Side</div></div>",
        f"<div class='menu-open'>{ARTICLE}</div>",
        f"<div id='nav-main-wrap'>{ARTICLE}</div><div class='menu'>Menu</div>",
        f"<div class='share-price-news'>{ARTICLE}</div>",
        f"<textarea><p>x</textarea><article>{ARTICLE}</article>",
        f"<button><div>x</button><div>{ARTICLE}</div>",
        f"<article>{ARTICLE}</article><div class='comments'>{'<p>I say so at length, as others do.</p>' * 60}</div>",
        f"<div>{ARTICLE}</div><div class='comments'>{'<p>I say so at length, as others do.</p>' * 60}</div>",
    ],
)
def test_pages_keep_their_article(page):
    assert main_text(page) == TEXT


def test_paragraphs_of_an_article_with_telling_classes():
    page = f"<article>{ARTICLE}<p class='notice-board'>From the notice board.</p><p class='notice'>Cookies.</p></article>"
    assert main_text(page) == TEXT + "\nFrom the notice board."


@pytest.mark.parametrize(
    "page",
    [
        "<i>" * 100_000 + "</b>" * 100_000, "<b>" + "<i>" * 50_000 + "</b>" * 100_000, "<div>" * 100_000 + "x",
        "<p>" * 100_000, "<![" * 50_000, "<b><div>" * 30_000 + "</b>" * 60_000,
    ],
)
def test_mark_up_of_any_depth_is_read(page):
    start = time.monotonic()
    main_text(page)
    assert time.monotonic() - start < 20


def test_pages_as_a_column(spark):
    pages = [None, "", "plain", "<![foo[", f"<article>{ARTICLE}</article>", f"<article>{ARTICLE}</article>"]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    got = [r.text for r in df.select("html", main_text_column(F.col("html")).alias("text")).collect()]
    assert sorted(got) == sorted(["", "", "plain", "", TEXT, TEXT])
    assert df.limit(0).select(main_text_column(F.col("html")).alias("text")).count() == 0
