"""Main content, running results over arrays, text ranges, and pages with very many open or dropped elements."""

from __future__ import annotations

import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from sitefacts.functions import content
from sitefacts.functions import html as H
from sitefacts.functions.common import running
from sitefacts.operators import links, markdown, pages

PAGE = """<html><head><title>T</title></head><body><div id=side><ul><li><a href=/a>Home page here</a></li><li><a href=/b>Other page there</a></li></ul></div>
<div class=main><h1>About &amp; us</h1><p>We make <a href="https://x.org/p">pipes</a> for all kinds of engines.</p><h2>Team</h2>
<ul><li>Ada Lovelace, CEO</li><li><p>Bo Ek, <b>CTO</b></p></li><li></li></ul>
<table><tr><th>Plan</th><th>Price</th></tr><tr><td>Pro</td><td>$5</td></tr><tr><td><p>Big</p></td><td>$9</td></tr><tr><td>only one</td></tr></table>
loose<p>Call us at any time of the day you like, we answer.</p>A longer loose text is kept as it has some length.<div><a href=/n>Next</a> <a href=/l>Last</a></div></div></body></html>"""
MAIN = """# About & us

We make [pipes](https://x.org/p) for all kinds of engines.

## Team

- Ada Lovelace, CEO
- Bo Ek, CTO

| Plan | Price |
| Pro | $5 |

Big

$9

only one

Call us at any time of the day you like, we answer.

A longer loose text is kept as it has some length."""


def site(spark, *bodies, host="https://a.org"):
    return spark.createDataFrame([(i, f"{host}/{i}", b) for i, b in enumerate(bodies)], "id int, url string, html string")


def main_of(spark, *bodies, **rules):
    return {r.id: r.main_text for r in markdown.main_texts(site(spark, *bodies), ["id"], **rules).collect()}


def test_leaders_in_a_list_and_prices_in_a_table_stay(spark):
    assert main_of(spark, PAGE) == {0: MAIN}
    assert markdown.page_markdown(site(spark, PAGE), ["id"]).first().markdown == MAIN


def test_limits_are_arguments(spark):
    assert "loose" in main_of(spark, PAGE, min_chars=1)[0].splitlines()
    assert "[Next](/n) [Last](/l)" in main_of(spark, PAGE, max_link_share=1.0, min_chars=1)[0]
    assert markdown.page_markdown(site(spark, PAGE), ["id"], min_main=10_000).first().markdown != MAIN


def test_link_lists_beside_the_content_are_left_out(spark):
    link_list = "<div><ul>" + "".join(f"<li><a href=/{i}>Entry number {i}</a> x</li>" for i in range(30)) + "</ul></div>"
    text = main_of(spark, f"<body>{link_list}<article><p>The article itself, with its words.</p><p>Two paragraphs.</p></article>{link_list}</body>")[0]
    assert text == "The article itself, with its words.\n\nTwo paragraphs."


def test_odd_markup(spark):
    texts = main_of(
        spark, "<p>no container at all", "<div><li>stray item<li>another<table><tr><td>a<td>b<tr><td>c</div>", "<div><ul><li><ul><li>deep item</li></ul></li></ul></div>",
        "<div><h3></h3><p> </p>&#1;&#2;</div>", "<table><tr><td><table><tr><td>x</td><td>y</td></tr></table></td></tr></table>",
        "<div><p><a href='#top'>up to the top of this page</a> and some more words to read</p><p><a>bare link text</a> within a sentence of words</p></div>",
    )
    assert texts[0] == "no container at all"
    assert texts[1].splitlines()[:2] == ["- stray item", "- another"] and "c" in texts[1]
    assert texts[2] == "- deep item" and texts[3] == "" and texts[4] == "| x | y |"
    assert texts[5] == "up to the top of this page and some more words to read\n\nbare link text within a sentence of words"


def test_a_repeated_block_stays_on_the_first_page_that_has_it(spark):
    body = "<div><p>This paragraph is on every page of the host.</p><p>Page {} has a sentence of its own here.</p></div>"
    texts = main_of(spark, *[body.format(i) for i in range(5)])
    assert ["every page" in texts[i] for i in range(5)] == [True, False, False, False, False]
    assert all("every page" in t for t in main_of(spark, *[body.format(i) for i in range(5)], min_pages=6).values())


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 129, 5000])
def test_running_results(spark, n):
    values = [random.Random(n).randrange(100) for _ in range(n)]
    row = spark.createDataFrame([(values,)], "v array<bigint>").select(
        running(F.col("v"), lambda a, b: a + b).alias("sum"), running(F.col("v"), lambda a, b: F.greatest(a, b)).alias("max")
    ).first()
    assert row["sum"] == list(itertools.accumulate(values)) and row["max"] == list(itertools.accumulate(values, max))


def test_text_ranges_with_wide_characters(spark):
    body = "<div>﻿a <b>漢字😀</b><p> é </p> </div><p></p><i>z</i>"
    for separator in ("", " "):
        found = pages.element_texts(site(spark, body), ["id"], ("div", "b", "p", "i"), separator=separator)
        assert [r.text for r in found.orderBy("pos").collect()] == [separator.join(["﻿a", "漢字😀", "é"]), "漢字😀", "é", "", "z"]


def seconds(df):
    started = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def test_large_pages_take_about_linear_time(spark):
    """Twenty thousand dropped elements or links, and a quarter as many open anchors, whose texts overlap, take seconds."""
    weights = {"team": 3}
    bodies = {
        "dropped": lambda n: "<p>x</p><nav>y</nav>" * n,
        "links": lambda n: "".join(f"<a href=/team/{i}>t</a>" for i in range(n)),
        "open": lambda n: "<a href=/team>w" * n,
    }
    work = {
        "dropped": lambda df: pages.pruned_html(df),
        "links": lambda df: links.top_links(df, ["id"], weights=weights),
        "open": lambda df: links.top_links(df, ["id"], weights=weights),
    }
    for name, body in bodies.items():
        small, large = site(spark, body(500)).cache(), site(spark, body(5000 if name == "open" else 20_000)).cache()
        small.count(), large.count()
        seconds(work[name](small))
        assert seconds(work[name](large)) < 30, name


def test_elements_know_their_depth_without_a_shuffle(spark):
    found = pages.html_spans(site(spark, "<div><p>a<br>b</p><ul><li>c<li>d</ul></div><p>e"), ["id"])
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert [(r.tag, r.depth) for r in found.orderBy("start").collect()] == [("div", 1), ("p", 2), ("br", 3), ("ul", 2), ("li", 3), ("li", 4), ("p", 1)]


def test_every_container_is_a_block():
    assert set(content.CONTAINERS) | set(content.PARAGRAPHS) | set(content.HEADINGS) <= set(content.BLOCKS)


def test_queries_of_the_content_are_registered():
    assert {"main_blocks", "page_markdown", "request_rows", "rule_batch"} <= set(entry_module.oracle_sql())


def test_first_of_many_anchors_to_one_url(spark):
    body = "<a href=/x>nothing</a><a href=/x>our team</a><a href=/x>team team</a><a href=/team>t</a>"
    found = links.link_scores(site(spark, body, host="https://a.org/"), ["id"], weights={"team": 3}).collect()
    assert [(r.rank, r.pos, r.link, r.score) for r in found] == [(1, 9, "https://a.org/team", 3), (2, 3, "https://a.org/x", 3)] or len(found) == 2


def test_kept_tokens_against_a_plain_reading(spark):
    draw = random.Random(9)
    for _ in range(5):
        body = "".join(draw.choice(["<nav>", "</nav>", "<p>", "</p>", "<form>", "</form>", "t{} ".format(i), "<!--c-->", "<br>"]) for i in range(300))
        parsed = pages.parse_pages(site(spark, body)).select("tokens", "spans", H.dropped_spans(F.col("tokens"), F.col("spans")).alias("dropped"))
        row = parsed.select("tokens", "dropped", H.kept_tokens(F.col("tokens"), F.col("dropped")).alias("kept")).first()
        gone = {i for s in row.dropped for i in range(s >> 32, (s & 0xFFFFFFFF) + 1)}
        assert [t.tok for t in row.kept] == [t.tok for i, t in enumerate(row.tokens) if i not in gone and t.kind != "comment"]
