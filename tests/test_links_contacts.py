from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sitefacts.functions import contacts as C
from sitefacts.functions import urls as U
from sitefacts.operators import contacts, links
from test_html import SAMPLE

BASES = ["https://acme.com", "https://acme.com/", "http://a.org/x/y", "https://a.org/x/y/", "https://A.org:8080/p?q=1#f"]
HREFS = [
    "/about/", "pricing#details", "../z/./w", "//b.org/q/?s", "?q=1", "#top", "HTTP://B.com/X/", "a;b=1", "/..", ".",
    "https://c.org", "https://c.org/a/../b/", "  /trim  ", "a//b", "/a//b", "mailto:x@y.org", "tel:1", "x:y", "",
    "/é/ü", "a/b/../../..", "http:rel",
]


def resolved(spark):
    rows = [(b, h) for b in BASES for h in HREFS]
    return spark.createDataFrame(rows, "b string, h string").select("b", "h", U.resolve(F.col("b"), F.col("h")).alias("u"))


LITERAL = [
    ("https://acme.com/", "/about/", "https://acme.com/about"),
    ("http://a.org/x/y", "pricing#details", "http://a.org/x/pricing"),
    ("http://a.org/x/y", "../z/./w", "http://a.org/z/w"),
    ("https://a.org/x/y/", "../z/./w", "https://a.org/x/z/w"),
    ("https://acme.com/", "//b.org/q/?s", "https://b.org/q"),
    ("http://a.org/x/y", "?q=1", "http://a.org/x/y"),
    ("https://A.org:8080/p?q=1#f", "#top", "https://A.org:8080/p"),
    ("https://acme.com", "HTTP://B.com/X/", "http://B.com/X"),
    ("https://acme.com", "https://c.org/a/../b/", "https://c.org/a/../b"),
    ("https://acme.com/", "  /trim  ", "https://acme.com/trim"),
]


def test_resolution(spark):
    found = {(r.b, r.h): r.u for r in resolved(spark).collect()}
    for base, href, url in LITERAL:
        assert found[base, href] == url, (base, href)


def test_canonical_is_idempotent(spark):
    once = resolved(spark).select(U.canonical(F.col("u")).alias("u"))
    assert once.where(U.canonical(F.col("u")) != F.col("u")).count() == 0


@pytest.mark.parametrize(
    "raw, wanted",
    [(" HTTPS://Acme.com/ ", "acme.com"), ("http://a.org/x//", "a.org/x"), ("a.org", "a.org"), ("http://https://b.org", "b.org")],
)
def test_domain_normalisation(value, raw, wanted):
    assert value(lambda c: U.normalize_domain(F.col(c)), d=raw) == wanted


@pytest.mark.parametrize(
    "base, url, wanted",
    [
        ("https://acme.com", "https://ACME.com/x", True),
        ("https://acme.com", "https://docs.acme.com/x", True),
        ("https://acme.com", "https://notacme.com/x", False),
        ("https://www.acme.com", "https://acme.com/x", False),
        ("https://acme.com", "https://acme.com:8080/x", False),
        ("https://acme.com", "https://acme.com/x.PDF", False),
        ("https://acme.com", "ftp://acme.com/x", False),
        ("acme.com", "http://acme.com/x", True),
    ],
)
def test_internal_links(value, base, url, wanted):
    assert value(lambda b, u: U.is_internal(F.col(b), F.col(u)), b=base, u=url) is wanted


def test_link_scores_overlap(value):
    score = lambda url, text: value(lambda u, t: U.link_score(F.col(u), F.col(t)), u=url, t=text)
    assert score("https://a.org/about-us", "About") == 30
    assert score("https://a.org/x", "Home") == 0


def test_sample_links(spark):
    page = spark.createDataFrame([(1, "https://fernwood.io", SAMPLE)], "id int, url string, html string")
    found = links.top_links(page, ["id"], limit=4).collect()
    assert [r.link for r in found] == ["https://fernwood.io/leadership"]


def test_first_scoring_anchor_counts_and_ties_keep_document_order(spark):
    html = '<a href="/pricing">x</a><a href="/pricing">pricing</a><a href="/reach-us">y</a><a href="/z">team</a>'
    page = spark.createDataFrame([(1, "https://a.org/", html)], "id int, url string, html string")
    found = links.link_scores(page, ["id"]).orderBy("rank").collect()
    assert [(r.link[13:], r.score) for r in found] == [("/z", 12), ("/pricing", 9), ("/reach-us", 9)]


def test_sample_contacts(spark):
    page = spark.createDataFrame([(1, SAMPLE)], "id int, html string")
    row = contacts.with_contacts(page).first()
    assert row.emails == ["orders@fernwood.io", "repairs@fernwood.io"]
    nothing = spark.createDataFrame([(1, None), (2, "")], "id int, html string")
    assert [tuple(r)[2:] for r in contacts.with_contacts(nothing).collect()] == [([], [], [])] * 2
    assert row.profiles == ["https://www.linkedin.com/in/mina-okoro"]


def test_mailto_skips_the_deny_lists(spark):
    html = '<a href=" MAILTO:User@Example.com?subject=x">m</a><a href="mailto:no address">n</a> user@example.com a@b.png'
    page = spark.createDataFrame([(1, html)], "id int, html string")
    assert contacts.with_contacts(page).first().emails == ["user@example.com"]


def test_profile_lists(spark):
    html = (
        '<a href="https://de.linkedin.com/in/ada/?x">a</a><a href="https://linkedin.com/company/acme/">c</a>'
        '<script>var u = "http://www.LinkedIn.com/in/Bo_1/";</script>'
    )
    row = contacts.with_contacts(spark.createDataFrame([(1, html)], "id int, html string")).first()
    assert row.profiles == ["https://de.linkedin.com/in/ada", "https://www.linkedin.com/in/Bo_1"]
    assert row.companies == ["https://linkedin.com/company/acme", "https://www.linkedin.com/company/acme"]


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("see https://www.linkedin.com/in/ada/ now", "https://www.linkedin.com/in/ada"),
        ("https://linkedin.com/company/acme", None),
        ("https://linkedin.com/feed", None),
        ("https://uk.linkedin.com/in/Jobs https://uk.linkedin.com/in/x", None),
    ],
)
def test_profile_in_text(value, text, wanted):
    assert value(lambda c: C.profile_in_text(F.col(c)), t=text) == wanted


PLAIN = re.compile(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b")
PIECES = st.lists(st.sampled_from(["a", "B", "é", "1", "_", ".", "-", "%", "+", "@", "@x", ".co", ".org", " ", ",", "<", "\n"]), max_size=24)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(PIECES, min_size=60, max_size=60))
def test_address_scan_finds_what_the_plain_pattern_finds(spark, texts):
    rows = [("".join(t),) for t in texts]
    df = spark.createDataFrame(rows, "t string").select("t", C.text_addresses(F.col("t")).alias("found"))
    for r in df.collect():
        assert r.found == [m.lower() for m in PLAIN.findall(r.t)], r.t
