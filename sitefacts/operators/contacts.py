"""Contacts on pages and sites. Everything of one page is found within its row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefacts.functions import contacts as C
from sitefacts.functions import html as H
from sitefacts.functions.common import on_columns
from sitefacts.operators.rows import computed, unfolded

KINDS = ("emails", "profiles", "companies")


def with_contacts(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``emails``, ``profiles`` and ``companies``: distinct and sorted per page."""
    tokens = computed(pages, tokens=on_columns(H.tokenize, html))
    sources = computed(tokens, hrefs=on_columns(H.hrefs, "tokens"), text=on_columns(H.visible_text, "tokens"))
    hrefs, markup = F.col("hrefs"), F.col(html)
    return (
        sources.withColumn(
            "emails", C.distinct_sorted(C.mailto_addresses(hrefs), C.allowed_text_addresses(F.col("text")))
        )
        .withColumn("profiles", C.distinct_sorted(C.anchor_profiles(hrefs), C.markup_profiles(markup)))
        .withColumn("companies", C.distinct_sorted(C.anchor_companies(hrefs), C.markup_companies(markup)))
        .drop("tokens", "hrefs", "text")
    )


def contact_values(pages: DataFrame, key: Sequence[str], html: str = "html") -> DataFrame:
    """Long form: ``(key, kind, value)``, each value once per page."""
    lists = with_contacts(pages, html)

    def rows(kind: str) -> Column:
        return F.transform(kind, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    found = unfolded(lists, key, F.concat(*[rows(k) for k in KINDS]), "c")
    return found.select(*key, "c.kind", "c.value")


def mailto_emails(pages: DataFrame, key: Sequence[str], html: str = "html") -> DataFrame:
    tokens = computed(pages, tokens=on_columns(H.tokenize, html))
    return unfolded(tokens, key, C.mailto_addresses(on_columns(H.hrefs, "tokens")), "email")


def text_emails(texts: DataFrame, key: Sequence[str], text: str = "text") -> DataFrame:
    """Addresses in a text column after the deny lists, repeats included."""
    return unfolded(texts, key, C.allowed_text_addresses(F.col(text)), "email")


def site_values(pages: DataFrame, site: str, key: Sequence[str], html: str = "html") -> DataFrame:
    """Distinct values of a whole site, one row each. Repeats are dropped before the shuffle."""
    return contact_values(pages, list(dict.fromkeys([site, *key])), html).select(site, "kind", "value").distinct()


def site_contacts(pages: DataFrame, site: str, html: str = "html") -> DataFrame:
    """One row per site with the sorted union of its pages' lists.

    Meant for the few pages chosen for a profile (homepage and best links); :func:`site_values` gives the
    same content as rows for sites with any number of pages.
    """
    lists = with_contacts(pages, html).select(site, *KINDS)
    values = lists.groupBy(site).agg(*[F.collect_set(k).alias(k) for k in KINDS])
    return values.select(site, *[F.array_sort(F.array_distinct(F.flatten(k))).alias(k) for k in KINDS])
