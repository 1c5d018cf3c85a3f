"""Internal links: scoring, choice of subpages, and the pages they lead to."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefacts import params
from sitefacts.functions import html as H
from sitefacts.functions import urls as U
from sitefacts.functions.common import on_columns
from sitefacts.operators.pages import parse_pages
from sitefacts.operators.rows import computed, unfolded
from sitefacts.plans.skew import salted_join


def page_anchors(pages: DataFrame, key: Sequence[str], html: str = "html", separator: str = "") -> DataFrame:
    """One row per anchor with an href: ``(key, pos, href, text)``."""
    anchors = on_columns(H.anchors, "tokens", "spans", separator=separator)
    found = unfolded(parse_pages(pages, html), key, anchors, "a")
    return found.select(*key, "a.pos", "a.href", "a.text")


def resolved_links(
    pages: DataFrame, key: Sequence[str], base: str = "url", html: str = "html"
) -> DataFrame:
    """Anchors with absolute URL and the tests a followed link must pass."""
    with_base = page_anchors(pages, [*key, base], html)
    resolved = computed(with_base, link=U.resolve(F.col(base), F.col("href")))
    return resolved.select(
        *key,
        "pos",
        "href",
        "text",
        "link",
        U.is_followable(F.col("href")).alias("followable"),
        U.is_self_link(F.col(base), F.col("link")).alias("self_link"),
        U.is_internal(F.col(base), F.col("link")).alias("internal"),
    )


def scored_links(tokens: Column, spans: Column, base: Column, weights: tuple) -> Column:
    """``array<struct<link, pos, order>>``: internal links with a score, by URL and place; order is minus the score."""
    followable = F.filter(H.anchors(tokens, spans), lambda a: U.is_followable(a["href"]))
    resolved = F.transform(
        followable,
        lambda a: F.struct(
            a["pos"].alias("pos"), a["text"].alias("text"), U.resolve(base, a["href"]).alias("link")
        ),
    )
    internal = F.filter(resolved, lambda a: ~U.is_self_link(base, a["link"]) & U.is_internal(base, a["link"]))
    scored = F.transform(
        internal,
        lambda a: F.struct(
            a["link"].alias("link"),
            a["pos"].alias("pos"),
            (-U.link_score(a["link"], a["text"], dict(weights))).alias("order"),
        ),
    )
    return F.array_sort(F.filter(scored, lambda a: a["order"] < 0))


def with_ranked_links(
    pages: DataFrame,
    base: str = "url",
    html: str = "html",
    weights: Mapping[str, int] = params.LINK_WEIGHTS,
) -> DataFrame:
    """Add ``links``: scored internal links of each page, best first, ties in document order.

    Of several anchors to one URL the first that scores counts: the one whose neighbour before, by URL and place, has
    another URL. A page's links stay in its row.
    """
    found = on_columns(scored_links, "tokens", "spans", base, weights=tuple(weights.items()))
    parsed = computed(parse_pages(pages, html), scored=found)
    first_of_url = F.filter("scored", lambda a, i: (i == 0) | (F.get("scored", i - 1)["link"] != a["link"]))
    by_score = F.transform(first_of_url, lambda a: F.struct(a["order"].alias("order"), a["pos"].alias("pos"), a["link"].alias("link")))
    ranked = F.transform(
        F.array_sort(by_score),
        lambda a, i: F.struct(
            (i + 1).alias("rank"), a["pos"].alias("pos"), a["link"].alias("link"), (-a["order"]).alias("score")
        ),
    )
    return computed(parsed, links=ranked).drop("scored", "tokens", "spans")


def link_scores(pages: DataFrame, key: Sequence[str], base: str = "url", html: str = "html", **rules) -> DataFrame:
    """One row per scored URL of a page: ``(key, rank, pos, link, score)``."""
    ranked = unfolded(with_ranked_links(pages, base, html, **rules), key, "links", "l")
    return ranked.select(*key, "l.rank", "l.pos", "l.link", "l.score")


def top_links(
    pages: DataFrame,
    key: Sequence[str],
    base: str = "url",
    html: str = "html",
    limit: int = params.MAX_SUBPAGES,
    **rules,
) -> DataFrame:
    """The ``limit`` best links of each page."""
    best = unfolded(with_ranked_links(pages, base, html, **rules), key, F.slice("links", 1, limit), "l")
    return best.select(*key, "l.rank", "l.pos", "l.link", "l.score")


def captured_links(links: DataFrame, captures: DataFrame, key: Sequence[str], url: str = "url") -> DataFrame:
    """Links with the capture of their URL: ``capture_key`` is null where there is none yet.

    A URL captured more than once counts once, by its smallest key; only keys and URLs are shuffled. Many
    pages may link to one URL, so the links of a URL are spread.
    """
    first_capture = captures.groupBy(F.col(url).alias("link")).agg(F.min(F.struct(*key)).alias("capture_key"))
    # Only URLs that are linked at all are repeated for the slices below, not every captured one.
    linked = links.select("link").distinct().join(first_capture, "link")
    return salted_join(links, linked, ["link"], [c for c in links.columns if c != "link"])


def missing_links(linked: DataFrame) -> DataFrame:
    """URLs still to be captured, each once."""
    return linked.where(F.col("capture_key").isNull()).select("link").distinct()
