"""Captured pages: tokens, elements, pruning and text. All of it happens within the page's row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefacts import params
from sitefacts.functions import html as H
from sitefacts.functions import urls as U
from sitefacts.functions.common import on_columns
from sitefacts.operators.rows import computed, unfolded, unfolded_with_position


def parse_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``tokens`` and ``spans``; pages without HTML are left out."""
    has_html = F.col(html).isNotNull() & (F.col(html) != "")
    tokens = computed(pages.where(has_html), tokens=on_columns(H.tokenize, html))
    return computed(tokens, spans=on_columns(H.element_spans, "tokens"))


def html_tokens(pages: DataFrame, key: Sequence[str], html: str = "html") -> DataFrame:
    """One row per token: ``(key, pos, kind, tag, tok)``."""
    tokens = unfolded_with_position(pages, key, on_columns(H.tokenize, html), "t")
    return tokens.select(*key, "pos", "t.kind", "t.tag", "t.tok")


def html_spans(pages: DataFrame, key: Sequence[str], html: str = "html") -> DataFrame:
    """One row per element: ``(key, tag, tok, start, stop, depth)``. Depths are found within the page's row."""
    parsed = computed(parse_pages(pages, html), depths=on_columns(H.span_depths, "spans"))
    elements = F.zip_with(
        "spans",
        "depths",
        lambda s, depth: F.struct(
            F.get("tokens", H.span_start(s))["tag"].alias("tag"),
            F.get("tokens", H.span_start(s))["tok"].alias("tok"),
            H.span_start(s).alias("start"),
            H.span_stop(s).alias("stop"),
            depth.cast("int").alias("depth"),
        ),
    )
    return unfolded(parsed, key, elements, "s").select(*key, "s.tag", "s.tok", "s.start", "s.stop", "s.depth")


def tag_attributes(pages: DataFrame, key: Sequence[str], names: Sequence[str], html: str = "html") -> DataFrame:
    """One row per tag with attributes: the values of the named ones, null where absent."""
    tokens = html_tokens(pages, key, html).where(F.col("kind").isin("open", "void") & F.col("tok").contains("="))
    values = [H.attribute(F.col("tok"), n).alias(n.replace("-", "_")) for n in names]
    return tokens.select(*key, "pos", "tag", *values)


def prune_pages(
    pages: DataFrame,
    html: str = "html",
    strip_tags: Sequence[str] = params.STRIP_TAGS,
    noise_words: Sequence[str] = params.NOISE_WORDS,
) -> DataFrame:
    """Add ``kept``: the tokens of content elements."""
    dropped = on_columns(
        H.dropped_spans, "tokens", "spans", strip_tags=tuple(strip_tags), noise_words=tuple(noise_words)
    )
    parsed = computed(parse_pages(pages, html), dropped=dropped)
    return computed(parsed, kept=on_columns(H.kept_tokens, "tokens", "dropped")).drop("dropped")


def pruned_html(pages: DataFrame, html: str = "html", **rules) -> DataFrame:
    """Pruned HTML of every page with the lengths before and after; empty for pages without HTML."""
    keep = [c for c in pages.columns if c != html]
    blank = F.col(html).isNull() | (F.trim(html) == "")
    pruned = prune_pages(pages.where(~blank), html, **rules).select(
        *keep, on_columns(H.render, "kept").alias("pruned"), F.length(html).alias("raw_chars")
    )
    empty = pages.where(blank).select(*keep, F.lit("").alias("pruned"), F.length(html).alias("raw_chars"))
    return pruned.unionByName(empty).withColumn("pruned_chars", F.length("pruned"))


def prune_ratio_by_host(pruned: DataFrame, url: str = "url") -> DataFrame:
    """Pages, characters and removed share per host; sums are combined before the shuffle."""
    sums = pruned.groupBy(U.host(F.col(url)).alias("host")).agg(
        F.count("*").alias("pages"),
        F.sum("raw_chars").alias("raw_chars"),
        F.sum("pruned_chars").alias("pruned_chars"),
    )
    removed = 1 - F.col("pruned_chars") / F.col("raw_chars")
    return sums.withColumn("removed_share", F.round(removed, 4))


def page_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``text``: the visible text of the whole page."""
    tokens = computed(pages, tokens=on_columns(H.tokenize, html))
    return tokens.withColumn("text", on_columns(H.visible_text, "tokens")).drop("tokens")


def element_texts(
    pages: DataFrame, key: Sequence[str], tags: Sequence[str], html: str = "html", separator: str = " "
) -> DataFrame:
    """One row per element of the given tags with its stripped text."""

    def element(span: Column) -> Column:
        return F.struct(
            H.span_start(span).alias("pos"),
            F.get("tokens", H.span_start(span))["tag"].alias("tag"),
            H.span_text(F.col("index"), span, separator).alias("text"),
        )

    indexed = computed(parse_pages(pages, html), index=on_columns(H.text_index, "tokens", separator=separator))
    wanted = F.filter("spans", lambda s: F.get("tokens", H.span_start(s))["tag"].isin(*tags))
    found = unfolded(indexed, key, F.transform(wanted, element), "e")
    return found.select(*key, "e.pos", "e.tag", "e.text")


def challenge_flags(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``title`` and ``is_challenge``."""
    return pages.withColumn("title", on_columns(H.title, html)).withColumn(
        "is_challenge", on_columns(H.is_challenge, html)
    )
