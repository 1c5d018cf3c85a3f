"""Markdown per page, contexts per site and request rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitefacts import params
from sitefacts.functions import content
from sitefacts.functions import html as H
from sitefacts.functions import markdown as M
from sitefacts.functions import urls as U
from sitefacts.functions.common import on_columns
from sitefacts.operators.pages import prune_pages
from sitefacts.operators.rows import computed, unfolded
from sitefacts.plans.scratch import staged
from sitefacts.plans.skew import salted_join


def content_pages(pages: DataFrame, html: str = "html", **rules) -> DataFrame:
    """Add ``kept``, ``kept_spans`` and ``blocks``, the blocks of the main content of the pruned page."""
    pruned = prune_pages(pages, html, **rules).drop("tokens", "spans")
    spanned = computed(pruned, kept_spans=on_columns(H.element_spans, "kept"))
    return computed(spanned, blocks=on_columns(content.main_blocks, "kept", "kept_spans"))


def markdown_lines(pages: DataFrame, key: Sequence[str], html: str = "html", **rules) -> DataFrame:
    """One row per Markdown line: ``(key, pos, line)``; positions count the kept tokens."""
    pruned = computed(prune_pages(pages, html, **rules), kept_spans=on_columns(H.element_spans, "kept"))
    found = unfolded(pruned, key, on_columns(M.line_rows, "kept", "kept_spans"), "l").where("l.line is not null")
    return found.select(*key, "l.pos", "l.line")


def page_blocks(pages: DataFrame, key: Sequence[str], url: str = "url", html: str = "html", **rules) -> DataFrame:
    """Blocks of every page's main content, still in its row: ``(key, host, blocks)``."""
    return content_pages(pages, html, **rules).select(*key, U.host(F.col(url)).alias("host"), "blocks")


def block_keys(
    blocks: DataFrame, key: Sequence[str], min_chars: int = params.MIN_BLOCK_CHARS, max_link_share: float = params.MAX_LINK_SHARE
) -> DataFrame:
    """``(key, host, block)``: hash of each content block, once per page. No text leaves the page."""
    found = F.filter("blocks", lambda b: content.is_content(b, min_chars, max_link_share))
    hashes = F.array_distinct(F.transform(found, lambda b: M.block_key(b["text"])))
    return unfolded(blocks, [*key, "host"], hashes, "block")


def repeated_blocks(keys: DataFrame, key: Sequence[str], min_pages: int = params.REPEATED_BLOCK_PAGES) -> DataFrame:
    """Blocks found on ``min_pages`` pages of a host or more: ``(host, block, pages, first)``, ``first`` the smallest key.

    A page gives each block once, so pages are counted by adding rows up, which combines before the
    shuffle; a busy host or a block on all of its pages makes no large group.
    """
    counted = keys.groupBy("host", "block").agg(F.count("*").alias("pages"), F.min(F.struct(*key)).alias("first"))
    return counted.where(F.col("pages") >= min_pages)


def repeated_on_page(keys: DataFrame, key: Sequence[str], min_pages: int = params.REPEATED_BLOCK_PAGES) -> DataFrame:
    """``(key, repeated)``: hashes of the page's blocks that repeat on its host, but for the first page that has them."""
    repeated = repeated_blocks(keys, key, min_pages)
    on = ["host", "block"]
    firsts = repeated.select(*on, F.col("first").alias("_first"))
    found = salted_join(keys, firsts, on, key, "inner", counts=repeated.select(*on, F.col("pages").alias("n")))
    again = found.where(F.struct(*key) != F.col("_first"))
    return again.groupBy(*key).agg(F.collect_set("block").alias("repeated"))


def main_texts(
    pages: DataFrame,
    key: Sequence[str],
    url: str = "url",
    html: str = "html",
    min_chars: int = params.MIN_BLOCK_CHARS,
    max_link_share: float = params.MAX_LINK_SHARE,
    min_pages: int = params.REPEATED_BLOCK_PAGES,
    **rules,
) -> DataFrame:
    """Main content of every page as Markdown, without link-heavy blocks, loose scraps, and blocks that other pages had."""
    # Read twice, for the hashes and for the texts; the copy saves parsing every page again.
    blocks = staged(page_blocks(pages, key, url, html, **rules), "page-blocks")
    repeated = repeated_on_page(block_keys(blocks, key, min_chars, max_link_share), key, min_pages)
    text = on_columns(content.main_markdown, "blocks", "repeated", min_chars=min_chars, max_link_share=max_link_share)
    return blocks.join(repeated, list(key), "left").select(*key, "host", text.alias("main_text"))


def page_markdown(
    pages: DataFrame,
    key: Sequence[str],
    url: str = "url",
    html: str = "html",
    budget: int = params.MARKDOWN_BUDGET,
    min_chars: int = params.MIN_BLOCK_CHARS,
    max_link_share: float = params.MAX_LINK_SHARE,
    min_pages: int = params.REPEATED_BLOCK_PAGES,
    min_main: int = params.MIN_MAIN_TEXT,
    **rules,
) -> DataFrame:
    """Markdown of every page: its main content if there is enough of it, else the outline."""
    found = content_pages(pages, html, **rules).withColumn("host", U.host(F.col(url)))
    columns = [c for c in pages.columns if c != html]
    outline = on_columns(M.outline, "kept", "kept_spans", budget=budget).alias("outline")
    # Read twice, for the hashes and for the texts; the copy saves parsing every page again.
    rendered = staged(found.select(*columns, "host", "blocks", outline), "page-content")
    repeated = repeated_on_page(block_keys(rendered, key, min_chars, max_link_share), key, min_pages)
    main = on_columns(content.main_markdown, "blocks", "repeated", min_chars=min_chars, max_link_share=max_link_share)
    return rendered.join(repeated, list(key), "left").select(
        *columns, M.choose(main, F.col("outline"), budget, min_main).alias("markdown")
    )


def site_contexts(pages: DataFrame, site: str, rank: str, url: str, markdown: str = "markdown") -> DataFrame:
    """One text per site: a section per page with content, homepage first, then by link rank.

    The pages of a site are its homepage and a fixed number of best links, each under a character budget,
    so the gathered text is bounded.
    """
    sections = pages.where(F.col(markdown) != "").groupBy(site).agg(
        F.array_sort(
            F.collect_list(F.struct(F.col(rank).alias("rank"), M.section(F.col(url), F.col(markdown)).alias("section")))
        ).alias("sections")
    )
    return sections.select(site, M.join_sections(F.col("sections.section")).alias("context"))


def request_rows(sites: DataFrame) -> DataFrame:
    """Add ``request``, the text of one extraction request, to ``(domain, context, emails, profiles)``."""
    return sites.withColumn(
        "request", M.request(F.col("domain"), F.col("context"), F.col("emails"), F.col("profiles"))
    )
