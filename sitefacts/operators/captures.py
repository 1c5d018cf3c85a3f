"""Outcome of captures and choice of usable pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitefacts import params
from sitefacts.functions import urls as U

PARTIAL_MESSAGE = "Partial content retrieved after timeout"


def fetch_outcomes(captures: DataFrame, timeout_ms: int = params.PAGE_TIMEOUT_MS) -> DataFrame:
    """Decide status, HTML, success and message of raw captures.

    Input columns ``url, final_url, http_status, timed_out, raw_html, error``; others are kept. A response
    of any status counts as success. A timeout succeeds if enough of the page had arrived.
    """
    target = U.with_scheme(F.col("url"))
    failed = F.col("error").isNotNull()
    late = F.coalesce(F.col("timed_out"), F.lit(False))
    partial = late & (F.length("raw_html") > params.PARTIAL_MIN_CHARS)
    outcome = (
        F.when(failed, "error").when(partial, "partial").when(late, "timeout").otherwise("ok")
    )
    decided = captures.withColumn("outcome", outcome)
    usable = F.col("outcome").isin("ok", "partial")
    raw = ("http_status", "timed_out", "raw_html", "error")
    return decided.select(
        *[c for c in captures.columns if c not in ("url", "final_url", *raw)],
        target.alias("url"),
        F.when(usable, F.coalesce("final_url", target)).otherwise(target).alias("final_url"),
        F.when(failed, 500)
        .when(late, 408)
        .otherwise(F.coalesce("http_status", F.lit(200)))
        .cast("int")
        .alias("status_code"),
        F.when(usable, F.col("raw_html")).otherwise("").alias("html"),
        usable.alias("success"),
        F.when(failed, F.col("error"))
        .when(F.col("outcome") == "partial", PARTIAL_MESSAGE)
        .when(F.col("outcome") == "timeout", f"Navigation timed out after {timeout_ms}ms")
        .alias("error_message"),
        "outcome",
    )


def is_reachable():
    """Homepage test: not both failed and empty."""
    return F.col("success") | (F.coalesce(F.col("html"), F.lit("")) != "")


def is_usable():
    """Subpage test: success with HTML."""
    return F.col("success") & (F.coalesce(F.col("html"), F.lit("")) != "")


def usable_pages(pages: DataFrame, rank: str) -> DataFrame:
    """Reachable homepages (rank 0) and usable subpages."""
    return pages.where(F.when(F.col(rank) == 0, is_reachable()).otherwise(is_usable()))


def pages_per_site(pages: DataFrame, site: str, rank: str, url: str = "final_url") -> DataFrame:
    """Final URLs of a site's processed pages in crawl order; a site has at most homepage and best links."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("rank"), F.col(url).alias("url"))))
    return pages.groupBy(site).agg(ordered.alias("p")).select(site, F.col("p.url").alias("pages_crawled"))
