"""The whole flow: seeds, captured pages, stored answers and hits in; one profile per seed out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefacts import params
from sitefacts.functions import html as H
from sitefacts.functions import markdown as M
from sitefacts.functions import urls as U
from sitefacts.functions.common import bind, on_columns
from sitefacts.operators import captures as captures_
from sitefacts.operators import contacts, costs, enrichment, links, markdown, profiles, responses
from sitefacts.operators.pages import prune_pages
from sitefacts.plans.scratch import staged
from sitefacts.plans.wanted import likely_wanted
from sitefacts.sources.seeds import normalized_seeds


def page_keys(pages: DataFrame, key: Sequence[str], wanted: DataFrame, urls: int) -> DataFrame:
    """Page key of every wanted URL ``(url)``, ``urls`` in number, that was captured.

    Of its captures a successful one counts, then the smallest. Most unwanted URLs go before anything is shuffled, and
    URLs and keys are all that is.
    """
    missed = (~F.coalesce(F.col("success"), F.lit(False))).cast("int").alias("missed")
    captured = likely_wanted(pages.select("url", F.struct(missed, *key).alias("k")), wanted.select("url"), ["url"], urls)
    met = captured.join(wanted.select("url"), "url", "left_semi")
    return met.groupBy("url").agg(F.min("k").alias("k")).select("url", *[F.col(f"k.{c}").alias(c) for c in key])


def pages_of(pages: DataFrame, key: Sequence[str], wanted: DataFrame) -> DataFrame:
    """Pages whose key is wanted, with the other columns of ``wanted``. HTML of hardly any other page is shuffled."""
    return likely_wanted(pages, wanted, key, wanted.count()).join(wanted, list(key))


def homepages(seeds: DataFrame, pages: DataFrame, key: Sequence[str]) -> DataFrame:
    """Homepage capture of each distinct site, reachable or not; columns of ``pages`` plus ``domain``."""
    sites = staged(seeds.select("domain", F.col("root_url").alias("url")).distinct(), "sites")
    found = sites.join(page_keys(pages, key, sites, sites.count()), "url").drop("url")
    return pages_of(pages, key, staged(found, "homepage-keys"))


def chosen_pages(
    seeds: DataFrame, pages: DataFrame, key: Sequence[str], limit: int = params.MAX_SUBPAGES, homes: DataFrame | None = None
) -> DataFrame:
    """Reachable homepages (rank 0) and the usable captures of their best links (rank 1 and up).

    A site has at most ``limit`` + 1 rows here, whatever was captured of it. The homepages are read twice,
    for their links and for themselves, and the result by every step that follows, so both are written out;
    ``homes`` gives them if they are already.
    """
    home = (staged(homepages(seeds, pages, key), "homepages") if homes is None else homes).where(captures_.is_reachable())
    best = links.top_links(home, ["domain"], base="final_url", limit=limit)
    # An internal URL belongs to its own site and the domains above it, so no URL is linked by many sites.
    linked = staged(best.select("domain", "rank", F.col("link").alias("url")), "linked-pages")
    wanted = staged(linked.join(page_keys(pages, key, linked, linked.count()), "url").drop("url"), "subpage-keys")
    sub = pages_of(pages, key, wanted).where(captures_.is_usable())
    return staged(home.withColumn("rank", F.lit(0)).unionByName(sub), "chosen-pages")


def site_requests(chosen: DataFrame, budget: int = params.SITE_PAGE_BUDGET, **rules) -> DataFrame:
    """Context, contacts and request text per site; ``rules`` are those of :func:`markdown.page_markdown`."""
    rendered = markdown.page_markdown(chosen, ["domain", "rank"], url="final_url", budget=budget, **rules)
    contexts = markdown.site_contexts(rendered, "domain", "rank", "final_url")
    found = contacts.site_contacts(chosen, "domain")
    no_text = F.coalesce(F.col("context"), F.lit(""))
    return markdown.request_rows(
        found.join(contexts, "domain", "left").select("domain", no_text.alias("context"), "emails", "profiles")
    )


def best_answer() -> list[Column]:
    """The order in which answers of one site are preferred: by what could be used of them, then by their score."""
    usable = F.when(F.col("source") == "valid", 0).when(F.col("source") == "salvaged", 1).when(F.col("source") == "unparsable", 2)
    return [F.coalesce(usable, F.lit(3)).alias("usable"), (-F.col("data_confidence_score")).alias("score")]


def answered_profiles(
    answers: DataFrame, hits: DataFrame, crawled: DataFrame, search: bool = True, prefer: Sequence[Column] | None = None
) -> DataFrame:
    """Checked, priced and enriched profiles of the sites that have an answer.

    ``crawled`` holds ``(domain, pages_crawled)``. A site may have any number of answers: the first in the order of
    ``prefer`` counts (columns of :func:`responses.records`, :func:`best_answer` by default; equal ones by their own
    columns), and the tokens and costs of all its calls are added up.
    """
    calls = costs.usage_costs(responses.records(answers))
    order = [c.alias(f"_order_{i}") for i, c in enumerate(best_answer() if prefer is None else prefer)]
    used = ("prompt_tokens", "completion_tokens", "cost_usd")
    first = ("provider", "model_name", *used)
    rest = [c for c in calls.columns if c not in ("domain", *first)]
    ledger = calls.groupBy("domain").agg(F.min(F.struct(*order, *first, *rest)).alias("a"), *[F.sum(c).alias(c) for c in used])
    kept = [F.col(f"a.{c}").alias(c) for c in calls.columns if c not in ("domain", *used)]
    # The records are read twice, for the searches they need and for themselves; the copy saves parsing every answer again.
    priced = staged(ledger.select("domain", *kept, *used).join(crawled, "domain", "left"), "priced-records")
    is_record = F.col("source") != "not_object"
    enriched = enrichment.enrich_leaders(priced, hits, "domain", search=search, eligible=is_record)
    described = enriched.withColumn(
        "metadata",
        profiles.metadata(
            F.col("pages_crawled"),
            F.col("provider"),
            F.col("model_name"),
            F.col("prompt_tokens"),
            F.col("completion_tokens"),
            F.col("cost_usd"),
            F.col("search_fallback_triggered"),
        ),
    )
    return described.select(*profiles.FIELDS)


def rule_profiles(chosen: DataFrame) -> DataFrame:
    """Profiles by rule from the chosen pages: title and prose of the homepage, contacts of all."""
    prose = bind(on_columns(M.blocks, "kept"), lambda b: M.main_text(b))
    home = prune_pages(chosen.where("rank = 0")).select(
        "domain", on_columns(H.title, "html").alias("title"), prose.alias("main_text")
    )
    found = contacts.site_contacts(chosen, "domain").select("domain", "emails")
    return profiles.extractive_profiles(home.join(found, "domain", "left"))


def unanswered_profiles(chosen: DataFrame, crawled: DataFrame, answered: DataFrame) -> DataFrame:
    """Full profiles by rule of the sites ``answered (domain)`` lacks; their metadata names rules as the source."""
    found = rule_profiles(chosen.join(answered, "domain", "left_anti")).join(crawled, "domain", "left")
    zero, nothing = F.lit(0), F.lit(0.0)
    described = found.withColumn("confidence_reasoning", F.lit("Extracted by rule; no answer stored")).withColumn(
        "metadata",
        profiles.metadata(F.col("pages_crawled"), F.lit("rules"), F.lit("extractive"), zero, zero, nothing, F.lit(False)),
    )
    return described.select(*profiles.FIELDS)


def enrich(
    seeds: DataFrame,
    pages: DataFrame,
    answers: DataFrame,
    hits: DataFrame,
    key: Sequence[str],
    search: bool = True,
    limit: int = params.MAX_SUBPAGES,
    rules: bool = False,
    prefer: Sequence[Column] | None = None,
) -> DataFrame:
    """One profile per seed: from its answer, or a fallback that says why there is none.

    Domains of answers are normalised like those of seeds. Of several answers for a site the first in the order of
    ``prefer`` counts, see :func:`answered_profiles`. With ``rules``, reachable sites without an answer are profiled by
    rule from their pages.
    """
    sites = normalized_seeds(seeds)
    answers = answers.withColumn("domain", U.normalize_domain(F.col("domain")))
    homes = staged(homepages(sites, pages, key), "homepages")
    chosen = chosen_pages(sites, pages, key, limit, homes)
    crawled = captures_.pages_per_site(chosen, "domain", "rank")
    unreachable = homes.where(~captures_.is_reachable()).select("domain", "error_message")
    answered = answered_profiles(answers.join(unreachable, "domain", "left_anti"), hits, crawled, search, prefer)
    known = answered.unionByName(profiles.fallback_profiles(unreachable))
    if rules:
        known = known.unionByName(unanswered_profiles(chosen, crawled, answers.select("domain").distinct()))
    return profiles.complete_batch(sites.select("domain"), known)
