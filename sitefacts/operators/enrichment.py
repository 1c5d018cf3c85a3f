"""Profile URLs for leaders from stored search hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefacts import params
from sitefacts.functions import answers as A
from sitefacts.functions import hits as R
from sitefacts.plans.skew import salted_join


def search_keys(profiles: DataFrame, key: str) -> DataFrame:
    """Searches to make: one per leader without URL, or one for a profile without leaders.

    ``leader`` is null for the latter.
    """
    lacking = F.filter("key_leadership", lambda m: m["linkedin_url"].isNull())
    leaders = F.when(F.size("key_leadership") == 0, F.array(F.lit(None).cast("string"))).otherwise(
        F.transform(lacking, lambda m: m["name"])
    )
    # A null leader stands for a profile without any, so nulls must stay: no outer form here.
    wanted = profiles.select(key, "company_name", F.explode(F.array_distinct(leaders)).alias("leader"))
    query = F.when(F.col("leader").isNull(), R.company_query(F.col("company_name"))).otherwise(
        R.leader_query(F.col("leader"), F.col("company_name"))
    )
    return wanted.select(key, "company_name", "leader", query.alias("query"))


def first_hits(hits: DataFrame, top: int = params.MAX_SEARCH_HITS) -> DataFrame:
    """Best hit with a profile URL among the ``top`` of each query: ``(query, rank, url, title)``.

    A minimum per query, combined before the shuffle, so a query with very many hits is no large group.
    """
    candidates = hits.where(F.col("rank") <= top).select(
        "query", "rank", R.hit_profile(F.col("href"), F.col("body")).alias("url"), "title"
    )
    best = (
        candidates.where(F.col("url").isNotNull())
        .groupBy("query")
        .agg(F.min(F.struct("rank", "url", "title")).alias("h"))
    )
    return best.select("query", "h.rank", "h.url", "h.title")


def found_profiles(profiles: DataFrame, hits: DataFrame, key: str, require_name_match: bool = False) -> DataFrame:
    """Search results per profile: ``(key, found)`` with one entry per search that gave a URL."""
    wanted = search_keys(profiles, key)
    answered = salted_join(wanted, first_hits(hits), ["query"], [key, "leader"], how="inner")
    if require_name_match:
        answered = answered.where(F.col("leader").isNull() | R.title_names(F.col("title"), F.col("leader")))
    person = R.name_and_role(F.col("title"), F.col("company_name"))
    entries = answered.select(key, F.struct("leader", "url", person.alias("person")).alias("entry"))
    # As many entries as one answer has leaders without URL.
    return entries.groupBy(key).agg(F.collect_list("entry").alias("found"))


def enrich_leaders(
    profiles: DataFrame,
    hits: DataFrame,
    key: str,
    search: bool = True,
    require_name_match: bool = False,
    eligible: Column | None = None,
) -> DataFrame:
    """Fill missing leader URLs, or add one leader where there was none; order and others stay.

    Adds ``search_fallback_triggered``, set whenever a search was due. Scores are not revised. Profiles
    that are not ``eligible`` (all are by default) pass unchanged.
    """
    due = R.needs_search(F.col("key_leadership"))
    if eligible is not None:
        due = due & eligible
    if not search:
        return profiles.withColumn("search_fallback_triggered", F.lit(False))

    def url_of(name):
        hit = F.filter("found", lambda e: e["leader"].eqNullSafe(name))
        return F.get(hit, 0)

    filled = F.transform(
        "key_leadership",
        lambda m: A.member(m["name"], m["role"], F.coalesce(m["linkedin_url"], url_of(m["name"])["url"])),
    )
    newcomer = F.get(F.filter("found", lambda e: e["leader"].isNull()), 0)
    added = F.array(A.member(newcomer["person"]["name"], newcomer["person"]["role"], newcomer["url"]))
    enriched = (
        F.when(F.col("found").isNull(), F.col("key_leadership"))
        .when(F.size("key_leadership") > 0, filled)
        .when(newcomer.isNotNull(), added)
        .otherwise(F.col("key_leadership"))
    )
    found = found_profiles(profiles.where(due), hits, key, require_name_match)
    joined = profiles.join(found, key, "left").withColumn("search_fallback_triggered", due)
    return joined.withColumn("key_leadership", enriched).select(*profiles.columns, "search_fallback_triggered")
