"""Final records: metadata, fallbacks, completeness, flat form and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefacts import schemas
from sitefacts.functions import answers as A
from sitefacts.functions.common import empty_array, strip
from sitefacts.functions.urls import name_from_domain

FIELDS = tuple(f.name for f in schemas.PROFILE.fields)


def metadata(
    pages: Column, provider: Column, model: Column, prompt: Column, completion: Column, cost: Column, searched: Column
) -> Column:
    return F.struct(
        F.coalesce(pages, empty_array("string")).alias("pages_crawled"),
        provider.alias("llm_provider"),
        model.alias("model_name"),
        prompt.cast("bigint").alias("prompt_tokens"),
        completion.cast("bigint").alias("completion_tokens"),
        (prompt + completion).cast("bigint").alias("total_tokens"),
        cost.cast("double").alias("estimated_cost_usd"),
        searched.alias("search_fallback_triggered"),
    )


def attach_metadata(records: DataFrame, costs: DataFrame, pages: DataFrame, key: str = "domain") -> DataFrame:
    """Add ``metadata`` from the call's cost and the site's pages; both sides hold one row per site."""
    priced = records.join(costs.select(key, "cost_usd"), key, "left").join(pages, key, "left")
    return priced.withColumn(
        "metadata",
        metadata(
            F.col("pages_crawled"),
            F.col("provider"),
            F.col("model_name"),
            F.col("prompt_tokens"),
            F.col("completion_tokens"),
            F.coalesce(F.col("cost_usd"), F.lit(0)),
            F.lit(False),
        ),
    )


def fallback_fields(domain: Column, message: Column) -> dict[str, Column]:
    """Fields of the empty record of a failed site: the message, no score and zero usage."""
    zero = F.lit(0)
    return {
        "company_name": name_from_domain(domain),
        "company_overview": F.concat(F.lit("Failed to extract intelligence for "), domain, F.lit(": "), message),
        "target_audience_icp": F.lit("N/A"),
        "contact_points": empty_array("string"),
        "key_leadership": empty_array("struct<name:string,role:string,linkedin_url:string>"),
        "data_confidence_score": F.lit(0.0),
        "confidence_reasoning": F.concat(F.lit("Domain crawl or extraction failed: "), message),
        "metadata": metadata(
            empty_array("string"), F.lit("gemini"), F.lit("gemini-3.6-flash"), zero, zero, F.lit(0.0), F.lit(False)
        ),
    }


def fallback_profiles(failed: DataFrame) -> DataFrame:
    """Empty records for failed sites: ``(domain, error_message)`` in, profiles out."""
    message = F.coalesce(F.col("error_message"), F.lit("Homepage unreachable"))
    return failed.select("domain", *[c.alias(n) for n, c in fallback_fields(F.col("domain"), message).items()])


def complete_batch(
    seeds: DataFrame, profiles: DataFrame, reason: str = "No answer stored", copies_per_task: int = 10_000
) -> DataFrame:
    """Exactly one row per seed, in the seeds' multiplicity; sites without a profile get a fallback.

    A domain may be listed any number of times. Seeds are counted first, so the join sees each domain once
    on both sides; the copies of a domain listed very often are then made in several tasks.
    """
    counted = seeds.groupBy("domain").agg(F.count("*").alias("_copies"))
    empty = fallback_fields(F.col("domain"), F.lit(reason))
    joined = counted.join(profiles.select(*FIELDS).withColumn("_known", F.lit(True)), "domain", "left")
    fields = [F.when(F.col("_known"), F.col(n)).otherwise(c).alias(n) for n, c in empty.items()]
    known = joined.select("domain", "_copies", *fields)
    per_slice = F.lit(copies_per_task)
    slices = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / per_slice))
    sliced = known.withColumn("_slice", F.explode(slices)).repartition("domain", "_slice")
    in_slice = F.least(F.col("_copies") - F.col("_slice") * per_slice, per_slice)
    return sliced.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), in_slice))).select(*FIELDS)


def sentences(text: Column, count: int) -> Column:
    """The first sentences of a text, joined by a blank."""
    flat = strip(F.regexp_replace(text, r"\s+", " "))
    found = F.regexp_extract_all(flat, F.lit(r"[^.!?]+(?:[.!?]+|$)"), F.lit(0))
    return F.array_join(F.transform(F.slice(found, 1, count), strip), " ")


def extractive_profiles(sites: DataFrame) -> DataFrame:
    """Profiles by rule for sites with pages but no answer.

    Input ``(domain, title, main_text, emails)``: the name is the first part of the title, else comes from
    the domain; the overview is the first two sentences; contacts are the detected addresses.
    """
    lead = strip(F.regexp_extract(F.coalesce("title", F.lit("")), r"^(.*?)(?:\s+[-|–—]\s+.*)?$", 1))
    name = F.when(lead == "", name_from_domain(F.col("domain"))).otherwise(lead)
    no_members = empty_array("struct<name:string,role:string,linkedin_url:string>")
    base = sites.select(
        "domain",
        name.alias("company_name"),
        A.overview(sentences(F.coalesce("main_text", F.lit("")), 2)).alias("company_overview"),
        F.lit("").alias("target_audience_icp"),
        A.clean_contacts(F.coalesce("emails", empty_array("string"))).alias("contact_points"),
        no_members.alias("key_leadership"),
    )
    filled = A.rubric(
        F.col("company_overview"), F.col("target_audience_icp"), F.col("contact_points"), F.col("key_leadership")
    )
    return base.withColumn("data_confidence_score", filled.cast("double"))


def flat_leaders(leaders: Column) -> Column:
    """``name (role) [url]`` per leader, joined by semicolons."""
    one = lambda m: F.concat(
        m["name"],
        F.lit(" ("),
        m["role"],
        F.lit(")"),
        F.when(m["linkedin_url"].isNull(), "").otherwise(F.concat(F.lit(" ["), m["linkedin_url"], F.lit("]"))),
    )
    return F.array_join(F.transform(leaders, one), "; ")


def flat_profiles(profiles: DataFrame) -> DataFrame:
    """The ten columns of the flat export."""
    cost = F.coalesce(F.col("metadata.estimated_cost_usd"), F.lit(0.0))
    return profiles.select(
        "domain",
        "company_name",
        "company_overview",
        "target_audience_icp",
        F.array_join("contact_points", "; ").alias("contact_points"),
        flat_leaders(F.col("key_leadership")).alias("key_leadership"),
        "data_confidence_score",
        "confidence_reasoning",
        F.coalesce(F.col("metadata.total_tokens"), F.lit(0)).alias("total_tokens"),
        F.concat(F.lit("$"), cost.cast("decimal(28,6)").cast("string")).alias("estimated_cost_usd"),
    )


def confidence_band(score: Column) -> Column:
    return F.when(score >= 0.7, "high").when(score >= 0.4, "medium").otherwise("low")


def result_summary(profiles: DataFrame) -> DataFrame:
    """Counts, printed score and confidence band of every profile."""
    score = F.col("data_confidence_score")
    return profiles.select(
        "domain",
        "company_name",
        "target_audience_icp",
        F.size("contact_points").alias("emails"),
        F.size("key_leadership").alias("leaders"),
        score.cast("decimal(10,2)").cast("string").alias("confidence"),
        confidence_band(score).alias("band"),
    )


def site_counters(pages: DataFrame, values: DataFrame, site: str) -> DataFrame:
    """Pages, distinct emails and distinct profile URLs per site.

    ``values`` holds each ``(site, kind, value)`` once, so counting is adding up, combined before the shuffle.
    """
    counted = values.groupBy(site).agg(
        F.count_if(F.col("kind") == "emails").alias("emails"),
        F.count_if(F.col("kind") == "profiles").alias("profiles"),
    )
    per_site = pages.groupBy(site).agg(F.count("*").alias("pages"))
    zero = F.lit(0)
    return per_site.join(counted, site, "left").select(
        site, "pages", F.coalesce("emails", zero).alias("emails"), F.coalesce("profiles", zero).alias("profiles")
    )
