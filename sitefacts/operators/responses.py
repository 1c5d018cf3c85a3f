"""Stored answers to checked records. One projection per answer: no shuffle, no Python workers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitefacts import params
from sitefacts.functions import answers as A
from sitefacts.functions.common import empty_array, on_columns
from sitefacts.operators.rows import computed, unfolded_with_position

NOT_AN_OBJECT = "Answer is not a JSON object"


def parse_responses(responses: DataFrame) -> DataFrame:
    """Add ``clean``, ``doc`` and ``state``: parsed, unparsable or not_object."""
    clean = computed(responses, clean=on_columns(A.unfence, "raw_json"))
    parsed = computed(clean, doc=on_columns(A.parse, "clean"))
    state = F.when(F.col("doc").isNull(), "unparsable").otherwise(
        F.when(A.kind(F.col("doc")) == "OBJECT", "parsed").otherwise("not_object")
    )
    return computed(parsed, state=state)


def validate_responses(responses: DataFrame) -> DataFrame:
    """Add ``error_fields`` and ``is_valid`` to parsed responses."""
    errors = F.when(F.col("state") == "parsed", on_columns(A.error_fields, "doc"))
    checked = computed(parse_responses(responses), error_fields=F.coalesce(errors, empty_array("string")))
    return checked.withColumn("is_valid", (F.col("state") == "parsed") & (F.size("error_fields") == 0))


def records(responses: DataFrame) -> DataFrame:
    """One checked record per answer, with rubric, blended score and the branch it came from.

    ``source`` is valid, salvaged, unparsable or not_object. The domain asked for stands; one in the answer
    is ignored. ``is_placeholder`` tells records whose overview is a stand-in text.
    """
    doc, domain = F.col("doc"), F.col("domain")
    source = (
        F.when(F.col("state") != "parsed", F.col("state")).when(F.col("is_valid"), "valid").otherwise("salvaged")
    )
    checked = computed(validate_responses(responses), source=source)
    src = F.col("source")
    name = A.default_name(domain)

    def pick(valid, salvaged, unparsable, not_object):
        return (
            F.when(src == "valid", valid)
            .when(src == "salvaged", salvaged)
            .when(src == "unparsable", unparsable)
            .otherwise(not_object)
        )

    def text(field):
        return A.field(doc, field, "string")

    failed = F.concat(F.lit("Failed to extract intelligence for "), domain, F.lit(f": {NOT_AN_OBJECT}"))
    salvaged_overview = A.text_or(doc, "company_overview", F.lit(params.SALVAGED_OVERVIEW))
    no_members = empty_array("struct<name:string,role:string,linkedin_url:string>")
    record = computed(
        checked,
        company_name=pick(text("company_name"), A.text_or(doc, "company_name", name), name, name),
        company_overview=pick(
            A.overview(text("company_overview")),
            A.overview(salvaged_overview),
            F.lit(params.PARSE_ERROR_OVERVIEW),
            failed,
        ),
        target_audience_icp=pick(
            text("target_audience_icp"),
            A.text_or(doc, "target_audience_icp", F.lit(params.SALVAGED_AUDIENCE)),
            F.lit(params.PARSE_ERROR_AUDIENCE),
            F.lit("N/A"),
        ),
        contact_points=F.when(src.isin("valid", "salvaged"), on_columns(A.contacts, "doc")).otherwise(
            empty_array("string")
        ),
        key_leadership=F.when(src == "valid", on_columns(A.members, "doc")).otherwise(no_members),
        own_score=pick(A.score(doc), *[F.lit(s).cast(A.SCORE) for s in ("0.2", "0.1", "0")]),
        confidence_reasoning=pick(
            text("confidence_reasoning"),
            F.concat(F.lit("Partial validation failure: "), F.array_join("error_fields", ", ")),
            F.lit(params.PARSE_ERROR_REASON),
            F.lit(f"Domain crawl or extraction failed: {NOT_AN_OBJECT}"),
        ),
    ).drop("clean", "doc", "state", "error_fields", "is_valid")
    filled = on_columns(A.rubric, "company_overview", "target_audience_icp", "contact_points", "key_leadership")
    scored = computed(record, rubric_score=filled)
    blended = F.when(src == "not_object", F.lit(0.0)).otherwise(A.blend(F.col("own_score"), F.col("rubric_score")))
    stand_ins = (params.PARSE_ERROR_OVERVIEW, params.SALVAGED_OVERVIEW, params.OVERVIEW_UNAVAILABLE)
    placeholder = F.col("company_overview").isin(*stand_ins) | (src == "not_object")
    return scored.withColumn("data_confidence_score", blended).withColumn("is_placeholder", placeholder)


def member_rows(records_: DataFrame, key: str) -> DataFrame:
    """One row per leader: ``(key, pos, name, role, linkedin_url)``."""
    rows = unfolded_with_position(records_, [key], "key_leadership", "m")
    return rows.select(key, "pos", "m.name", "m.role", "m.linkedin_url")
