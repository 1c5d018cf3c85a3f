"""Explicit schemas of the tables the engine reads and writes; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

SEEDS = T.StructType([T.StructField("domain", T.StringType())])

PAGES = T.StructType(
    [
        T.StructField("site_id", T.LongType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("url", T.StringType()),
        T.StructField("final_url", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("html", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("error_message", T.StringType()),
    ]
)

RESPONSES = T.StructType(
    [
        T.StructField("domain", T.StringType()),
        T.StructField("provider", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("raw_json", T.StringType()),
        T.StructField("prompt_tokens", T.LongType()),
        T.StructField("completion_tokens", T.LongType()),
    ]
)

HITS = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("href", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)

USAGE = T.StructType(
    [
        T.StructField("domain", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("prompt_tokens", T.LongType()),
        T.StructField("completion_tokens", T.LongType()),
    ]
)

MEMBER = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("linkedin_url", T.StringType()),
    ]
)

METADATA = T.StructType(
    [
        T.StructField("pages_crawled", T.ArrayType(T.StringType())),
        T.StructField("llm_provider", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("prompt_tokens", T.LongType()),
        T.StructField("completion_tokens", T.LongType()),
        T.StructField("total_tokens", T.LongType()),
        T.StructField("estimated_cost_usd", T.DoubleType()),
        T.StructField("search_fallback_triggered", T.BooleanType()),
    ]
)

PROFILE = T.StructType(
    [
        T.StructField("domain", T.StringType()),
        T.StructField("company_name", T.StringType()),
        T.StructField("company_overview", T.StringType()),
        T.StructField("target_audience_icp", T.StringType()),
        T.StructField("contact_points", T.ArrayType(T.StringType())),
        T.StructField("key_leadership", T.ArrayType(MEMBER)),
        T.StructField("data_confidence_score", T.DoubleType()),
        T.StructField("confidence_reasoning", T.StringType()),
        T.StructField("metadata", METADATA),
    ]
)
