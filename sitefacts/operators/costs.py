"""Token and cost accounting.

Costs are exact decimals, so sums do not depend on the order in which partitions are added up.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefacts import params

COST = "decimal(28,6)"
RATE = "decimal(12,4)"


def price_list(usage: DataFrame, rates: Mapping[str, tuple[str, str]] = params.MODEL_RATES) -> DataFrame:
    """The rates as a table; its size is that of the mapping."""
    rows = [
        F.struct(
            F.lit(model).alias("model_name"),
            F.lit(prompt).cast(RATE).alias("prompt_rate"),
            F.lit(completion).cast(RATE).alias("completion_rate"),
        )
        for model, (prompt, completion) in rates.items()
    ]
    return usage.sparkSession.range(1).select(F.inline(F.array(*rows)))


def cost(prompt: Column, completion: Column, prompt_rate: Column, completion_rate: Column) -> Column:
    """USD for the tokens at rates per million, rounded to six decimals."""
    millionths = prompt.cast("decimal(16,0)") * prompt_rate + completion.cast("decimal(16,0)") * completion_rate
    return (F.round(millionths, 0).cast("decimal(22,0)") * F.lit("0.000001").cast("decimal(6,6)")).cast(COST)


def usage_costs(usage: DataFrame, pricing: DataFrame | None = None, tracking: bool = True) -> DataFrame:
    """Add ``total_tokens`` and ``cost_usd`` to every call; no rows and so no cost with tracking off."""
    rates = F.broadcast(price_list(usage)) if pricing is None else pricing
    default_prompt, default_completion = (F.lit(r).cast(RATE) for r in params.DEFAULT_RATE)
    priced = usage.where(F.lit(tracking)).join(rates, "model_name", "left")
    return priced.select(
        *usage.columns,
        (F.col("prompt_tokens") + F.col("completion_tokens")).alias("total_tokens"),
        cost(
            F.col("prompt_tokens"),
            F.col("completion_tokens"),
            F.coalesce("prompt_rate", default_prompt),
            F.coalesce("completion_rate", default_completion),
        ).alias("cost_usd"),
    )


TOTALS = ("prompt_tokens", "completion_tokens", "total_tokens")


def usage_totals(costs: DataFrame, *by: str) -> DataFrame:
    """Sums of tokens and cost, over everything or per group; no usage adds up to zero."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TOTALS]
    zero = F.lit(0).cast(COST)
    return costs.groupBy(*by).agg(*sums, F.coalesce(F.sum("cost_usd").cast(COST), zero).alias("cost_usd"))


def _printed(rows: DataFrame) -> DataFrame:
    tokens = [F.format_string("%,d", F.col(c)).alias(c) for c in TOTALS]
    return rows.select(
        "domain", "model_name", *tokens, F.concat(F.lit("$"), F.col("cost_usd").cast("string")).alias("cost_usd")
    )


def cost_report(costs: DataFrame) -> DataFrame:
    """Printed rows of every call followed by the total."""
    total = usage_totals(costs).withColumn("domain", F.lit("TOTAL")).withColumn("model_name", F.lit("-"))
    return _printed(costs).unionByName(_printed(total))


def cost_rollup(costs: DataFrame) -> DataFrame:
    """Sums per domain and model, per domain, and over everything (nulls mark the summed-up columns)."""
    sums = [F.sum(c).alias(c) for c in TOTALS]
    return costs.rollup("domain", "model_name").agg(*sums, F.sum("cost_usd").cast(COST).alias("cost_usd"))
