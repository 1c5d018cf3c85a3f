"""Joins whose left side may hold very many rows of a few keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitefacts import params


def salted_join(
    many: DataFrame,
    one: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    hot_rows: int = params.HOT_KEY_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join ``many`` rows to at most one row per key, with the result of a plain join.

    Only keys of more than ``hot_rows`` rows are salted: theirs are dealt to one task for every so many, by a hash of
    ``spread_by``, and the other side's row of such a key is repeated as often; all other rows meet in a plain join.
    ``counts`` names the rows of each key, ``(*on, n)``; by default the keys are counted, which combines before its
    shuffle. There are no more hot keys than ``many`` has rows over ``hot_rows``, so the broadcast of their names is small.
    """
    counted = many.groupBy(*on).agg(F.count(F.lit(1)).alias("n")) if counts is None else counts
    slices = F.ceil(F.col("n") / hot_rows).cast("int")
    hot = F.broadcast(counted.where(F.col("n") > hot_rows).select(*on, slices.alias("_slices")))
    salt = F.when(F.col("_slices").isNull(), 0).otherwise(F.pmod(F.xxhash64(*spread_by), F.col("_slices"))).cast("int")
    salted = many.join(hot, list(on), "left").withColumn("_slice", salt).drop("_slices")
    each = F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1))
    repeated = one.join(hot, list(on), "left").withColumn("_slice", each).drop("_slices")
    return salted.join(repeated, [*on, "_slice"], how).drop("_slice")
