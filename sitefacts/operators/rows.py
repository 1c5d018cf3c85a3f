"""Adding columns and unfolding arrays without letting the optimizer repeat their expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row, whatever later steps do with them.

    A later filter or second use of a plain column may be pushed down or merged into the projection that
    makes it, which copies the expression; with parsers stacked on each other the copies multiply. Columns
    that come out of a generator stay where they are. The generator gives one row per row.
    """
    packed = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    return df.select("*", F.inline_outer(packed))


def unfolded(df: DataFrame, keep: list, array: Column | str, name: str = "item") -> DataFrame:
    """One row per array element; rows with an empty array give none.

    The outer form with a test afterwards, as the plain one would test the array's expression beforehand.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def unfolded_with_position(df: DataFrame, keep: list, array: Column | str, name: str = "item") -> DataFrame:
    return df.select(*keep, F.posexplode_outer(array).alias("pos", name)).where(F.col(name).isNotNull())
