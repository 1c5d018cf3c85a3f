"""Leaving out rows that a later join would drop, before they are shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS = 1 << 15, 1 << 27  # of the bitmap; the most is 16 MB
BITS_PER_KEY = 16


def likely_wanted(rows: DataFrame, wanted: DataFrame, on: Sequence[str], keys: int, most_bits: int = MOST_BITS) -> DataFrame:
    """``rows`` whose ``on`` columns are probably among those of ``wanted``; a join with ``wanted`` decides.

    The ``keys`` keys set bits by their hash in a bitmap of about ``BITS_PER_KEY`` bits for each, which is broadcast in
    pieces of 4 KB. No wanted row is lost; of the others about one in ``BITS_PER_KEY`` passes, or more once the bitmap
    has reached its greatest size.
    """
    bits = LEAST_BITS
    while bits < min(keys * BITS_PER_KEY, most_bits):
        bits *= 2
    place = F.pmod(F.xxhash64(*on), F.lit(bits)).cast("bigint")
    pieces = (
        wanted.select(place.alias("_place"))
        .groupBy(F.expr("bitmap_bucket_number(_place)").alias("_piece"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_place))").alias("_map"))
    )
    placed = rows.withColumn("_place", place).withColumn("_piece", F.expr("bitmap_bucket_number(_place)"))
    met = placed.join(F.broadcast(pieces), "_piece")
    byte = F.conv(F.hex(F.expr("substring(_map, cast(bitmap_bit_position(_place) div 8 + 1 as int), 1)")), 16, 10).cast("int")
    bit = F.expr("cast(bitmap_bit_position(_place) % 8 as int)")
    return met.where(F.call_function("shiftright", byte, bit).bitwiseAND(F.lit(1)) == 1).select(*rows.columns)
