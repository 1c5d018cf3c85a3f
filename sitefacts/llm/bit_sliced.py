"""Exact top-k inner products over a bit-sliced index.

The index cuts the rows into blocks and keeps, for each quantised component and each of its bits, the bitmap of the
block's rows that have the bit. A query's scores come from bitmap arithmetic alone: every slice enters the sum at the
weights that the query's component gives it, and full adders reduce the slices of each weight to the slices of the
score. The best rows are selected from the most significant slice downward; rows that tie at the boundary are resolved
by their ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sitefacts.plans.scratch import staged

SCALE = 256
BLOCK_ROWS = 32_768  # expected rows of a block: 4 KB a bitmap
QUERY_ROWS = 256  # expected queries of a query block


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows ``(id, v)`` whose vector is there and has finite components only."""
    v = F.col(vector_col).cast("array<double>")
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(fine & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), v.alias("v"))


def quantised(v: Column, scale: int) -> Column:
    return F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("bigint"))


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps (component, bit, bytes) of the values' distance from the smallest of their component, and that value."""
    low = values.min(axis=0)
    above = (values - low).astype(np.uint64)
    bits = max(1, int(above.max(initial=0)).bit_length())
    n, dims = values.shape
    planes = np.zeros((dims, bits, -(-n // 64) * 8), np.uint8)
    for bit in range(bits):
        planes[:, bit, : -(-n // 8)] = np.packbits(((above >> np.uint64(bit)) & np.uint64(1)).T.astype(np.uint8), axis=1, bitorder="little")
    return planes, low


def add_up(weighted: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """Slices of the sum, from the least significant, of bitmaps listed by the bit they count for."""
    out, weight = [], 0
    columns = {w: list(maps) for w, maps in weighted.items()}
    while columns:
        maps = columns.pop(weight, [])
        while len(maps) > 2:  # a full adder: three bitmaps of a weight become one and a carry
            a, b, c = maps.pop(), maps.pop(), maps.pop()
            either = a ^ b
            maps.insert(0, either ^ c)
            columns.setdefault(weight + 1, []).append((a & b) | (either & c))
        if len(maps) == 2:
            columns.setdefault(weight + 1, []).append(maps[0] & maps[1])
            maps = [maps[0] ^ maps[1]]
        out.append(maps[0] if maps else None)
        weight += 1
    return out


def scores_by_slices(planes: np.ndarray, low: np.ndarray, query: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Slices of ``score - base`` for all rows of a block, and ``base``.

    A negative component of the query takes the complement of the slices, so that all weights are positive:
    q * u = -|q| * top + |q| * (top - u), where top has all bits set.
    """
    n_bits = planes.shape[1]
    base, weighted, top = int(query @ low), {}, (1 << n_bits) - 1
    for component in np.flatnonzero(query):
        q = int(query[component])
        own = planes[component]
        if q < 0:
            base += q * top
            own, q = ~own, -q
        shift = 0
        while q:
            if q & 1:
                for bit in range(n_bits):
                    weighted.setdefault(bit + shift, []).append(own[bit])
            q >>= 1
            shift += 1
    return add_up(weighted), base


def count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def best_rows(slices: list[np.ndarray], among: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows sure to be among the k best, and rows that tie for the remaining places."""
    sure, tied = np.zeros_like(among), among.copy()
    for plane in reversed(slices):
        if plane is None:
            continue
        having = tied & plane
        found = count(sure) + count(having)
        if found > k:
            tied = having
        else:
            sure = sure | having
            tied = tied & ~plane
            if found == k:
                return sure, np.zeros_like(tied)
    return sure, tied


def rows_in(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def value_at(slices: list[np.ndarray], rows: np.ndarray) -> list[int]:
    """The numbers that slices hold for some rows."""
    found = [0] * len(rows)
    for bit, plane in enumerate(slices):
        if plane is not None:
            set_ = (plane[rows // 64] >> (rows % 64).astype(np.uint64)) & np.uint64(1)
            found = [f + (int(s) << bit) for f, s in zip(found, set_)]
    return found


def top_of_block(planes: np.ndarray, low: np.ndarray, ids: np.ndarray, query_id: int, query: np.ndarray, k: int):
    """``(score, id)`` of the k best rows of a block other than those of the query's id; equal scores by smaller id.

    ``ids`` are in order, so the first of the tied rows have the smallest ids.
    """
    every = np.packbits(np.arange(planes.shape[2] * 64) < len(ids), bitorder="little").view(np.uint64).copy()
    for row in range(np.searchsorted(ids, query_id), np.searchsorted(ids, query_id, side="right")):
        every[row // 64] &= ~(np.uint64(1) << np.uint64(row % 64))
    slices, base = scores_by_slices(planes, low, query)
    sure, tied = best_rows(slices, every, k)
    rows = np.concatenate([rows_in(sure), rows_in(tied)[: max(0, k - count(sure))]])
    return [(base + v, int(ids[r])) for r, v in zip(rows, value_at(slices, rows))]


def build_index(rows: DataFrame, blocks: int, scale: int = SCALE) -> DataFrame:
    """``(block, ids, low, planes, n_bits)`` with one row per block; ``ids`` in order."""

    def build(key, table):
        found = table.sort_by("id")
        ids = found["id"].to_numpy()
        values = found["v"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        planes, low = slices_of(values)
        return pa.Table.from_arrays(
            [
                pa.array([key[0].as_py()], pa.int32()), pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                pa.array([low.astype("<i8").tobytes()], pa.binary()), pa.array([planes.tobytes()], pa.binary()),
                pa.array([planes.shape[1]], pa.int32()),
            ],
            names=["block", "ids", "low", "planes", "n_bits"],
        )

    parts = rows.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), "id", quantised(F.col("v"), scale).alias("v"))
    return parts.groupBy("block").applyInArrow(build, "block int, ids binary, low binary, planes binary, n_bits int")


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The ``k`` rows of largest inner product for each query: ``query_id, rank, vec_id, score``.

    Components become ``floor(scale * x)``. A query is a row for which ``is_query`` holds, and is compared with all
    rows of other ids; ties go to the smaller id. Null vectors, vectors with null or non-finite components, vectors of
    another length than the query's, and rows without an id take no part; an empty vector scores 0. Repeated ids are
    rows of their own, and of queries that repeat an id one answers. Other columns are not read.

    Every block of the index meets every block of queries once; both are of bounded size, so a task holds one block
    and works off the queries. Each meeting returns k rows for each query.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col).withColumn("size", F.size("v"))
    queries = staged(
        usable(vectors.where(is_query), id_col, vector_col).groupBy("id").agg(F.min("v").alias("v"))
        .select("id", quantised(F.col("v"), scale).alias("v"), F.size("v").alias("size")), "topk-queries",
    )
    sizes = rows.groupBy("size").count().collect()  # one row for each vector length
    found = None
    for size, total in sorted((r["size"], r["count"]) for r in sizes):
        own = queries.where(F.col("size") == size)
        part = meetings(rows.where(F.col("size") == size), own, total, own.count(), k, scale, block_rows, query_rows)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], MEETING)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


MEETING = T.StructType([T.StructField(n, T.LongType()) for n in ("query_id", "vec_id", "score")])


def meetings(rows: DataFrame, queries: DataFrame, n_rows: int, n_queries: int, k: int, scale: int, block_rows: int, query_rows: int) -> DataFrame:
    """The k best of every index block for each query."""
    blocks, query_blocks = -(-n_rows // block_rows), max(1, -(-n_queries // query_rows))
    index = staged(build_index(rows, blocks, scale), "topk-index")
    # each query block goes to each index block: the stated query set against all rows, in blocks
    asked = queries.select(
        F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("query_block"), "id", "v",
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )

    def meet(key, asked_rows, block_row):
        out = []
        questions = list(zip(asked_rows["id"].to_pylist(), asked_rows["v"].to_pylist()))
        for block in block_row.to_pylist():  # one, or none if no row hashes to the block
            ids, low = np.frombuffer(block["ids"], "<i8"), np.frombuffer(block["low"], "<i8")
            planes = np.frombuffer(block["planes"], np.uint64).reshape(len(low), block["n_bits"], -1)
            for question, v in questions:
                out += [(question, vec, s) for s, vec in top_of_block(planes, low, ids, question, np.array(v, np.int64), k)]
        return pa.Table.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], names=["query_id", "vec_id", "score"])

    offered = index.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    return asked.groupBy("block", "query_block").cogroup(offered.groupBy("block", "query_block")).applyInArrow(meet, MEETING)
