from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from sitefacts.llm import bit_sliced as bs


def brute(rows, k, every):
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for i, q in {i: q for i, q in sorted(fine, reverse=True)}.items():
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in fine if j != i and len(v) == len(q))
            out |= {(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scored[:k])}
    return out


def test_slices_give_the_scores():
    rng = np.random.default_rng(1)
    for dims, spread in ((1, 3), (5, 300), (16, 90)):
        values, query = rng.integers(-spread, spread, (200, dims)), rng.integers(-spread, spread, dims)
        planes, low = bs.slices_of(values)
        slices, base = bs.scores_by_slices(planes.view(np.uint64), low, query)
        assert [base + v for v in bs.value_at(slices, np.arange(200))] == (values @ query).tolist()


def test_against_brute_force(spark):
    random.seed(4)
    rows = [(i, [random.uniform(-1, 1) for _ in range(6)]) for i in range(400)]
    rows += [(i, random.choice([[0.5] * 6, [-0.25] * 6, [0.0] * 6])) for i in range(400, 700)]  # ties
    rows += [(700, None), (701, [1.0, None, 0, 0, 0, 0]), (750, [float("nan")] * 6), (None, [1.0] * 6), (702, [float("inf")] + [0.0] * 5)]
    rows += [(703, [3.0, 4.0]), (800, [1.0, 2.0]), (900, [7.0] * 5), (704, [50.0] * 6)]
    vectors = spark.createDataFrame([(i, v and [x if x is None else float(x) for x in v], 1) for i, v in rows], "vec_id bigint, embedding array<double>, score int")
    for options in ({}, {"block_rows": 50, "query_rows": 3}):
        found = [tuple(r) for r in bs.top_k(vectors, F.col("vec_id") % 50 == 0, **options).collect()]
        assert len(found) == len(set(found)) and set(found) == brute(rows, 5, 50)


def test_small_and_empty(spark):
    vectors = spark.createDataFrame([(0, [1.0]), (1, [1.0]), (1, [1.0]), (0, [0.5])], "vec_id bigint, embedding array<float>")
    found = [tuple(r) for r in bs.top_k(vectors, F.col("vec_id") % 50 == 0).collect()]
    assert [r[:3] for r in sorted(found)] == [(0, 1, 1), (0, 2, 1)]
    assert bs.top_k(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0
