from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sitefacts.llm import mixing as mx


def posterior_table(spark, seed, n=400, size=3):
    rng = np.random.default_rng(seed)
    p = rng.dirichlet(np.full(size, 0.4), n)
    tokens = rng.integers(0, 200, n)
    table = spark.createDataFrame([(int(t), [float(x) for x in row]) for t, row in zip(tokens, p)], "tokens bigint, p array<double>")
    return table, tokens, p


@pytest.mark.parametrize("targets", [[0.5, 0.3, 0.2], [0.9, 0.1, 0.0], [0.34, 0.33, 0.33]])
def test_rates_meet_the_targets(spark, targets):
    table, tokens, p = posterior_table(spark, 3)
    total = tokens.sum()
    rate = mx.rates_after(p, mx.fit_rates(table, np.array(targets), total))
    reached = (tokens * rate) @ p / total
    assert (rate >= 0).all()
    # the best that nonnegative rates reach, by long plain projected gradient on one machine
    best, step = np.ones(len(p)), 1 / np.linalg.eigvalsh((p * tokens[:, None]).T @ p / total)[-1]
    for _ in range(5000):
        best = np.maximum(0, best - step * p @ ((tokens * best) @ p / total - targets))
    optimum = np.abs((tokens * best) @ p / total - targets).max()
    assert np.abs(reached - targets).max() <= optimum + 1e-2


def test_classifier_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("toxic = 0")
    labelled = labels.select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("poor").alias("domain"))
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = mx.fit_classifier(docs, labelled.where(~held), ["good", "poor"])
    rows = docs.join(labelled.where(held), "doc_id").collect()
    p, tokens = mx.posteriors(pa.array([r["text"] for r in rows]), model)
    assert np.mean([model.domains[i] == r["domain"] for i, r in zip(p.argmax(axis=1), rows)]) > 0.95
    assert np.allclose(p.sum(axis=1), 1) and tokens.tolist() == [len(r["text"].split()) for r in rows]


def test_mixture_and_odd_rows(spark):
    random.seed(1)
    rows = [(i, " ".join(random.choices(["a", "b", "c"] if i % 4 else ["x", "y", "z"], k=30)), 1.0) for i in range(400)]
    rows += [(None, "a b", 1.0), (500, None, 1.0), (501, "", 1.0), (3, rows[3][1], 1.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, rate double")
    labelled = spark.createDataFrame([(i, "letters" if i % 4 else "end") for i in range(100)] + [(7, None), (None, "end")], "doc_id bigint, domain string")
    targets = {"letters": 0.5, "end": 0.5}
    model = mx.fit_classifier(docs, labelled, list(targets))
    mixed = mx.mix(docs, model, targets)
    assert mixed.columns == ["doc_id", "text", "tokens", "posteriors", "rate", "copies"]
    found = {r["doc_id"]: r for r in mixed.collect()}
    assert found[500]["tokens"] == found[501]["tokens"] == 0 and found[500]["text"] is None
    assert found[0]["rate"] > 1.5 and found[1]["rate"] < 0.8
    out = mx.sampled(mixed)
    assert out.columns == ["doc_id", "text"] and out.count() == mixed.agg(F.sum("copies")).first()[0]
    share = out.where("doc_id % 4 = 0").count() / out.count()
    assert 0.4 < share < 0.6
    assert mx.mix(docs.limit(0), model, targets).count() == 0
    alone = mx.fit_classifier(docs, labelled.limit(0), list(targets))
    assert mx.mix(docs, alone, targets).count() == 404
