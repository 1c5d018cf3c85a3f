from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sitefacts.llm import language_mixture as lm


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return docs.where(held), lm.fit(docs.where(~held))


def test_held_out_accuracy(fitted):
    held, model = fitted
    rows = lm.identify(held, model).join(held.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.98
    assert all(0 <= r["score"] <= 1 and abs(sum(r["shares"]) - 1) < 1e-3 for r in rows)


def test_mixtures_are_recovered(fitted):
    held, model = fitted
    texts = {r["lang"]: r["text"].split() for r in held.groupBy("lang").agg(F.max_by("text", F.length("text")).alias("text")).collect()}
    mixed = " ".join(texts["de"][:300] + texts["fr"][:100])
    share = dict(zip(model.names, lm.mixtures(pa.array([mixed]), model)[0]))
    assert abs(share["de"] - 0.75) < 0.06 and abs(share["fr"] - 0.25) < 0.06
    assert share["en"] == share["es"] == 0  # the penalty leaves out what is not needed


def test_rows_of_a_batch_do_not_touch(fitted):
    held, model = fitted
    texts = [None if i % 7 == 3 else r["text"][: 5 + 40 * i] for i, r in enumerate(held.limit(40).collect())] + ["", "7", "é", "a"]
    texts = [t or "" for t in texts]
    together = lm.mixtures(pa.array(texts), model)
    for i, text in enumerate(texts):
        assert np.allclose(together[i], lm.mixtures(pa.array([text]), model)[0], atol=1e-4), text


def test_odd_rows(spark, fitted):
    _, model = fitted
    rows = [(1, None, 1.0), (2, "", 1.0), (3, "123 --- !!", 1.0), (4, "漢字", 1.0), (4, "漢字", 1.0), (None, "the and of the", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score double")
    found = lm.identify(docs, model).collect()
    assert len(found) == 6
    by = {r["doc_id"]: r for r in found}
    assert {by[i]["lang_pred"] for i in (1, 2, 3)} == {"und"} and by[1]["score"] == 0 and by[1]["languages"] == []
    assert by[4]["lang_pred"] in model.names and by[None]["lang_pred"] == "en"
    assert lm.identify(docs.limit(0), model).count() == 0
    nothing = lm.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in lm.identify(docs, nothing).collect()} == {"und"}


def test_copies_of_a_text_do_not_crowd_out_the_others(spark):
    """One text fills most rows of a language: it counts once, and the others teach up to the bound."""
    docs = spark.range(23_000).select(
        F.when(F.col("id") < 3_000, "rare").otherwise("much").alias("lang"),
        F.when(F.col("id") < 3_000, F.concat(F.lit("seldom word "), F.char(97 + F.col("id") % 5)))
        .when(F.col("id") < 22_000, "the same text again")
        .otherwise(F.concat(F.lit("text "), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"))).alias("text"),
    )
    found = lm.training_texts(docs, {"rare": 5, "much": 1001}, 50).groupBy("lang").agg(F.count("text").alias("n"), F.count_distinct("text").alias("d"))
    assert {r["lang"]: (r["n"], r["d"]) for r in found.collect()} == {"rare": (5, 5), "much": (50, 50)}
    assert np.array_equal(lm.fit(docs, training_docs=50).weights, lm.fit(docs.distinct(), training_docs=50).weights)


def plain_fit(likelihood, chosen, rounds):
    """Expectation maximisation word by word over some languages; proportions and log likelihood."""
    share = {k: 1 / len(chosen) for k in chosen}
    for _ in range(rounds):
        sums = dict.fromkeys(chosen, 0.0)
        for word in likelihood:
            total = sum(share[k] * word[k] for k in chosen)
            for k in chosen:
                sums[k] += share[k] * word[k] / total
        share = {k: v / len(likelihood) for k, v in sums.items()}
    return share, sum(np.log(sum(share[k] * word[k] for k in chosen)) for word in likelihood)


def test_language_sets_against_trying_all(fitted):
    """The set found by dropping one language at a time is the best of all sets under the penalty, with its proportions."""
    import itertools

    held, model = fitted
    texts = {r["lang"]: r["text"].split() for r in held.groupBy("lang").agg(F.max_by("text", F.length("text")).alias("text")).collect()}
    names = sorted(texts)
    mixes = [[(names[0], 60)], [(names[1], 80), (names[2], 80)], [(names[3], 100), (names[0], 40)], [(names[0], 60), (names[1], 60), (names[2], 60)]]
    for mix in mixes:
        text = " ".join(" ".join(texts[lang][:n]) for lang, n in mix)
        bins, starts, _ = lm.word_grams(pa.array([text]))
        scores = np.add.reduceat(model.weights[bins].astype(float), starts, axis=0)
        likelihood = np.exp(scores - scores.max(axis=1, keepdims=True)).clip(1e-300)
        best = None
        for size in range(1, len(model.names) + 1):
            for chosen in itertools.combinations(range(len(model.names)), size):
                share, fitness = plain_fit(likelihood, chosen, 40)
                value = fitness - 0.5 * lm.PENALTY * np.log(len(starts)) * size
                if best is None or value > best[0]:
                    best = value, share
        found = lm.mixtures(pa.array([text]), model)[0]
        assert {model.names[i] for i in np.flatnonzero(found)} == {model.names[i] for i in best[1]} == {lang for lang, _ in mix}
        assert all(abs(found[i] - share) < 0.02 for i, share in best[1].items())
