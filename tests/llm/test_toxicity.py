from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitefacts.llm import toxicity as tx


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in tx.initial(30).items()}
    x = rng.standard_normal((9, tx.EMBEDDING))
    x[0] = 0
    numbers = rng.integers(1, 9, (6, 3))
    numbers[4:, 1] = 0
    labels = np.array([1.0, 0, 1])
    _, grads, dx = tx.gradients(numbers, x, labels, p)

    def slope(array, place, step=1e-3):
        old = array[place]
        values = []
        for sign in (1, -1):
            array[place] = old + sign * step
            values.append(tx.gradients(numbers, x, labels, p)[0])
        array[place] = old
        return (values[0] - values[1]) / (2 * step)

    for name, grad in grads.items():
        for _ in range(5):
            place = tuple(rng.integers(0, n) for n in p[name].shape)
            assert abs(slope(p[name], place) - grad[place]) < 1e-4, name
    for word in range(1, 9):
        assert abs(slope(x, (word, 2)) - dx[word, 2]) < 1e-4


def test_windows_cover_and_overlap():
    for n in range(400):
        starts = list(tx.window_starts(n))
        covered = {w for s in starts for w in range(s, min(n, s + tx.WINDOW))}
        assert covered == set(range(n)) and starts[0] == 0
        assert all(b - a == tx.STRIDE for a, b in zip(starts, starts[1:]))
        assert n <= tx.WINDOW or n - starts[-1] > tx.WINDOW - tx.STRIDE


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = tx.fit(docs, labels.where(~held))
    return docs.join(labels.where(held), "doc_id"), model


def test_held_out_documents(fitted):
    held, model = fitted
    rows = tx.score(held, model).join(held.select("doc_id", "toxic"), "doc_id").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert np.mean(toxic) > 0.87 and np.mean(clean) < 0.02
    assert all((r["score"] >= 0.7) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in rows)


def test_scores_do_not_depend_on_neighbours(fitted, monkeypatch):
    held, model = fitted
    texts = [r["text"] for r in held.limit(25).collect()] + ["", "a", "idiot", "!!"]
    together, number, counts = tx.Scorer(model)(texts)
    for i, text in enumerate(texts):
        alone = tx.Scorer(model)([text])
        assert np.allclose(together[i], alone[0][0], atol=1e-5) and counts[i] == len(tx.window_starts(len(tx.words_of(text))))
    monkeypatch.setattr(tx, "KNOWN_WORDS", 1)
    scorer = tx.Scorer(model)
    assert np.allclose(together, [scorer([t])[0][0] for t in texts], atol=1e-5)


def plain_score(model, text):
    """The network written out word by word: the best of the windows, each read alone in both directions."""
    p, words, out = {k: v.astype(np.float64) for k, v in model.weights.items()}, tx.words_of(text), []

    def vector(word):
        names = tx.features(word)
        rows = [p["E"][model.vocabulary[n]] * (1 if n == names[0] else 1 / (len(names) - 1)) for n in names if n in model.vocabulary]
        return np.sum(rows, axis=0) if rows else np.zeros(tx.EMBEDDING)

    def read(vectors, d):
        h, states = np.zeros(tx.HIDDEN), []
        for x in vectors:
            gates, recurrent = x @ p[f"W{d}"] + p[f"b{d}"], h @ p[f"U{d}"]
            z, r = (1 / (1 + np.exp(-(gates + recurrent)[k * tx.HIDDEN : (k + 1) * tx.HIDDEN])) for k in (0, 1))
            candidate = np.tanh(gates[2 * tx.HIDDEN :] + r * recurrent[2 * tx.HIDDEN :])
            h = (1 - z) * candidate + z * h
            states.append(h)
        return states

    for start in tx.window_starts(len(words)):
        vectors = [vector(w) for w in words[start : start + tx.WINDOW]]
        states = [np.concatenate(pair) for pair in zip(read(vectors, "f"), read(vectors[::-1], "b")[::-1])] or [np.zeros(2 * tx.HIDDEN)]
        weights = np.exp([np.tanh(s @ p["A"]) @ p["a"] for s in states])
        out.append(1 / (1 + np.exp(-(np.sum([w * s for w, s in zip(weights / weights.sum(), states)], axis=0) @ p["w"] + p["c"][0]))))
    return max(out)


def test_scores_equal_reading_word_by_word(fitted):
    held, model = fitted
    texts = [r["text"] for r in held.limit(12).collect()] + ["", "a", "idiot", "you pathetic moron, get lost", "é 日本 x1"]
    assert np.allclose(tx.Scorer(model)(texts)[0], [plain_score(model, t) for t in texts], atol=1e-4)


def test_vectors_of_many_words_take_little_more_memory_than_themselves():
    import tracemalloc

    known = tx.Features({name: i for i, name in enumerate({f for i in range(30_000) for f in tx.features(f"longword{i}ending")})})
    for i in range(30_000):
        known.number(f"longword{i}ending")
        if i % 1000 == 0:
            known.number("α" * (i // 1000 + 1))  # a word without features
    table = np.random.default_rng(1).standard_normal((len(known.vocabulary), tx.EMBEDDING)).astype(np.float32)
    tracemalloc.start()
    found = tx.vectors(table, known)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < found.nbytes + (16 << 20)
    word, place, weight = known.arrays()
    expected = np.zeros_like(found)
    np.add.at(expected, word, table[place] * weight[:, None])
    assert np.allclose(found, expected, atol=1e-4) and np.array_equal(found[7:], tx.vectors(table, known, 7))


def test_common_features_are_those_that_enough_texts_hold():
    rng = np.random.default_rng(3)
    words = [f"{a}{b}" for a in ("ab", "abcd", "xyzuvw") for b in range(40)]
    owner, word = np.array(sorted({(int(o), int(w)) for o, w in zip(rng.integers(0, 450, 3000), rng.integers(0, len(words), 3000))})).T
    holders = {}
    for o, w in zip(owner.tolist(), word.tolist()):
        for name in tx.features(words[w]):
            holders.setdefault(name, set()).add(o)
    least = max(tx.LEAST_DOCS, round(tx.LEAST_SHARE * (owner[-1] + 1)))
    expected = sorted(n for n, o in holders.items() if len(o) >= least)
    assert tx.common_features(words, word, owner) == {n: i for i, n in enumerate(expected)}


def test_sample_is_bounded_by_whole_documents(spark):
    docs = spark.createDataFrame([(i, "word " * 100 + ("idiot" if i % 2 else "flower")) for i in range(40)] + [(99, "idiot " * 5000)], "doc_id bigint, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
    taken = []
    original = tx.train
    tx.train = lambda texts, found, *a: (taken.append((texts, found)), original(texts, found, *a))[1]
    try:
        tx.fit(docs, labels, training_words=1010)
    finally:
        tx.train = original
    texts, found = taken[0]
    assert [sum(found == k) for k in (0, 1)] == [10, 10] and all(len(t.split()) == 101 for t in texts)


def test_null_texts_stay_and_names_may_clash(spark, fitted):
    _, model = fitted
    rows = [(1, None, "a"), (2, "", "b"), (3, "idiot moron pathetic scum worthless", "c"), (4, "a quiet day by the sea", "d"), (4, "a quiet day by the sea", "d")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, scored_text string").selectExpr("*", "1 as score", "2 as id", "3 as label")
    found = tx.without_toxic(docs, model)
    assert found.columns == docs.columns and sorted(r["doc_id"] for r in found.collect()) == [1, 2, 4, 4]
    all_toxic = tx.fit(docs, spark.createDataFrame([(i, 1) for i in (2, 3, 4)], "doc_id bigint, toxic int"))
    assert [r["doc_id"] for r in tx.without_toxic(docs, all_toxic).collect()] == [1]


def test_a_toxic_passage_anywhere_in_a_long_text_counts(fitted):
    held, model = fitted
    clean = held.where("toxic = 0").orderBy(F.length("text").desc()).first()["text"].split()[:6000]
    insult = "idiot moron pathetic scum worthless".split()
    scores = tx.Scorer(model)([" ".join(clean), *(" ".join(clean[:i] + insult + clean[i:]) for i in (0, 3000, 6000))])[0]
    assert scores[0] < 0.7 and min(scores[1:]) >= 0.7


def test_odd_rows(spark, fitted):
    _, model = fitted
    rows = [(1, None, 0.5), (2, "", 0.5), (2, "", 0.5), (None, "idiot", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score double")
    assert tx.score(docs, model).count() == 4
    assert tx.score(docs.limit(0), model).count() == 0
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id bigint, toxic int")
    assert all(r["predicted"] == 0 for r in tx.score(docs, tx.fit(docs, labels)).collect())
    assert tx.score(docs, tx.fit(docs, labels.limit(0))).count() == 4


def test_words_looked_up_together_have_the_features_of_each():
    """Short and long words, pieces that a word repeats, characters of all widths; words before and after others."""
    rng = random.Random(3)
    words = list(dict.fromkeys("".join(rng.choice("abeéß漢😀'") for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 7, 9, 14, 40]))) for _ in range(3000)))
    names = sorted({f for w in words[::2] + ["haha" * 6] for f in tx.features(w)})
    vocabulary = {name: i for i, name in enumerate(rng.sample(names, len(names) * 2 // 3))}
    one, many = tx.Features(vocabulary), tx.Features(vocabulary)
    for low in range(0, len(words), 700):
        numbers = [many.later(w) for w in [*words[low : low + 700], "haha" * (7 + low)]]
        many.look_up()
        assert numbers == [one.number(w) for w in [*words[low : low + 700], "haha" * (7 + low)]]

    def rows(known):
        word, place, weight = known.arrays()
        order = np.lexsort((place, word))
        return [x[order].tolist() for x in (word, place, weight)]

    assert rows(one) == rows(many) and len(one.places) > 3000
    empty = tx.Features({})
    empty.later("word")
    empty.look_up()
    assert list(empty.sizes) == [0, 0]
