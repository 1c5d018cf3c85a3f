from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sitefacts.llm import ranked_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=10):
    """Scores of all documents for all items, by definition."""
    counts = [(doc, Counter(terms(text))) for doc, text in docs]
    lengths = [sum(c.values()) for _, c in counts]
    n_docs, n_terms = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for (doc, c), n in zip(counts, lengths):
            score = 0
            for t in set(terms(text)) & c.keys():
                m = 10 + 90 * n * n_docs // n_terms
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, doc is not None, doc if doc is not None else 0, doc))
        found.sort(key=lambda f: f[:3])
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(found[:k], 1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(seed, n):
    draw = random.Random(seed)
    words = [f"w{int(draw.paretovariate(0.7)) % 400}" for _ in range(20_000)]
    return [" ".join(draw.choices(words, k=draw.choice([0, 1, 3, 8, 30, 200]))) for _ in range(n)]


@pytest.mark.parametrize("block_postings, short, at_once", [(1 << 20, 256, 16), (700, 4, 3), (1, 1, 1)])
def test_equals_scoring_all_documents(spark, monkeypatch, block_postings, short, at_once):
    """Small intervals, so that most documents are reached by splitting; executors run threads of this process's code."""
    monkeypatch.setattr(ranked_search, "SHORT_INTERVAL", short)
    monkeypatch.setattr(ranked_search, "AT_ONCE", at_once)
    texts = corpus(1, 600 if block_postings > 1 else 60)
    docs = list(enumerate(texts + texts[:30]))  # equal scores
    items = [(i, t) for i, t in enumerate(corpus(2, 12))]
    found = ranked_search.top_documents(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), spark.createDataFrame(items, "item_id int, text string"), block_postings=block_postings
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(found) == plain(docs, items)


def test_items_in_several_passes(spark):
    docs, items = list(enumerate(corpus(3, 80))), list(enumerate(corpus(4, 9)))
    found = ranked_search.top_documents(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id int, text string").coalesce(1), k=3, terms_at_once=20
    )
    assert rows(found) == plain(docs, items, 3)


def test_blocks_prune():
    """Most documents of a block with few good ones are never scored."""
    n = 100_000
    rng = np.random.default_rng(5)
    tfs = rng.integers(1, 3, n)
    tfs[[70, 5000, 99_000]] = 500
    block = ranked_search.Block(pa.array(range(n)), np.full(n, 100), np.ones(n, np.int64), np.zeros(n, np.int32), tfs)
    scored = []
    best = ranked_search.Best(3)
    offer = best.offer
    best.offer = lambda scores, ordinals, ids: (scored.extend(ordinals.tolist()), offer(scores, ordinals, ids))
    block.search(np.array([0]), np.array([7]), best)
    assert [f[2] for f in best.found] == [70, 5000, 99_000]
    assert len(scored) < n / 50


def test_sparse_table_answers_every_range():
    rng = np.random.default_rng(6)
    sizes = rng.integers(0, 40, 50)
    owner = np.repeat(np.arange(50), sizes)
    terms_, tfs = np.concatenate([rng.choice(60, s, replace=False) for s in sizes]), rng.integers(1, 9, len(owner))
    block = ranked_search.Block(pa.array(range(50)), rng.integers(10, 500, 50), sizes, terms_, tfs)
    for term in range(60):
        low, high = np.searchsorted(block.keys, [term * 50, (term + 1) * 50])
        for a in range(low, high):
            for b in range(a, high + 1):
                at, impact = block.peak(np.array([a]), np.array([b]))
                assert impact[0] == block.impact[a:b].max(initial=0)
                assert a == b or (a <= at[0] < b and block.impact[at[0]] == impact[0])


ODD = [
    (None, "Zebra zebra"), (1, None), (2, ""), (3, " .,;"), (4, "zebra" + " filler" * 50_000), (5, "ZEBRA éÉ 日本 a_b"), (5, "ZEBRA éÉ 日本 a_b"),
    (6, "a\x00b zebra\x7fx"), (7, "x" * 100_000),
]


def test_odd_texts(spark):
    items = [(1, "zebra É 日本"), (1, "zebra É 日本"), (None, "a b ZEBRA zebra"), (2, None), (3, ""), (4, "nowhere"), (5, "x" * 100_000)]
    docs = spark.createDataFrame(ODD, "doc_id int, text string").withColumnsRenamed({}).selectExpr("*", "1 as score", "2 as rank", "3 as item", "4 as block", "5 as id", "6 as terms")
    queries = spark.createDataFrame(items, "item_id int, text string").selectExpr("*", "1 as id", "2 as rank")
    found = rows(ranked_search.top_documents(docs, queries))
    expected = plain(ODD, items)
    assert found == expected
    assert [r for r in found if r[0] == 1 and r[1] == 1][0][3] > 0


def test_text_ids(spark):
    docs = [("b", "fox"), ("a", "fox"), ("c", "dog fox"), ("d", "cow"), ("e", "cow")]
    found = ranked_search.top_documents(spark.createDataFrame(docs, "name string, body string"), spark.createDataFrame([("q", "fox")], "item string, words string"), 2, "name", "body", "item", "words")
    assert [(r["rank"], r["name"]) for r in found.orderBy("rank").collect()] == [(1, "a"), (2, "b")]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame([], "item_id int, text string")
    some = spark.createDataFrame([(1, "fox")], "item_id int, text string")
    assert ranked_search.top_documents(docs, some).collect() == []
    empty = ranked_search.top_documents(docs, items)
    assert empty.collect() == [] and empty.dtypes == ranked_search.top_documents(docs, some).dtypes
