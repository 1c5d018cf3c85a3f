from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from sitefacts.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(doc)
    out = []
    for norm, docs in groups.items():
        docs.sort(key=lambda d: (d is None, d))
        digest = hashlib.sha256(norm.encode()).hexdigest()
        out += [(d, docs[0], len(docs), i == 0, digest) for i, d in enumerate(docs)]
    return out


def key(row):
    return tuple((v is None, v) for v in row)


def check(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id bigint, text string, h string, entry int")
    found = [tuple(r) for r in exact_dedup.exact_groups(docs.repartition(5), **options).collect()]
    assert sorted(found, key=key) == sorted(brute(rows), key=key)


def test_against_brute_force(spark):
    random.seed(1)
    rows = [(i, random.choice([None, "", " ", "a  b", "a\tb", "a b", "a b", "é", f"t{i % 40}", "hot " * 50])) for i in range(600)]
    rows += [(3, "a b"), (3, "a b"), (None, "hot " * 50), (None, "only null"), (None, "only null"), (700, "long " * 40_000)]
    check(spark, rows)
    check(spark, rows, bucket_bytes=64, max_depth=6)


def test_equal_keys_are_told_apart_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(F, "xxhash64", lambda *_: F.lit(7).cast("bigint"))
    check(spark, [(i, f"text {i % 9}") for i in range(60)])


def test_small_merges(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MERGE_BYTES", 300)
    check(spark, [(i, f"text {i % 9}") for i in range(200)])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert exact_dedup.exact_groups(docs).count() == 0


def test_directory_doubles_until_buckets_fit():
    sizes = np.array([9, 0, 0, 0, 1, 1, 5, 5])
    places = exact_dedup.split_directory(sizes, 6)
    assert len(places) == 8 and places == sorted(places)
    loads = defaultdict(int)
    for place, bucket in enumerate(places):
        loads[bucket] += sizes[place]
    assert loads == {0: 9, 1: 0, 2: 0, 3: 2, 4: 5, 5: 5}
    assert exact_dedup.split_directory(sizes, 100) == [0]
