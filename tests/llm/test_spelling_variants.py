from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sitefacts.llm import spelling_variants as V
from sitefacts.llm.queries import op13_spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_words(doc, text, thinned=31):
    for run in RUN.findall(text or ""):
        run = re.sub("[A-Z]+", lambda m: m[0].lower(), run)
        h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
        yield run[: h % len(run)] + run[h % len(run) + 1 :] if h % thinned == 0 else run


def near(a, b):
    """Whether one inserted, deleted or replaced character makes the words equal."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(docs, least_length=7, least_count=2, factor=10, thinned=31):
    counts = Counter(w for doc, text in docs for w in plain_words(doc, text, thinned))
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    forms, sizes = {}, {}
    for w in words:
        own = [v for v in words if abs(len(v) - len(w)) <= 1 and near(v, w)]
        best = min(own, key=lambda v: (-words[v], v), default=None)
        sizes[w] = len(own)
        forms[w] = best if best and words[best] >= factor * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, sizes[w], words[forms[w]] if forms[w] else None))
    return sorted(out)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def rows(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 10**12)), st.text("aZzÀÿ×÷é 1.日\n", max_size=40)), min_size=1, max_size=8), st.sampled_from([1, 2, 31]))
def test_words_equal_a_plain_reading(docs, thinned):
    found = V.words_of(pa.array([None if d is None else str(d) for d, _ in docs], pa.string()), pa.array([t for _, t in docs]), thinned)
    assert found.to_pylist() == [w for d, t in docs for w in plain_words(d, t, thinned)]


def test_checksums_equal_the_library():
    texts = [b"", b"a", b"some longer text", bytes(range(256))]
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    found = V.checksums(np.full(4, 0xFFFFFFFF, np.uint32), data, np.cumsum(sizes) - sizes, sizes) ^ np.uint32(0xFFFFFFFF)
    assert found.tolist() == [zlib.crc32(t) for t in texts]


@pytest.mark.parametrize("seed", range(4))
def test_equals_comparing_all_words(spark, seed):
    """Words over few letters, so that runs of equal letters, chains and large groups occur."""
    draw = random.Random(seed)
    alphabet = "ab" if seed % 2 else "abcé"
    words = {"".join(draw.choices(alphabet, k=draw.randint(3, 6))): draw.choice([1, 2, 3, 25, 300]) for _ in range(90)}
    words |= {w: n for w, n in zip(("aaaa", "aaaaa", "aaaaaa", "abab", "ababa"), (2, 30, 400, 5000, 3))}
    bag = [w for w, n in words.items() for _ in range(n)]
    draw.shuffle(bag)
    docs = [(i, " ".join(bag[i::40])) for i in range(40)]
    found = V.variant_groups(spark.createDataFrame(docs, "doc_id bigint, text string"), least_length=4)
    assert rows(found) == plain(docs, least_length=4)


def test_forms_are_followed_to_the_last(spark):
    docs = [(None, " ".join(["colours"] * 2 + ["colourse"] * 20 + ["colourses"] * 200 + ["colourxes"] * 2000 + ["colourxe"] * 2000))]
    found = {r[0]: r for r in rows(V.variant_groups(spark.createDataFrame(docs, "doc_id bigint, text string"), thinned=1 << 40))}
    assert found["colours"] == ("colours", "colourse", "colourxe", 2, 1, 20)
    assert found["colourse"] == ("colourse", "colourxe", "colourxe", 20, 3, 2000)
    assert found["colourses"][1:3] == ("colourxes", "colourxes")


def test_ties_go_to_the_first_spelling(spark):
    docs = [(1, " ".join(["bananas"] * 2 + ["bananaz"] * 30 + ["bananàs"] * 30 + ["banánas"] * 30))]
    found = {r[0]: r for r in rows(V.variant_groups(spark.createDataFrame(docs, "doc_id bigint, text string"), thinned=1 << 40))}
    assert found["bananas"][1:] == ("bananaz", "bananaz", 2, 3, 30)
    assert found["bananaz"][1:] == (None, "bananaz", 30, 1, None)


def test_odd_texts(spark):
    docs = [
        (None, "Bananas bananas"), (1, None), (2, ""), (3, "12 ., 日本"), (4, "bananas " * 40_000 + "bananos bananos"), (5, "y" * 120_000 + " " + "y" * 120_000), (6, "ÀÉÎÕÜßÿ àéîõüßÿ ÀÉÎÕÜßÿ"), (6, "ÀÉÎÕÜßÿ àéîõüßÿ ÀÉÎÕÜßÿ"),
    ]
    df = spark.createDataFrame(docs, "doc_id int, text string").selectExpr("*", "'x' as word", "1 as n", "2 as w", "3 as form", "4 as id")
    short = [d for d in docs if d[0] != 5]
    found = [r for r in rows(V.variant_groups(df.where("doc_id is null or doc_id != 5"))) if len(r[0]) < 1000]
    assert found == plain(short)
    assert V.variant_groups(df.limit(0)).collect() == []


def test_query_on_the_given_table(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    counts = Counter(w for doc, text in docs for w in plain_words(doc, text))
    found = {r[0]: r for r in rows(op13_spelling_variants(spark, sf))}
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    assert {w: r[3] for w, r in found.items()} == words
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for w in sorted(words)[::40]:  # against all words
        own = [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, ()) if near(v, w)]
        best = min(own, key=lambda v: (-words[v], v), default=None)
        form = best if best and words[best] >= 10 * words[w] else None
        assert (found[w][1], found[w][4], found[w][5]) == (form, len(own), words[form] if form else None)
