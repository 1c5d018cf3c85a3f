from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sitefacts.llm import packing

FILE = public_tokenizers.path("word_bpe_49k.json")


def pieces_of(spark, texts, **options):
    rows = [(i, t, "x", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, length string, ids bigint")
    return packing.decompose(docs, FILE, **options).collect()


def test_ids_round_trip(spark):
    random.seed(3)
    odd = ["é", "ß", "́", " ", " ", " ", "\n", "\t", "'s", "<|endoftext|>", "I", "İ", "Σ", "a", "B", "9", "!", "漢", "\U0001f600", "the", ",", "...", "É", "Ÿ", "ÿ", "ª", "µ", "×"]
    texts = [None, "", "  \n", "one", "don't STOP now", "word " * 5000]
    texts += ["".join(random.choices(odd, k=random.randint(1, 60))) for _ in range(300)]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    tokenizer = Tokenizer.from_file(FILE)
    found: dict[int, list] = {}
    for p in pieces_of(spark, texts):
        found.setdefault(p["doc_id"], []).append(p)
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        expected = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        pieces = sorted(found[i], key=lambda p: p["start"])
        assert [p["start"] for p in pieces] == list(np.cumsum([0] + [p["length"] for p in pieces])[:-1])
        assert np.frombuffer(b"".join(p["ids"] for p in pieces), "<u4").tolist() == expected
        assert {p["doc_tokens"] for p in pieces} == {len(expected)}
        assert all(p["length"] & (p["length"] - 1) == 0 and p["length"] <= 2048 for p in pieces)
        lengths = [p["length"] for p in pieces if p["length"] < 2048]
        assert len(set(lengths)) == len(lengths)  # at most one piece for each binary digit


def test_sequences_are_unique_and_short_caches_change_nothing(spark, monkeypatch):
    texts = [f"alpha beta w{i} gamma{i % 7}" for i in range(500)]
    whole = pieces_of(spark, texts, sequence_tokens=4)
    assert len({p["sequence_id"] for p in whole}) == len(whole)
    monkeypatch.setattr(packing, "CACHED_PARTS", 3)
    encoder = packing.WordEncoder(FILE, 1)
    import pyarrow as pa

    ids = np.concatenate([encoder(pa.array(texts[i : i + 5]))[0] for i in range(0, 500, 5)])
    in_order = sorted(whole, key=lambda p: (p["doc_id"], p["start"]))
    assert ids.tolist() == np.frombuffer(b"".join(p["ids"] for p in in_order), "<u4").tolist()


def test_words_are_told_apart_many_at_once():
    """Each distinct part of words is looked up once, not twice for each word."""
    import pyarrow as pa

    class Counted(dict):
        asked = 0

        def __contains__(self, part):
            Counted.asked += 1
            return super().__contains__(part)

    encoder = packing.WordEncoder(FILE, 1)
    encoder.known = Counted(encoder.known)
    text = " ".join(f"{head}{'!' * n}" for head in ("Ärger", "two", "ÀB", "x×y", "3d") for n in range(50))
    ids, sizes = encoder(pa.array([text]))
    assert ids.tolist() == Tokenizer.from_file(FILE).encode(text, add_special_tokens=False).ids + [1] and sizes.tolist() == [len(ids)]
    assert Counted.asked <= 3 + 50 + 2 * 50


def test_repeated_rows_empty_tables_and_lists(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id bigint, text string")
    found = packing.token_lists(packing.decompose(docs, FILE))
    rows = found.collect()
    assert sum(r["doc_id"] is None for r in rows) == 1 and all(len(r["ids"]) == r["length"] for r in rows)
    assert packing.decompose(docs.limit(0), FILE).count() == 0
    with pytest.raises(ValueError):
        packing.decompose(docs, FILE, sequence_tokens=1000)


def test_buckets_hold_equal_lengths(spark, tmp_path):
    """Written by length, every file holds sequences of one length, and together they hold all ids."""
    docs = spark.createDataFrame([(i, f"word{i} " * (i % 90)) for i in range(200)], "doc_id bigint, text string")
    pieces = packing.token_lists(packing.decompose(docs, FILE, sequence_tokens=64))
    packing.write_buckets(pieces, str(tmp_path / "buckets"))
    back = spark.read.parquet(str(tmp_path / "buckets"))
    assert sorted(map(tuple, back.select("doc_id", "start", "length", "ids").collect())) == sorted(map(tuple, pieces.select("doc_id", "start", "length", "ids").collect()))
    folders = {f.name: f for f in (tmp_path / "buckets").glob("length=*")}
    assert set(folders) == {f"length={1 << k}" for k in range(7)}
    for name, folder in folders.items():
        assert {len(r["ids"]) for r in spark.read.parquet(str(folder)).collect()} == {int(name[7:])}


def test_pieces_with_lists_are_those_of_the_bytes(spark):
    """In one pass: a second one would start a second worker for each task."""
    docs = spark.createDataFrame([(1, "a quiet day by the sea"), (2, None), (None, ""), (2, "bread " * 300)], "doc_id int, text string").coalesce(1)
    found = packing.decompose(docs, FILE, sequence_tokens=64, as_lists=True)
    expected = packing.token_lists(packing.decompose(docs, FILE, sequence_tokens=64))
    assert found.dtypes == expected.dtypes and found.collect() == expected.collect()
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
