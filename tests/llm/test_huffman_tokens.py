from __future__ import annotations

import heapq
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sitefacts.llm import huffman_tokens as H
from sitefacts.llm.queries import BYTE_TOKENIZER, op12_huffman_tokens

TOKENIZER = Tokenizer.from_file(BYTE_TOKENIZER)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


PARTS = [" ", "  ", "\n", "\t", " \n", "\r\n", " ", " ", "　", "\x85", "a", "Word", "'s", "12", "é", "日本", "🙂", "<|endoftext|>", "...", "İ", "\x00", " x", "ñandú"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), min_size=1, max_size=6))
def test_pieces_give_the_ids_of_whole_texts(texts):
    encoder = ENCODER
    ids, sizes = encoder(pa.array(texts))
    assert [own.tolist() for own in np.split(ids, np.cumsum(sizes)[:-1])] == [ids_of(t) for t in texts]


ENCODER = H.PieceEncoder(BYTE_TOKENIZER, 0)


def huffman_cost(counts):
    queue = [c for c in counts if c]
    heapq.heapify(queue)
    cost = 0
    while len(queue) > 1:
        both = heapq.heappop(queue) + heapq.heappop(queue)
        cost += both
        heapq.heappush(queue, both)
    return cost


def best_cost(counts, limit):
    """Least total length of a prefix code with limited lengths: ids by falling count take lengths that never shrink."""
    counts = sorted((c for c in counts if c), reverse=True)
    states = {(0, 0): 0}  # (length, share of the code space used, in units of the longest code) -> cost
    for c in counts:
        after = {}
        for (least, used), cost in states.items():
            for length in range(max(least, 1), limit + 1):
                share = used + (1 << limit - length)
                if share <= 1 << limit:
                    key = (length, share)
                    after[key] = min(after.get(key, 1 << 60), cost + c * length)
        states = after
    return min(states.values())


@pytest.mark.parametrize("seed", range(12))
def test_lengths_are_the_best_within_the_limit(seed):
    draw = random.Random(seed)
    counts = np.array([draw.choice([0, 1, 1, 2, 3, 5, 50, 1000, 10**6]) for _ in range(draw.randint(2, 14))] + [1, 4])
    for limit in (4, 5, 6):
        lengths = H.code_lengths(counts, limit)
        assert ((lengths > 0) == (counts > 0)).all() and lengths.max() <= limit
        assert sum(2.0 ** -int(n) for n in lengths if n) <= 1
        assert int((lengths * counts).sum()) == best_cost(counts.tolist(), limit)
    assert int((H.code_lengths(counts, 20) * counts).sum()) == huffman_cost(counts.tolist())


def test_limit_binds_on_skewed_counts():
    counts = np.array([1 << i for i in range(40)])
    lengths = H.code_lengths(counts, 8)
    assert lengths.max() == 8 and sum(2.0 ** -int(n) for n in lengths) <= 1
    assert H.code_lengths(np.ones(5000, np.int64), 4).max() == 13  # as short as that many ids allow


def test_codes_are_canonical_and_free_of_prefixes():
    lengths = H.code_lengths(np.array([5, 0, 9, 1, 1, 7, 3]), 20)
    codes, order = H.canonical_codes(lengths)
    written = [format(int(codes[i]), f"0{lengths[i]}b") for i in order]
    assert written == sorted(written) and [len(w) for w in written] == sorted(map(len, written))
    assert not any(b.startswith(a) for a, b in zip(written, written[1:]))


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_bits_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n) - 1, 3000).astype(np.uint32)
    lengths = H.code_lengths(np.bincount(np.append(ids, [0, 3000])), 14)
    codes, _ = H.canonical_codes(lengths)
    bits, starts = H.pack_bits(ids, codes, lengths)
    plain = "".join(format(int(codes[i]), f"0{lengths[i]}b") for i in ids.tolist())
    assert "".join(f"{b:08b}" for b in bits)[: len(plain)] == plain and len(bits) == (len(plain) + 63) // 64 * 8
    table, longest = H.decoding_table(lengths)
    assert H.unpack_bits(bits, n, starts[:: H.CHECKPOINT], table, longest).tolist() == ids.tolist()


def test_one_id_only():
    lengths = H.code_lengths(np.array([0, 0, 6]))
    codes, _ = H.canonical_codes(lengths)
    bits, starts = H.pack_bits(np.full(300, 2, np.uint32), codes, lengths)
    assert H.unpack_bits(bits, 300, starts[::128], *H.decoding_table(lengths)).tolist() == [2] * 300


def expected(docs):
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0))
    out, start = [], 0
    for i in order:
        ids = ids_of(docs[i][1])
        out.append((docs[i][0], start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


@pytest.mark.parametrize("block_tokens", [1, 50, 1 << 18])
def test_files_give_back_all_ids(spark, tmp_path, block_tokens):
    docs = [(7, "The quick brown fox."), (None, "no id"), (3, None), (2, ""), (9, "long " * 30_000), (1, "ünï  日本\n\n x"), (8, "The quick brown fox."), (-4, "<|endoftext|> a")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as row", "2 as shard", "3 as ids", "4 as start").repartition(3)
    folder = (tmp_path / "tokens").as_uri()
    H.write_tokens(df, folder, BYTE_TOKENIZER, block_tokens=block_tokens)
    found = H.read_tokens(spark, folder)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids"]
    rows = sorted(((r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) for r in found.collect()), key=lambda r: r[1])
    assert rows == expected(docs)
    blocks = spark.read.parquet(folder + "/blocks")
    assert blocks.where("size(docs) != size(lengths) or length(checkpoints) != 8 * ceil(n_tokens / 128)").count() == 0
    assert blocks.count() == (len(docs) if block_tokens == 1 else blocks.count())


def test_one_id_with_most_rows_is_spread(spark, tmp_path):
    docs = [(5, f"text {i}") for i in range(3000)] + [(6, "last"), (4, "first")]
    folder = (tmp_path / "tokens").as_uri()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        H.write_tokens(spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1), folder, BYTE_TOKENIZER)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = H.read_tokens(spark, folder).orderBy("start").collect()
    assert [(r["doc_id"], r["start"], bytes(r["ids"])) for r in found] == [(d, s, i) for d, s, _, i in expected(docs)]
    assert spark.read.parquet(folder + "/blocks").select("shard").distinct().count() > 4


def test_empty_table_and_text_ids(spark, tmp_path):
    folder = (tmp_path / "none").as_uri()
    H.write_tokens(spark.createDataFrame([], "doc_id bigint, text string"), folder, BYTE_TOKENIZER)
    found = H.read_tokens(spark, folder)
    assert found.collect() == [] and dict(found.dtypes)["start"] == "bigint"
    folder = (tmp_path / "texts").as_uri()
    H.write_tokens(spark.createDataFrame([("b", "x"), ("a", "y")], "name string, body string"), folder, BYTE_TOKENIZER, "name", "body")
    assert [r["name"] for r in H.read_tokens(spark, folder, "name").orderBy("start").collect()] == ["a", "b"]


def test_query_on_the_given_table(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted(tuple(r) for r in op12_huffman_tokens(spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert found == [(d, s, n, zlib.crc32(i)) for d, s, n, i in expected(docs)]


def test_ids_are_counted_as_they_are_written(spark):
    """One pass over the texts; counts come from a short row of each task, and no ids are read again for them."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["bread and bread", None, "Zoë's naïve café, 42 x", "bread\n"] * 5)], "id int, text string")
    rows = H.tokenized(docs.repartition(3), BYTE_TOKENIZER, H.END_ID, "<u2").cache()
    counts = H.count_ids(rows.where("used is not null").select("used", "counts"), H.END_ID)
    texts = rows.where("used is null")
    assert texts.count() == 20 and texts.where("ids is null").count() == 0 and rows.count() - 20 <= 3
    every = np.frombuffer(b"".join(r["ids"] for r in texts.collect()), "<u2")
    assert counts.tolist() == np.bincount(every, minlength=len(counts)).tolist() and counts[H.END_ID] == 20
    assert H.count_ids(rows.limit(0).select("used", "counts"), H.END_ID).tolist() == [0]
