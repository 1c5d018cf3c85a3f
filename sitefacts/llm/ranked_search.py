"""Ranked lexical search over documents by best-first intervals with range-maximum bounds.

A block of documents has one posting list per term, and over each list a sparse table that answers which posting of a
range has the greatest impact. The answers of an item's terms, added up, bound the score of every document of an
interval. Intervals are taken best first and split at their document of greatest impact, which is scored exactly, until
no bound reaches the item's k-th best score; short intervals are scored whole. Blocks lie within a task and pass the
k-th score on to the next; Spark merges the best documents of all tasks.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitefacts.llm.batches import lists, text_chunks, utf8
from sitefacts.plans.scratch import staged

RANKS = 10
BLOCK_POSTINGS = 1 << 20  # of one block, or those of one document: bounds the tables of a task to some 60 MB
SHORT_INTERVAL = 256  # documents scored without a further split
AT_ONCE = 16  # intervals taken from the queue together
TERMS_AT_ONCE = 500_000  # terms of the items that are searched in one pass over the documents

# Terms are runs of ASCII letters, digits and everything beyond ASCII; only A-Z are lower-cased.
IN_TERM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts in order, and how many each text has."""
    data, offsets = utf8(texts)
    inside = IN_TERM[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]  # terms end with their text
    starts[borders] = inside[borders]
    ends[borders - 1] = inside[borders - 1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends)
    places = np.concatenate([[0], np.cumsum(last + 1 - first)]).astype(np.int32)
    found = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(places), pa.py_buffer(LOWER[data[inside]])])
    return found, np.diff(np.searchsorted(first, offsets))


def counted(batch: pa.RecordBatch, vocabulary: pa.Array) -> pa.RecordBatch:
    """``id, n, terms, tfs`` of the texts with a term; ``terms`` are the numbers of those in the vocabulary."""
    terms, n = terms_of(batch.column("text"))
    numbers = pc.fill_null(pc.index_in(terms, vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(n)), n)
    known = numbers >= 0
    pairs, tfs = np.unique(rows[known] * len(vocabulary) + numbers[known], return_counts=True)
    width = max(1, len(vocabulary))
    held = n > 0
    sizes = np.bincount(pairs // width, minlength=len(n))[held]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("id").filter(pa.array(held)), pa.array(n[held]),
            lists(pa.array((pairs % width).astype(np.int32)), sizes), lists(pa.array(tfs.astype(np.int64)), sizes),
        ],
        names=["id", "n", "terms", "tfs"],
    )


class Best:
    """The k best documents of an item so far, equal scores by ascending id (null first)."""

    def __init__(self, k: int):
        self.k, self.floor, self.found = k, 1, []

    def offer(self, scores: np.ndarray, ordinals: np.ndarray, ids: pa.Array) -> None:
        good = np.flatnonzero(scores >= self.floor)
        if not len(good):
            return
        good = good[np.lexsort((ordinals[good], -scores[good]))[: self.k]]
        new = []
        for score, ordinal in zip(scores[good].tolist(), ordinals[good].tolist()):
            doc = ids[ordinal].as_py()
            new.append((-score, doc is not None, doc))
        self.found = heapq.nsmallest(self.k, self.found + new, key=lambda f: f if f[1] else f[:2])
        if len(self.found) == self.k:
            self.floor = -self.found[-1][0]


class Block:
    """Posting lists of a block of documents, which are numbered in the order of their ids."""

    def __init__(self, ids: pa.Array, m: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray):
        order = pc.sort_indices(ids, null_placement="at_start").to_numpy()
        self.ids, self.docs = ids.take(pa.array(order)), len(ids)
        ordinal = np.empty(len(ids), np.int64)
        ordinal[order] = np.arange(len(ids))
        owner = np.repeat(np.arange(len(ids)), sizes)
        keys = terms.astype(np.int64) * self.docs + ordinal[owner]  # by term, then document
        by_key = np.argsort(keys, kind="stable")
        self.keys = keys[by_key]
        self.doc = self.keys % self.docs
        self.impact = ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m[owner]))[by_key]
        self.peaks = self.sparse_table(np.bincount(terms).max(initial=1))

    def sparse_table(self, longest: int) -> np.ndarray:
        """Row j holds for each posting the one of greatest impact among the 2**j from there on."""
        levels = [np.arange(len(self.keys), dtype=np.int32)]
        for j in range(int(longest).bit_length() - 1):
            last, half = levels[-1], 1 << j
            left, right = last[:-half], last[half:]
            level = last.copy()
            level[:-half] = np.where(self.impact[right] > self.impact[left], right, left)
            levels.append(level)
        return np.stack(levels)

    def peak(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The posting of greatest impact of each range, and its impact, which is 0 for an empty range."""
        size = np.maximum(b - a, 1)
        level = np.frexp(size)[1] - 1
        last = len(self.keys) - 1
        left, right = self.peaks[level, np.minimum(a, last)], self.peaks[level, np.minimum(np.maximum(b - (1 << level), 0), last)]
        at = np.where(self.impact[right] > self.impact[left], right, left)
        return at, np.where(b > a, self.impact[at], 0)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Offer ``best`` every document of the block that can be among the k best."""
        a, b = np.searchsorted(self.keys, terms * self.docs), np.searchsorted(self.keys, (terms + 1) * self.docs)
        held = (b > a) & (weights > 0)
        if not held.any():
            return
        terms, weights, queue = terms[held], weights[held], []
        bases = terms * self.docs

        def push(low: np.ndarray, high: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
            at, impact = self.peak(a, b)
            shares = impact * weights
            bounds = shares.sum(axis=1)
            split = self.doc[at[np.arange(len(at)), shares.argmax(axis=1)]]
            for i in np.flatnonzero((bounds >= best.floor) & (high > low)).tolist():
                heapq.heappush(queue, (-int(bounds[i]), int(low[i]), int(high[i]), int(split[i]), a[i], b[i]))

        push(np.array([0]), np.array([self.docs]), a[held][None], b[held][None])
        while queue and -queue[0][0] >= best.floor:
            short, long = [], []
            while queue and -queue[0][0] >= best.floor and len(short) + len(long) < AT_ONCE:
                taken = heapq.heappop(queue)
                (short if taken[2] - taken[1] <= SHORT_INTERVAL else long).append(taken)
            if short:
                self.resolve(np.array([s[4] for s in short]), np.array([s[5] for s in short]), weights, best)
            if long:
                low, high, split = (np.array([s[i] for s in long]) for i in (1, 2, 3))
                a, b = np.array([s[4] for s in long]), np.array([s[5] for s in long])
                wanted = bases + split[:, None]
                x = np.searchsorted(self.keys, wanted)
                hit = self.keys[np.minimum(x, len(self.keys) - 1)] == wanted
                scores = np.where(hit, self.impact[np.minimum(x, len(self.keys) - 1)] * weights, 0).sum(axis=1)
                best.offer(scores, split, self.ids)
                push(np.concatenate([low, split + 1]), np.concatenate([split, high]), np.concatenate([a, x + hit]), np.concatenate([x, b]))

    def resolve(self, a: np.ndarray, b: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Score all documents of some intervals from their postings ``[a, b)`` in each list."""
        sizes = (b - a).ravel()
        starts = np.cumsum(sizes) - sizes
        at = np.repeat(a.ravel() - starts, sizes) + np.arange(int(sizes.sum()))
        of = np.repeat(np.broadcast_to(weights, a.shape).ravel(), sizes)
        docs, place = np.unique(self.doc[at], return_inverse=True)
        scores = np.zeros(len(docs), np.int64)
        np.add.at(scores, place, self.impact[at] * of)
        best.offer(scores, docs, self.ids)


def item_blocks(items: DataFrame, limit: int) -> Iterator[tuple[list, list[list[str]]]]:
    """Item ids and their distinct terms, in blocks of about ``limit`` terms, one partition of items at a time."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            terms, n = terms_of(batch.column("text"))
            found = [sorted(set(part.to_pylist())) for part in (terms.slice(e - c, c) for e, c in zip(np.cumsum(n).tolist(), n.tolist()))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.list_(pa.string()))], names=["id", "terms"])

    kind = items.schema["id"].dataType.simpleString()
    ids, terms, held = [], [], 0
    for row in items.mapInArrow(distinct, f"id {kind}, terms array<string>").toLocalIterator():
        ids.append(row["id"])
        terms.append(row["terms"])
        held += len(row["terms"]) + 1
        if held >= limit:
            yield ids, terms
            ids, terms, held = [], [], 0
    if ids:
        yield ids, terms


def ranked(texts: DataFrame, ids: list, terms: list[list[str]], item_kind: str, k: int, block_postings: int) -> DataFrame:
    """``item, item_id, id, score``: the best documents of each task, for one block of items."""
    spark, kind = texts.sparkSession, texts.schema["id"].dataType.simpleString()
    words = sorted({t for own in terms for t in own})
    number = {t: i for i, t in enumerate(words)}
    vocabulary = spark.sparkContext.broadcast(words)  # no more than TERMS_AT_ONCE and one item's terms

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary.value, pa.string())
        for batch in text_chunks(batches):
            yield counted(batch, known)

    held = staged(texts.mapInArrow(count, f"id {kind}, n bigint, terms array<int>, tfs array<bigint>"), "search-terms")
    total = held.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(len(words), np.int64)
    for row in held.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row for a term of the items
        df[row["term"]] = row["count"]
    weights = np.array([math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * int(n) + 1))) for n in df], np.int64)
    sizes = [len(own) for own in terms]
    flat = np.array([number[t] for own in terms for t in own], np.int64)
    plan = spark.sparkContext.broadcast((ids, flat, np.cumsum([0, *sizes]), weights, total["docs"], total["terms"]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, flat, ends, weights, n_docs, n_terms = plan.value
        best = [Best(k) for _ in item_ids]
        for docs in postings_blocks(batches, block_postings):
            lengths, back = np.unique(docs.column("n").to_numpy(zero_copy_only=False), return_inverse=True)
            m = np.array([10 + 90 * n * n_docs // n_terms for n in lengths.tolist()], np.int64)[back]
            sizes = pc.list_value_length(docs.column("terms")).to_numpy(zero_copy_only=False).astype(np.int64)
            own = docs.column("terms").flatten().to_numpy(zero_copy_only=False), docs.column("tfs").flatten().to_numpy(zero_copy_only=False)
            if not len(own[0]):
                continue
            block = Block(docs.column("id"), m, sizes, *own)
            for i, mine in enumerate(best):
                numbers = flat[ends[i] : ends[i + 1]]
                block.search(numbers, weights[numbers], mine)
        rows = [(i, doc, -score) for i, mine in enumerate(best) for score, _, doc in mine.found]
        of = [r[0] for r in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array(of, pa.int64()), pa.array([item_ids[i] for i in of], ITEM), pa.array([r[1] for r in rows], DOC), pa.array([r[2] for r in rows], pa.int64())],
            names=["item", "item_id", "id", "score"],
        )

    from pyspark.sql.pandas.types import to_arrow_type

    schema = spark.createDataFrame([], f"item_id {item_kind}, id {kind}").schema
    ITEM, DOC = (to_arrow_type(f.dataType) for f in schema)
    return held.mapInArrow(search, f"item bigint, item_id {item_kind}, id {kind}, score bigint")


def postings_blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The rows of a task in blocks of about ``limit`` postings."""
    parts, held = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit - held, side="right")))
            parts.append(batch.slice(at, to - at))
            held += int(ends[to - 1]) - base
            at = to
            if held >= limit or at < batch.num_rows:
                yield merged(parts)
                parts, held = [], 0
    if parts:
        yield merged(parts)


def merged(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.concat_arrays([p.column(c) for p in parts]) for c in parts[0].schema.names], names=parts[0].schema.names)


def top_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = RANKS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_postings: int = BLOCK_POSTINGS,
    terms_at_once: int = TERMS_AT_ONCE,
) -> DataFrame:
    """``item_col, rank, id_col, score``: the ``k`` documents of highest score above 0 for each row of ``items``.

    With N documents that hold a term, L terms in all of them, n in one, a term held by df documents weighs
    ``w = floor(1000 ln((2N + 2) / (2 df + 1)))``; a document that holds it tf times adds
    ``w * (10**9 tf div (1000 tf + 8 (10 + 90 n N div L)))`` once, however often the item has the term. Equal scores
    go by ascending id, null ids first. Null and empty texts have no terms: such documents do not count and such items
    get no rows. Repeated rows are documents, or items, of their own. No other column is read.

    Documents are cut into terms once for each ``terms_at_once`` terms of items; a task holds a few megabytes of text,
    or one block of ``block_postings`` postings of those terms, or one document.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    wanted = items.select(F.col(item_col).alias("id"), F.col(item_text_col).cast("string").alias("text"))
    item_kind = items.schema[item_col].dataType.simpleString()
    out = None
    for number, (ids, terms) in enumerate(item_blocks(wanted, terms_at_once)):
        part = ranked(texts, ids, terms, item_kind, k, block_postings).withColumn("block", F.lit(number))
        out = part if out is None else out.unionByName(part)
    if out is None:
        empty = docs.sparkSession.createDataFrame([], f"item_id {item_kind}, rank int, id {docs.schema[id_col].dataType.simpleString()}, score bigint")
        return empty.toDF(item_col, "rank", id_col, "score")
    order = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc("id"))
    best = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select(F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")
