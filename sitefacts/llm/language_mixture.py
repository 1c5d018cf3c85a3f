"""Language identification by multilingual mixture inference.

Every word of a document comes from one of several languages, each a distribution over byte trigrams. Expectation
maximisation estimates the proportions of the languages in a document; languages are dropped one by one while the
likelihood loses less than the penalty for a parameter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitefacts.llm.batches import lists, text_chunks, utf8

BITS = 16  # trigrams are hashed to 2**BITS bins
SMOOTHING = 0.5
STEPS = 8  # rounds of expectation and maximisation for each language set
PENALTY = 1.0  # times the usual half logarithm of the number of words
TRAINING_DOCS = 1000  # distinct training texts of a language; the bound of the sample
DRAWN = 1 << 30  # values of the draw
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Languages:
    names: list[str]
    weights: np.ndarray  # (bins, languages): log probability of a trigram


def word_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram bins around each letter, the place where each word starts among them, and each word's row.

    Letters are a-z after lower-casing and all bytes beyond ASCII; all else separates words.
    """
    lowered = pa.array([t.lower() for t in texts.to_pylist()], pa.string())
    raw, offsets = utf8(lowered)
    letter = (raw >= 128) | ((raw >= 97) & (raw <= 122))
    first = np.zeros(len(raw), bool)
    first[offsets[:-1][offsets[:-1] < len(raw)]] = True  # a row ends the word of the row before
    starts = letter & (first | ~np.concatenate([[False], letter[:-1]]))
    last = letter & np.concatenate([~letter[1:] | starts[1:], [True]]) if len(raw) else letter
    before = np.where(starts, 32, np.concatenate([[32], raw[:-1]])).astype(np.uint32)
    after = np.where(last, 32, np.concatenate([raw[1:], [32]])).astype(np.uint32)
    code = ((before << np.uint32(16)) | (raw.astype(np.uint32) << np.uint32(8)) | after)[letter]
    bins = (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    places = np.flatnonzero(starts)
    word_starts = (np.cumsum(letter) - 1)[places]
    return bins, word_starts, np.searchsorted(offsets, places, side="right") - 1


def training_texts(rows: DataFrame, totals: dict[str, int], training_docs: int) -> DataFrame:
    """``(lang, text)``: of each language the ``training_docs`` distinct texts of the smallest hashes, or all if fewer.

    ``rows`` has ``lang`` and ``text``, ``totals`` about how many distinct texts there are of each language. The hash
    first leaves some more than twice the bound of them, so that no task ranks more than that of a language.
    """
    drawn = rows.withColumn("hash", F.xxhash64("text", F.lit("language sample"))).withColumn("draw", F.pmod("hash", F.lit(DRAWN)))
    keep = F.lit(False)
    for name, distinct in totals.items():
        keep = keep | ((F.col("lang") == name) & (F.col("draw") < DRAWN * (2 * training_docs + 100) / max(distinct, 1)))
    ranked = Window.partitionBy("lang").orderBy("draw", "hash")
    once = drawn.where(keep).dropDuplicates(["lang", "hash"])
    return once.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= training_docs).select("lang", "text")


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", training_docs: int = TRAINING_DOCS) -> Languages:
    """Trigram counts of the languages of labelled documents.

    Each language is learnt from ``training_docs`` distinct texts, drawn by a hash of the text (all, if it has fewer);
    copies of a text count once. Counts are added up in Spark; the driver gets at most 2**BITS numbers for each
    language. Rows without text or language teach nothing.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).dropna()
    totals = dict(rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text"))).collect())
    names = sorted(totals)
    if not names:
        return Languages([], np.zeros((1 << BITS, 0), np.float32))
    sample = training_texts(rows, totals, training_docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(names), 1 << BITS), np.int64)
        for batch in text_chunks(batches):
            bins, starts, rows_of = word_grams(batch.column("text"))
            sizes = np.diff(np.append(starts, len(bins)))
            index = np.array([names.index(v) for v in batch.column("lang").to_pylist()])
            flat = np.repeat(index[rows_of], sizes) * (1 << BITS) + bins
            sums += np.bincount(flat, minlength=sums.size).reshape(sums.shape)
        lang, bin_of = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(bin_of), pa.array(sums[lang, bin_of])], names=["lang", "bin", "n"])

    counted = sample.mapInArrow(count, "lang bigint, bin bigint, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    sums = np.zeros((1 << BITS, len(names)))
    for part in counted.toArrow().to_batches():
        lang, bin_of, n = (part.column(i).to_numpy() for i in range(3))
        sums[bin_of, lang] = n
    # bins no language has count as unseen everywhere, and tell nothing
    share = (sums + SMOOTHING) / (sums.sum(axis=0) + SMOOTHING * max(1, np.count_nonzero(sums.sum(axis=1))))
    return Languages(names, np.log(share).astype(np.float32))


def expect(likelihood: np.ndarray, doc: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, share: np.ndarray, peak: np.ndarray, steps: int):
    """Proportions after some rounds from ``share`` (0 stays 0), and the log likelihood of each document."""
    for _ in range(steps):
        joint = likelihood * share[doc]
        total = np.maximum(joint.sum(axis=1), 1e-30)
        joint /= total[:, None]
        share = np.add.reduceat(joint, firsts, axis=0) / sizes[:, None]
    total = np.maximum((likelihood * share[doc]).sum(axis=1), 1e-30)
    return share, np.add.reduceat(np.log(total) + peak, firsts)


def mixtures(texts: pa.Array, model: Languages, penalty: float = PENALTY, steps: int = STEPS) -> np.ndarray:
    """Proportions of the languages in each text; all zero where a text has no word."""
    n_langs = len(model.names)
    out = np.zeros((len(texts), n_langs))
    bins, starts, rows_of = word_grams(texts)
    if not len(bins) or not n_langs:
        return out
    scores = np.add.reduceat(model.weights[bins], starts, axis=0)
    peak = scores.max(axis=1)
    likelihood = np.exp(scores - peak[:, None])
    docs, firsts, sizes = np.unique(rows_of, return_index=True, return_counts=True)
    doc = np.repeat(np.arange(len(docs)), sizes)
    share, fitness = expect(likelihood, doc, firsts, sizes, np.full((len(docs), n_langs), 1 / n_langs, np.float32), peak, steps)
    active = np.arange(len(docs))
    for _ in range(n_langs - 1):
        smallest = np.where(share[active] > 0, share[active], 2).argmin(axis=1)
        less = share[active].copy()
        less[np.arange(len(active)), smallest] = 0
        less = np.where(less > 0, np.maximum(less, 1e-6), 0).astype(np.float32)
        left = less.sum(axis=1)
        open_ = left > 0
        active, less = active[open_], (less / np.maximum(left, 1e-30)[:, None])[open_]
        if not len(active):
            break
        where = np.zeros(len(docs), np.int64)
        where[active] = np.arange(len(active))
        words = np.isin(doc, active) if len(active) < len(docs) else np.ones(len(doc), bool)
        own_sizes = sizes[active]
        own_firsts = np.cumsum(own_sizes) - own_sizes
        tried, value = expect(likelihood[words], where[doc[words]], own_firsts, own_sizes, less, peak[words], steps)
        better = value - fitness[active] >= -0.5 * penalty * np.log(np.maximum(own_sizes, 2))
        share[active[better]], fitness[active[better]] = tried[better], value[better]
        active = active[better]
        if not len(active):
            break
    out[docs] = share
    return out


def identify(docs: DataFrame, model: Languages, id_col: str = "doc_id", text_col: str = "text", penalty: float = PENALTY) -> DataFrame:
    """``id_col, lang_pred, score, languages, shares`` for every document.

    ``languages`` is the selected set with its ``shares``, largest first; ``lang_pred`` is the first of them and
    ``score`` its share. A text that is null or has no letter is ``und`` with score 0 and an empty set, as is every
    text if the model knows no language. Only the text is read. Ids may be null or repeated; each row gives one row.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)  # 2**BITS floats for each language

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in text_chunks(batches, limit=1 << 20):
            shares = mixtures(batch.column("text"), known, penalty)
            has_letter = np.array([LETTER.search(t) is not None for t in batch.column("text").to_pylist()])
            found = has_letter & (shares.sum(axis=1) > 0)
            if known.names:
                order = np.argsort(-shares, axis=1, kind="stable")
                ranked = np.take_along_axis(shares, order, axis=1)
            else:
                order, ranked = np.zeros((batch.num_rows, 0), np.int64), np.zeros((batch.num_rows, 0))
            used = (ranked > 0) & found[:, None]
            names = np.array(known.names, object)
            top = [names[o[0]] if f else UNKNOWN for o, f in zip(order, found)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(top, pa.string()),
                    pa.array(np.where(found, ranked[:, 0] if known.names else 0.0, 0.0).clip(0, 1)),
                    lists(pa.array(names[order[used]], pa.string()), used.sum(axis=1)),
                    lists(pa.array(ranked[used]), used.sum(axis=1)),
                ],
                names=["id", "lang_pred", "score", "languages", "shares"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        score, f"id {id_type}, lang_pred string, score double, languages array<string>, shares array<double>"
    )
    return found.withColumnRenamed("id", id_col)
