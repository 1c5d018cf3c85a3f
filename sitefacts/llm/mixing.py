"""Soft-membership mixing of a corpus to target weights.

A classifier learnt from a labelled table gives every document posteriors over domains. Nonnegative rates of the
documents are fitted by distributed projected-gradient least squares, so that the expected tokens of each domain, with
each document counted by its posteriors and its rate, match the targets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefacts.llm.batches import released, text_chunks, utf8
from sitefacts.plans.scratch import staged

BINS = 2048  # hashed words
CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\n\f\r", b".,;:", b"!?", b"|", b"%$&*#@")
CLASS_OF = np.full(256, len(CLASSES), np.int32)  # class of each byte; continuation bytes begin no character
CLASS_OF[0x80:0xC0] = len(CLASSES) + 1
for number, members in enumerate(CLASSES):
    CLASS_OF[list(members)] = number
TRAINING_DOCS = 700  # bound on the sampled documents of each domain
STEPS, RATE, DECAY = 300, 0.05, 1e-4  # of the classifier's fit
MOST_ROUNDS, TOLERANCE = 40, 1e-3  # rounds of the rates' fit; share of all tokens a domain may be off


@dataclass
class Classifier:
    domains: list[str]
    weights: np.ndarray  # (features, domains), the bias last


def word_bins(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and row of each word (split at ASCII white space, ASCII lower case), and the words of each row."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = split.flatten()
    there = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))[there]
    coded = pc.dictionary_encode(flat.filter(pa.array(there)))
    bins = np.fromiter((xxhash.xxh32_intdigest(w) % BINS for w in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
    return bins[coded.indices.to_numpy()] if len(row) else np.zeros(0, np.int64), row, np.bincount(row, minlength=len(texts))


def shares(texts: pa.Array) -> np.ndarray:
    """Share of each class of characters in each text."""
    raw, offsets = utf8(texts)
    size = len(CLASSES) + 2
    place = np.repeat(np.arange(len(texts), dtype=np.int32) * size, np.diff(offsets)) + CLASS_OF[raw]
    counts = np.bincount(place, minlength=len(texts) * size).reshape(-1, size)
    return counts[:, : len(CLASSES)] / np.maximum(counts[:, :-1].sum(axis=1), 1)[:, None]


def posteriors(texts: pa.Array, model: Classifier) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of each text, and its words as tokens."""
    bins, row, words = word_bins(texts)
    score = np.zeros((len(texts), len(model.domains)))
    some = np.flatnonzero(words)
    if len(some):
        firsts = (np.cumsum(words) - words)[some]
        score[some] = np.add.reduceat(model.weights[bins], firsts, axis=0) * (10 / words[some])[:, None]
    score += shares(texts) @ model.weights[BINS:-1] + model.weights[-1]
    score = np.exp(score - score.max(axis=1, keepdims=True))
    return score / score.sum(axis=1, keepdims=True), words


def learn(features: np.ndarray, labels: np.ndarray, domains: list[str], sizes: np.ndarray) -> Classifier:
    """Multinomial logistic regression on a balanced sample, moved to the domains' true sizes.

    A domain without an example is never predicted.
    """
    x = np.hstack([features, np.ones((len(features), 1), np.float32)])
    w, m, v = (np.zeros((x.shape[1], len(domains)), np.float32) for _ in range(3))
    seen = np.bincount(labels, minlength=len(domains)) > 0
    target = np.eye(len(domains), dtype=np.float32)[labels]
    for step in range(1, STEPS + 1 if seen.sum() > 1 else 1):
        score = np.where(seen, x @ w, -1e9)
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = x.T @ (p - target) / len(x) + DECAY * w
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    if seen.any():
        drawn = np.bincount(labels, minlength=len(domains))
        w[-1, seen] += np.log(sizes[seen] / drawn[seen])
        w[-1, ~seen] = -1e4
    return Classifier(domains, w)


def fit_classifier(
    docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain",
    training_docs: int = TRAINING_DOCS,
) -> Classifier:
    """Learn the domains from the labelled table ``(id_col, domain_col)``.

    Of each domain the ``training_docs`` ids of smallest hash are taken (a documented bound; balanced). An id with
    several labels counts for the first of them in order; rows with a null, and labels other than ``domains``, are
    left out. Without examples of two domains the posteriors are those of the one seen, or equal.
    """
    known = labelled.where(F.col(id_col).isNotNull() & F.col(domain_col).isin(domains)).groupBy(F.col(id_col).alias("id")).agg(F.min(domain_col).alias("domain"))
    counts = {r["domain"]: r["count"] for r in known.groupBy("domain").count().collect()}
    drawn = known.withColumn("draw", F.xxhash64("id", F.lit("mixing sample")))
    sample: dict = {}
    for domain in domains:
        sample |= {r["id"]: domain for r in drawn.where(F.col("domain") == domain).orderBy("draw", "id").limit(training_docs).collect()}
    id_type = docs.schema[id_col].dataType.simpleString()
    wanted = docs.sparkSession.createDataFrame([(i, domains.index(d)) for i, d in sample.items()], f"id {id_type}, domain int")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(wanted), "id").select("domain", "text")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            bins, row, words = word_bins(batch.column("text"))
            counts = np.bincount(row * BINS + bins, minlength=batch.num_rows * BINS).reshape(batch.num_rows, BINS)
            found = np.hstack([10 * counts / np.maximum(words, 1)[:, None], shares(batch.column("text"))]).astype("<f4")
            yield pa.RecordBatch.from_arrays([batch.column("domain"), pa.array([f.tobytes() for f in found], pa.binary())], names=["domain", "features"])

    rows = texts.mapInArrow(released(describe), "domain int, features binary").collect()
    rows.sort(key=lambda r: (r["domain"], r["features"]))
    size = BINS + len(CLASSES)
    features = np.frombuffer(b"".join(r["features"] for r in rows), "<f4").reshape(-1, size)
    return learn(features, np.array([r["domain"] for r in rows], np.int64), domains, np.array([counts.get(d, 0) for d in domains], float))


def rates_after(p: np.ndarray, moves: list[np.ndarray]) -> np.ndarray:
    """Rates of documents with posteriors ``p``: from 1, each move is a gradient step projected on the nonnegative."""
    rate = np.ones(len(p))
    for move in moves:
        rate = np.maximum(0, rate - p @ move)
    return rate


def fit_rates(members: DataFrame, targets: np.ndarray, total: float) -> list[np.ndarray]:
    """The moves that fit the rates of ``members (tokens, p)`` to ``total * targets`` expected tokens.

    A round adds up, over all documents, the expected tokens of each domain under the rates so far; a document's rate
    follows from its posteriors and the moves, so no rate is stored. Steps are gradients scaled by the inverse of the
    domains' second moments over the documents of positive rate; a step that hardly improves the fit is replaced by
    shorter ones, then by a plain gradient step.
    """
    size = len(targets)

    def sums(moves: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found, second = np.zeros(size), np.zeros((size, size))
            for batch in batches:
                p = batch.column("p").flatten().to_numpy().reshape(-1, size)
                tokens = batch.column("tokens").to_numpy()
                rate = rates_after(p, moves)
                found += (tokens * rate) @ p
                second += (p * (tokens * (rate > 0))[:, None]).T @ p
            both = np.concatenate([found, second.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(both))), pa.array(both)], names=["i", "x"])

        rows = members.mapInArrow(add, "i bigint, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
        both = np.zeros(size + size * size)
        for r in rows:
            both[r["i"]] = r["x"]
        return both[:size] / total, both[size:].reshape(size, size) / total

    moves: list[np.ndarray] = []
    reached, second = sums(moves)
    error = reached - targets
    for _ in range(MOST_ROUNDS):
        if np.abs(error).max() <= TOLERANCE:
            break
        scaled = np.linalg.solve(second + 1e-6 * np.eye(size), error)
        plain = error / max(np.linalg.eigvalsh(second)[-1], 1e-12)
        for move in (scaled, scaled / 4, plain, plain / 4):
            new, new_second = sums([*moves, move])
            if (new - targets) @ (new - targets) < 0.995 * (error @ error):
                break
        else:
            break  # as near as nonnegative rates come
        moves, error, second = [*moves, move], new - targets, new_second
    return moves


def mix(
    docs: DataFrame, model: Classifier, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", total_tokens: float | None = None,
) -> DataFrame:
    """All columns of ``docs`` and ``tokens, posteriors, rate, copies``.

    ``rate`` is the fitted expected number of copies; ``copies`` rounds it up or down by a hash of the id, up with the
    probability of the fraction. ``targets`` name the model's domains and are scaled to add up to 1; ``total_tokens``
    is what the mixture should hold (default: as many as ``docs``). Tokens are words. A null or empty text has no
    tokens and posteriors of its own like any other. Rows that repeat an id have rates of their own and round alike;
    null ids round as one id. New columns replace those of their name. Without any token all rates are 1.
    """
    wanted = np.array([targets[d] for d in model.domains], float)
    wanted = wanted / wanted.sum()
    held = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size for each domain

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            p, tokens = posteriors(batch.column("text"), held.value)
            yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(list(p), pa.list_(pa.float64()))], names=["tokens", "p"])

    members = staged(docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(released(describe), "tokens bigint, p array<double>"), "mixing-posteriors")
    available = members.agg(F.sum("tokens")).first()[0] or 0
    moves = fit_rates(members, wanted * ((total_tokens or available) / available), available) if available else []

    plain = docs.drop("tokens", "posteriors", "rate", "copies").withColumn("__text", F.col(text_col).cast("string"))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "__text"):
            p, tokens = posteriors(batch.column("__text"), held.value)
            arrays = [c for c, n in zip(batch.columns, batch.schema.names) if n != "__text"]
            arrays += [pa.array(tokens), pa.array(list(p), pa.list_(pa.float64())), pa.array(rates_after(p, moves))]
            names = [n for n in batch.schema.names if n != "__text"] + ["tokens", "posteriors", "rate"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema if f.name != "__text"]
    rated = plain.mapInArrow(released(rate), ", ".join([*kept, "tokens bigint", "posteriors array<double>", "rate double"]))
    return rated.withColumn("copies", rounded(F.col("rate"), F.col(id_col)))


def rounded(rate: Column, by: Column) -> Column:
    draw = F.pmod(F.xxhash64(by, F.lit("mixing copies")), F.lit(1 << 40)) / float(1 << 40)
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("bigint")


def sampled(mixed: DataFrame) -> DataFrame:
    """The mixture itself: each row as often as its ``copies``, without the columns that ``mix`` adds."""
    copies = F.when(F.col("copies") > 0, F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).otherwise(F.array().cast("array<bigint>"))
    return mixed.withColumn("__copy", F.explode(copies)).drop("__copy", "tokens", "posteriors", "rate", "copies")
