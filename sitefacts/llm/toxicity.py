"""Toxicity scores by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word is the sum of an embedding of the word and the mean of embeddings of its character n-grams (with the word's
edges marked). Two gated recurrent layers read a window of words in both directions; attention pools their states, and
a logistic unit scores the window. A text is scored by its worst window; windows overlap and cover the whole text.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitefacts.llm.batches import ragged, release, released, text_chunks, unused
from sitefacts.plans.scratch import staged

WINDOW, STRIDE = 64, 48  # words; neighbours share 16
GRAM, BEGINNINGS = 4, (5, 6, 7, 8)  # characters
LEAST_DOCS, LEAST_SHARE = 3, 0.006  # training documents that must hold a feature, so that none is learnt by heart
KNOWN_WORDS = 100_000  # words a task keeps the features of; it starts anew beyond
WORDS_AT_ONCE = 2048  # words whose features are added up together
EMBEDDING, HIDDEN, ATTENTION = 12, 8, 6
TRAINING_DOCS, TRAINING_WORDS = 2000, 600_000  # bounds on the sampled documents of each label, and on their words
TRAINING_SHARE = 3  # one label's training words are at most so many times the other's
EPOCHS, BATCH, RATE, DECAY = 6, 64, 0.01, 0.1
THRESHOLD = 0.7
SLICE = 512  # windows scored together
WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)*")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def window_starts(n: int) -> range:
    """Starts of the windows over n words: one for a short text, and none past the first that reaches the end."""
    return range(0, max(1, n - (WINDOW - STRIDE)), STRIDE)


def features(word: str) -> list[str]:
    """The word, its character n-grams, and how it begins. Edges are marked; a space tells the word from the rest."""
    edged = f"<{word}>"
    return [" " + word, *{*(edged[i : i + GRAM] for i in range(max(1, len(edged) - GRAM + 1))), *(edged[:n] for n in BEGINNINGS)}]


ODD = np.uint64(0x9E3779B97F4A7C15)
PIECES_AT_ONCE = 16_384  # words whose pieces are looked up together


def text_hashes(codes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the ``length`` characters from each of the places ``starts`` on."""
    h = np.full(len(starts), length, np.uint64)
    for j in range(length):
        h = (h ^ codes[starts + j]) * ODD
        h ^= h >> np.uint64(29)
    return h


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)


class Features:
    """Places in the embedding table of the features of distinct words. Word 0 is padding and has none."""

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.places, self.weights, self.sizes = array("q"), array("f"), array("q", [0])
        self.known: dict[str, int] = {}
        self.waiting: list[str] = []

    def later(self, word: str) -> int:
        """The number of a word that has none yet; ``look_up`` finds its features, many words at a time."""
        found = self.known[word] = len(self.sizes) + len(self.waiting)
        self.waiting.append(word)
        return found

    def look_up(self) -> None:
        """The features of the words that wait, as ``number`` finds them but for the order of a word's pieces."""
        words, self.waiting = self.waiting, []
        for low in range(0, len(words), PIECES_AT_ONCE):
            self.add(words[low : low + PIECES_AT_ONCE])

    @cached_property
    def pieces(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the vocabulary's pieces of words, in order, and their places."""
        by_length: dict[int, list[str]] = {}
        for name in self.vocabulary:
            if not name.startswith(" "):
                by_length.setdefault(len(name), []).append(name)
        hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for length, names in by_length.items():
            hashes.append(text_hashes(code_points("".join(names)), np.arange(len(names)) * length, length))
            places.append(np.array([self.vocabulary[name] for name in names], np.int64))
        hashes, places = np.concatenate(hashes), np.concatenate(places)
        order = np.argsort(hashes)
        return hashes[order], places[order]

    def add(self, words: list[str]) -> None:
        n = np.fromiter(map(len, words), np.int64, len(words)) + 2
        codes = code_points("<" + "><".join(words) + ">")
        starts, owner = np.cumsum(n) - n, np.repeat(np.arange(len(words)), n)
        keys, owners = [], []
        for length in range(1, max(BEGINNINGS) + 1):
            if length == GRAM:
                at = np.flatnonzero(np.arange(len(codes)) + length <= (starts + n)[owner])
            else:  # beginnings, the last of which is the word itself if it is shorter
                at = starts[n >= length if length in BEGINNINGS else n == length]
            keys.append(text_hashes(codes, at, length))
            owners.append(owner[at])
        keys, owner = np.concatenate(keys), np.concatenate(owners)
        once = np.unique((keys ^ (owner.astype(np.uint64) * ODD)) * ODD, return_index=True)[1]  # a piece counts once in its word
        keys, owner = keys[once], owner[once]
        share = (1 / np.bincount(owner, minlength=len(words))).astype(np.float32)
        hashes, places = self.pieces
        at = np.minimum(np.searchsorted(hashes, keys), max(0, len(hashes) - 1))
        there = hashes[at] == keys if len(hashes) else np.zeros(len(keys), bool)
        whole = np.array([self.vocabulary.get(" " + w, -1) for w in words], np.int64)
        named = np.flatnonzero(whole >= 0)
        owner = np.concatenate([named, owner[there]])
        place = np.concatenate([whole[named], places[at[there]] if len(hashes) else places])
        weight = np.concatenate([np.ones(len(named), np.float32), share[owner[len(named) :]]])
        order = np.argsort(owner, kind="stable")
        self.places.frombytes(place[order].tobytes())
        self.weights.frombytes(weight[order].tobytes())
        self.sizes.frombytes(np.bincount(owner, minlength=len(words)).astype(np.int64).tobytes())

    def number(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            found = self.known[word] = len(self.sizes)
            names = features(word)
            own = [p for p in map(self.vocabulary.get, names) if p is not None]
            self.places.extend(own)
            self.weights.extend([1 / (len(names) - 1)] * len(own))
            if own and names[0] in self.vocabulary:
                self.weights[-len(own)] = 1.0
            self.sizes.append(len(own))
        return found

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word, embedding place and weight of each feature: 1 for the word, its share for a character n-gram."""
        word = np.repeat(np.arange(len(self.sizes)), self.sizes)
        return word, np.array(self.places, np.int64), np.array(self.weights, np.float32)


def vectors(table: np.ndarray, known: Features, since: int = 0) -> np.ndarray:
    """The vectors of the distinct words from number ``since`` on, some words at a time, as each has many features."""
    sizes = np.array(known.sizes[since:])
    ends = np.cumsum(sizes) + (len(known.places) - int(sizes.sum()))
    out = np.zeros((len(sizes), table.shape[1]), np.float32)
    for low in range(0, len(sizes), WORDS_AT_ONCE):
        own = sizes[low : low + WORDS_AT_ONCE]
        begin, end = ends[low] - sizes[low], ends[low + len(own) - 1]
        place, weight = np.array(known.places[begin:end], np.int64), np.array(known.weights[begin:end], np.float32)
        some = np.flatnonzero(own)
        if len(some):
            firsts = (np.cumsum(own) - own)[some]
            out[low + some] = np.add.reduceat(table[place] * weight[:, None], firsts, axis=0)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def initial(features: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Parameters: embeddings, and per direction the input, recurrent and bias weights of the three gates."""
    rng = np.random.default_rng(seed)
    scaled = lambda rows, cols: (rng.standard_normal((rows, cols)) / np.sqrt(rows)).astype(np.float32)
    p = {"E": (rng.standard_normal((features, EMBEDDING)) * 0.1).astype(np.float32)}
    for d in "fb":
        p[f"W{d}"], p[f"U{d}"] = scaled(EMBEDDING, 3 * HIDDEN), scaled(HIDDEN, 3 * HIDDEN)
        p[f"b{d}"] = np.zeros(3 * HIDDEN, np.float32)
    p["A"], p["a"] = scaled(2 * HIDDEN, ATTENTION), scaled(ATTENTION, 1)[:, 0]
    p["w"], p["c"] = scaled(2 * HIDDEN, 1)[:, 0], np.zeros(1, np.float32)
    return p


def run_direction(inputs: np.ndarray, U: np.ndarray, real: np.ndarray, keep: bool):
    """States of a gated layer over ``inputs`` (time, windows, gates); with ``keep`` also what its gradient needs.

    Where ``real`` (time, windows) is 0 the state is zero, so padding on either side of a window adds nothing.
    """
    steps, n, _ = inputs.shape
    h = np.zeros((n, HIDDEN), np.float32)
    states, kept = np.empty((steps, n, HIDDEN), np.float32), []
    for t in range(steps):
        recurrent = h @ U
        gates = inputs[t, :, : 2 * HIDDEN] + recurrent[:, : 2 * HIDDEN]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        pre = recurrent[:, 2 * HIDDEN :]
        candidate = np.tanh(inputs[t, :, 2 * HIDDEN :] + r * pre)
        if keep:
            kept.append((h, z, r, pre, candidate))
        h = (candidate + z * (h - candidate)) * real[t][:, None]
        states[t] = h
    return states, kept


def pooled(states: np.ndarray, real: np.ndarray, p: dict[str, np.ndarray]):
    """Attention over time: the pooled states, the attention, and its hidden layer."""
    hidden = np.tanh(states @ p["A"])
    logits = np.where(real, hidden @ p["a"], -1e9)
    weights = np.exp(logits - logits.max(axis=0))
    weights /= weights.sum(axis=0)
    return np.einsum("tn,tnh->nh", weights, states), weights, hidden


def gate_inputs(x: np.ndarray, p: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """What the distinct words add to the gates of either direction."""
    return x @ p["Wf"] + p["bf"], x @ p["Wb"] + p["bb"]


def forward(numbers: np.ndarray, inputs: tuple[np.ndarray, np.ndarray], p: dict[str, np.ndarray], keep: bool = False):
    """Scores of windows of word numbers (time, windows); padding is 0 and always at the end."""
    real = (numbers > 0).astype(np.float32)
    ahead, kept_f = run_direction(inputs[0][numbers], p["Uf"], real, keep)
    back, kept_b = run_direction(inputs[1][numbers[::-1]], p["Ub"], real[::-1], keep)
    states = np.concatenate([ahead, back[::-1]], axis=2)
    attended = real > 0
    attended[0] = True  # an empty window attends to its padding, whose state is zero
    pool, weights, hidden = pooled(states, attended, p)
    scores = sigmoid(pool @ p["w"] + p["c"])
    return (scores, (states, kept_f, kept_b, pool, weights, hidden)) if keep else scores


def back_direction(d_states: np.ndarray, kept, U: np.ndarray, real: np.ndarray):
    """Gradients of the gate inputs and of the recurrent weights."""
    steps, n, _ = d_states.shape
    d_inputs, dU, dh = np.empty((steps, n, 3 * HIDDEN), np.float32), np.zeros_like(U), np.zeros((n, HIDDEN), np.float32)
    for t in reversed(range(steps)):
        h, z, r, pre, candidate = kept[t]
        dh = (dh + d_states[t]) * real[t][:, None]
        d_candidate = dh * (1 - z) * (1 - candidate * candidate)
        d_gates = d_inputs[t]
        d_gates[:, :HIDDEN] = dh * (h - candidate) * z * (1 - z)
        d_gates[:, HIDDEN : 2 * HIDDEN] = d_candidate * pre * r * (1 - r)
        d_gates[:, 2 * HIDDEN :] = d_candidate
        d_recurrent = d_gates.copy()
        d_recurrent[:, 2 * HIDDEN :] *= r
        dU += h.T @ d_recurrent
        dh = dh * z + d_recurrent @ U.T
    return d_inputs, dU


def gradients(numbers: np.ndarray, x: np.ndarray, labels: np.ndarray, p: dict[str, np.ndarray]):
    """Mean cross entropy, gradients of all parameters but the embeddings, and gradients of the word vectors."""
    scores, (states, kept_f, kept_b, pool, weights, hidden) = forward(numbers, gate_inputs(x, p), p, keep=True)
    n = len(labels)
    loss = -np.mean(np.log(np.clip(np.where(labels > 0, scores, 1 - scores), 1e-7, 1)))
    d_logit = ((scores - labels) / n).astype(np.float32)
    g = {"w": pool.T @ d_logit, "c": d_logit.sum(keepdims=True)}
    d_pool = d_logit[:, None] * p["w"]
    d_weights = np.einsum("nh,tnh->tn", d_pool, states)
    d_attention = weights * (d_weights - (weights * d_weights).sum(axis=0))
    d_states = weights[:, :, None] * d_pool
    g["a"] = np.einsum("tn,tna->a", d_attention, hidden)
    d_hidden = d_attention[:, :, None] * p["a"] * (1 - hidden * hidden)
    g["A"] = np.einsum("tnh,tna->ha", states, d_hidden)
    d_states = d_states + d_hidden @ p["A"].T
    flat_x, real = np.zeros_like(x), (numbers > 0).astype(np.float32)
    for d, kept, own, order in (("f", kept_f, d_states[:, :, :HIDDEN], numbers), ("b", kept_b, d_states[::-1, :, HIDDEN:], numbers[::-1])):
        d_inputs, g[f"U{d}"] = back_direction(own, kept, p[f"U{d}"], real if d == "f" else real[::-1])
        flat, places = d_inputs.reshape(-1, 3 * HIDDEN), order.ravel()
        sums = np.zeros((len(x), 3 * HIDDEN), np.float32)  # over the places of each distinct word
        by_word = np.argsort(places, kind="stable")
        firsts = np.flatnonzero(np.diff(places[by_word], prepend=-1))
        sums[places[by_word][firsts]] = np.add.reduceat(flat[by_word], firsts, axis=0)
        g[f"W{d}"], g[f"b{d}"] = x.T @ sums, flat.sum(axis=0)
        flat_x += sums @ p[f"W{d}"].T
    flat_x[0] = 0
    return loss, g, flat_x


@dataclass
class Model:
    vocabulary: dict[str, int]
    weights: dict[str, np.ndarray]


MARKS = 1 << 22  # sums of a first count of features by hash
OWNERS_AT_ONCE = 200


def common_features(words: list[str], word: np.ndarray, owner: np.ndarray) -> dict[str, int]:
    """The features that enough documents hold, numbered in order; ``(word, owner)`` are distinct, by owner.

    A first pass adds up the holders of words by a hash of their features, which is never too low; only the features
    that may be common by it are named and counted exactly, some documents at a time.
    """
    owners = int(owner[-1]) + 1 if len(owner) else 0
    least = max(LEAST_DOCS, round(LEAST_SHARE * owners))
    held, marks = np.bincount(word, minlength=len(words)), np.zeros(MARKS, np.int64)
    for w, n in zip(words, held.tolist()):
        for name in features(w):
            marks[zlib.crc32(name.encode()) % MARKS] += n
    numbers: dict[str, int] = {}
    own, sizes = array("q"), array("q")
    for w in words:
        likely = [numbers.setdefault(name, len(numbers)) for name in features(w) if marks[zlib.crc32(name.encode()) % MARKS] >= least]
        own.extend(likely)
        sizes.append(len(likely))
    own, sizes, holders = np.array(own, np.int64), np.array(sizes, np.int64), np.zeros(len(numbers), np.int64)
    starts = np.cumsum(sizes) - sizes
    for first in range(0, owners, OWNERS_AT_ONCE):
        low, high = np.searchsorted(owner, [first, first + OWNERS_AT_ONCE])
        some = word[low:high]
        pairs = np.repeat(owner[low:high], sizes[some]) * len(numbers) + own[ragged(starts[some], sizes[some])]
        holders += np.bincount(np.unique(pairs) % len(numbers), minlength=len(numbers)) if len(pairs) else 0
    return {name: i for i, name in enumerate(sorted(n for n, i in numbers.items() if holders[i] >= least))}


def train(texts: list[str], text_labels: np.ndarray, seed: int = 7) -> Model:
    """Fit the network by Adam on all windows of some texts, whose label is that of their text.

    After the first epoch only the best-scoring window of a toxic text counts, since it also has harmless ones.
    """
    lengths, spelt, own = [], {}, array("q")  # words are numbered text by text, so no text is held as a list of words
    for text in texts:
        found = words_of(text)
        own.extend([spelt.setdefault(w, len(spelt)) for w in found])
        lengths.append(len(found))
    flat, lengths, words = np.array(own, np.int64), np.array(lengths, np.int64), list(spelt)
    pairs = np.unique(np.repeat(np.arange(len(texts)), lengths) * max(1, len(words)) + flat)
    vocabulary = common_features(words, pairs % max(1, len(words)), pairs // max(1, len(words)))
    known, p, rng = Features(vocabulary), initial(len(vocabulary), seed), np.random.default_rng(seed)
    for w in words:
        known.number(w)  # in order: from 1 on
    counts = np.array([len(window_starts(n)) for n in lengths.tolist()], np.int64)
    owners = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owners)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = (np.cumsum(lengths) - lengths)[owners] + nth * STRIDE
    at = np.arange(WINDOW)[:, None] + begin
    inside = at < np.cumsum(lengths)[owners]
    numbers = np.zeros((WINDOW, len(owners)), np.int32)
    numbers[inside] = flat[at[inside]] + 1
    labels = np.asarray(text_labels, np.float32)[owners]
    if len(set(labels.tolist())) < 2:
        p["w"][:] = 0
        p["c"][:] = 4.0 if labels.max(initial=0) else -4.0
        return Model(vocabulary, p)
    word, place, weight = known.arrays()
    first = np.searchsorted(word, np.arange(len(known.sizes) + 1))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    step = 0
    for epoch in range(EPOCHS):
        chosen = np.arange(len(owners))
        if epoch:
            inputs = gate_inputs(vectors(p["E"], known), p)
            now = np.concatenate([forward(numbers[:, i : i + 512], inputs, p) for i in range(0, len(owners), 512)])
            best = np.full(len(texts), -1.0)
            np.maximum.at(best, owners, now)
            chosen = np.flatnonzero((labels == 0) | (now >= best[owners]))
        rng.shuffle(chosen)
        rate = RATE * (1 - epoch / EPOCHS)
        for at in range(0, len(chosen), BATCH):
            pick = chosen[at : at + BATCH]
            used, local = np.unique(np.append(numbers[:, pick], 0), return_inverse=True)
            sizes = first[used + 1] - first[used]
            spans = ragged(first[used], sizes)
            owner = np.repeat(np.arange(len(used)), sizes)
            x = np.zeros((len(used), EMBEDDING), np.float32)
            np.add.at(x, owner, p["E"][place[spans]] * weight[spans, None])
            _, g, dx = gradients(local[:-1].reshape(WINDOW, -1), x, labels[pick], p)
            g["E"] = np.zeros_like(p["E"])
            np.add.at(g["E"], place[spans], dx[owner] * weight[spans, None])
            step += 1
            for k, grad in g.items():
                m, v = moments[k]
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                p[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            p["E"] *= 1 - rate * DECAY
    return Model(vocabulary, p)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    training_docs: int = TRAINING_DOCS,
    training_words: int = TRAINING_WORDS,
) -> Model:
    """Train on a bounded sample of labelled documents, balanced between the labels.

    Of each label the ``training_docs`` ids with the smallest hash are candidates; of these, in that order, whole
    documents are taken while their words add up to no more than ``training_words``, and longer ones passed over; then
    the larger label's while they are at most ``TRAINING_SHARE`` times the other's. The bounds are parameters; nothing else of the labels is used. All windows of the taken documents are read. An id
    labelled more than once counts as toxic if any label does; null labels and ids are left out; of repeated rows each
    counts. Without two labels the network is constant.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    ranked = known.withColumn("draw", F.xxhash64("id", F.lit("toxicity sample")))
    sample = ranked.where("label = 0").orderBy("draw", "id").limit(training_docs)
    sample = sample.unionByName(ranked.where("label = 1").orderBy("draw", "id").limit(training_docs))
    chosen = [(r["id"], r["label"], r["draw"]) for r in sample.collect()]  # at most twice training_docs
    wanted = docs.sparkSession.createDataFrame(chosen, f"id {docs.schema[id_col].dataType.simpleString()}, label int, draw bigint")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(wanted), "id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            sizes = pa.array([len(words_of(t)) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("label", "draw", "text")), sizes], names=["label", "draw", "text", "words"])

    found = staged(texts.mapInArrow(released(count), "label int, draw bigint, text string, words bigint"), "toxicity-sample")
    in_order = Window.partitionBy("label").orderBy("draw", "words", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, 0)
    fitting = found.where(F.col("words") <= training_words).withColumn("sum", F.sum("words").over(in_order))
    rows = fitting.where(F.col("sum") <= training_words).select("label", "draw", "words", "text").collect()
    rows.sort(key=lambda r: (r["draw"], r["label"], r["words"], r["text"]))
    words = [sum(r["words"] for r in rows if r["label"] == label) for label in (0, 1)]
    if min(words):
        taken = [0, 0]
        for r in list(rows):
            taken[r["label"]] += r["words"]
            if taken[r["label"]] > TRAINING_SHARE * words[1 - r["label"]]:
                rows.remove(r)
    model = train([r["text"] for r in rows], np.array([r["label"] for r in rows], np.float32))
    release()  # the driver goes on to other stages
    return model


class Scorer:
    """A model with the gate inputs of the words met so far."""

    def __init__(self, model: Model):
        self.p, self.known = model.weights, Features(model.vocabulary)
        self.inputs = gate_inputs(vectors(self.p["E"], self.known), self.p)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Worst window of each text, its number, and the number of windows."""
        known, p = self.known, self.p
        if len(known.sizes) > KNOWN_WORDS:
            known.clear()
            self.inputs = gate_inputs(vectors(p["E"], known), p)
        rows, lengths, since = [], [], len(known.sizes)
        for text in texts:
            own = words_of(text)
            rows += [known.known.get(w) or known.later(w) for w in own]
            lengths.append(len(own))
        known.look_up()
        if len(known.sizes) > since:
            new = gate_inputs(vectors(p["E"], known, since), p)
            self.inputs = tuple(np.concatenate(pair) for pair in zip(self.inputs, new))
        flat, ends = np.array(rows, np.int64), np.cumsum(lengths)
        counts = np.array([len(window_starts(n)) for n in lengths])
        owner = np.repeat(np.arange(len(texts)), counts)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = (ends - lengths)[owner] + number * STRIDE
        sizes = np.minimum(ends[owner] - begin, WINDOW)
        scores = np.empty(len(owner), np.float32)
        order = np.argsort(sizes, kind="stable")  # windows of like lengths together, so short ones take few steps
        steps = np.arange(WINDOW)[:, None]
        for at in range(0, len(order), SLICE):
            pick = order[at : at + SLICE]
            longest = max(1, int(sizes[pick].max()))
            inside = steps[:longest] < sizes[pick]
            numbers = np.where(inside, flat[np.where(inside, begin[pick] + steps[:longest], 0)] if len(flat) else 0, 0)
            scores[pick] = forward(numbers, self.inputs, p)
        firsts = np.cumsum(counts) - counts
        worst = np.maximum.reduceat(scores, firsts)
        hits = np.flatnonzero(scores == worst[owner])
        return worst, number[hits[np.searchsorted(owner[hits], np.arange(len(texts)))]], counts


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``id_col, score, predicted, worst_word, windows`` for every document.

    ``score`` is that of the worst window, which starts at word ``worst_word`` (the first of equals); ``predicted`` is
    1 from ``threshold`` on. Null and empty texts have one empty window. Null and repeated ids pass, each row gives one
    row; other columns are left out and no other column is read. Narrow; texts are handled whole, some at a time.
    """
    held = docs.sparkSession.sparkContext.broadcast((model.vocabulary, model.weights))  # as large as the words of the bounded training sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worst_windows = Scorer(Model(*held.value))
        for batch in text_chunks(batches, limit=2 << 20):
            worst, number, counts = worst_windows(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(worst.astype(np.float64)), pa.array(number * STRIDE), pa.array(counts.astype(np.int64))],
                names=["id", "score", "worst_word", "windows"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        released(run), f"id {id_type}, score double, worst_word bigint, windows bigint"
    )
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    return found.select(F.col("id").alias(id_col), "score", predicted, "worst_word", "windows")


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below ``threshold``. Rows with a null text stay."""
    held = docs.sparkSession.sparkContext.broadcast((model.vocabulary, model.weights))
    own = unused("scored_text", docs.columns)
    scored = docs.withColumn(own, F.col(text_col).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worst_windows = Scorer(Model(*held.value))
        for batch in batches:
            missing = batch.column(own).is_null()
            at = 0
            for part in text_chunks(iter([batch]), own, limit=2 << 20):
                worst, _, _ = worst_windows(part.column(own).to_pylist())
                good = pa.array(worst.astype(np.float64) < threshold)
                yield part.filter(pc.or_(good, missing.slice(at, part.num_rows))).drop_columns([own])
                at += part.num_rows

    return scored.mapInArrow(released(run), docs.schema)
