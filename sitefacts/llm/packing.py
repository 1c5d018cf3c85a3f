"""Packing by power-of-two decomposition: every piece is a training sequence of its own.

A document of n tokens is cut into full sequences and one piece for each binary digit of what remains. Pieces have
power-of-two lengths, need no padding and never hold two documents; training takes batches of equal lengths.
"""

from __future__ import annotations

import functools
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitefacts.llm.batches import lists, ragged, released, text_chunks

SEQUENCE_TOKENS = 2048
END_ID = 1
CACHED_PARTS = 600_000  # bounds a task's memory; the cache starts anew beyond it
PARTS_AT_ONCE = 20_000
WORD_END = "</w>"
PLAIN = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[.,;:!?%$&*#|()\"-]*)$"  # composed letters, whose lower case is one letter


class WordEncoder:
    """Token ids of texts, word by word, with the ids of recent parts of words kept.

    The tokenizer drops white space and never joins what stands on both sides of it, so the ids of a text are those
    of its words in order. A word of Latin letters, perhaps with punctuation behind, is two parts to the tokenizer,
    which lower-cases letters and encodes each part alone; all other words are encoded as they are. Parts are encoded
    many at once: the last token of a part is one that ends a word.
    """

    def __init__(self, tokenizer_file: str, end_id: int):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_file)
        self.encode = functools.partial(tokenizer.encode_batch_fast, add_special_tokens=False)
        self.ends_word = np.zeros(tokenizer.get_vocab_size(), bool)
        self.ends_word[[i for token, i in tokenizer.get_vocab().items() if token.endswith(WORD_END)]] = True
        self.end_id = end_id
        self.clear()

    def clear(self) -> None:
        """Keep only the end of a document as part 0, and nothing as part 1."""
        self.known: dict[str, int] = {"": 1}
        self.ids, self.used = np.full(1 << 16, self.end_id, np.uint32), 1
        self.starts, self.sizes = array("q", [0, 0]), array("q", [1, 0])

    def keep(self, parts: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids) + len(ids), np.uint32)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.known.update(zip(parts, range(len(self.starts), len(self.starts) + len(parts))))
        self.starts.frombytes((self.used + np.cumsum(sizes) - sizes).astype(np.int64).tobytes())
        self.sizes.frombytes(sizes.astype(np.int64).tobytes())
        self.used += len(ids)

    def learn(self, parts: list[str], single: bool) -> None:
        """Encode new parts. ``single``: each is one unit to the tokenizer."""
        for at in range(0, len(parts), PARTS_AT_ONCE):
            some = parts[at : at + PARTS_AT_ONCE]
            if single:
                ids = np.array(self.encode([" ".join(some)])[0].ids, np.uint32)
                ends = np.flatnonzero(self.ends_word[ids]) + 1
                if len(ends) == len(some):
                    self.keep(some, ids, np.diff(ends, prepend=0))
                    continue
            found = [e.ids for e in self.encode(some)]
            self.keep(some, np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found]))

    def places(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The two parts of each word."""
        if len(self.known) + len(words) > CACHED_PARTS:
            self.clear()
        plain = pc.extract_regex(words, PLAIN)  # null for other words
        letters, marks = plain.field("letters"), plain.field("marks")
        heads = pc.if_else(plain.is_valid(), pc.utf8_lower(letters), words).dictionary_encode()
        tails = pc.if_else(plain.is_valid(), marks, "").dictionary_encode()
        some, ends = heads.dictionary.to_pylist(), tails.dictionary.to_pylist()
        is_plain = pc.match_substring_regex(heads.dictionary, PLAIN).to_pylist()
        new = {head for head, single in zip(some, is_plain) if single and head not in self.known}
        new.update(tail for tail in ends if tail not in self.known)
        odd = {head for head, single in zip(some, is_plain) if not single and head not in self.known}
        self.learn(sorted(new), single=True)
        self.learn(sorted(odd - new), single=False)
        of = self.known.__getitem__
        head_at, tail_at = np.fromiter(map(of, some), np.int64, len(some)), np.fromiter(map(of, ends), np.int64, len(ends))
        return head_at[heads.indices.to_numpy()], tail_at[tails.indices.to_numpy()]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each closed by the end id, and the number of ids of each text."""
        split = pc.ascii_split_whitespace(texts)
        coded = pc.dictionary_encode(split.flatten())
        heads, tails = self.places(coded.dictionary)
        at = coded.indices.to_numpy()
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        parts = np.empty((len(at), 2), np.int64)
        parts[:, 0], parts[:, 1] = heads[at], tails[at]
        order = np.insert(parts.ravel(), np.cumsum(counts) * 2, 0)
        sizes = np.asarray(self.sizes)[order]
        ids = self.ids[ragged(np.asarray(self.starts)[order], sizes)]
        firsts = np.cumsum(2 * counts + 1) - (2 * counts + 1)
        return ids, np.add.reduceat(sizes, firsts)


def binary_pieces(tokens: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the pieces of all documents in order, and the number of pieces of each document."""
    digits = longest.bit_length() - 1
    powers = np.concatenate([[longest], 1 << np.arange(digits - 1, -1, -1)])
    taken = np.concatenate([(tokens // longest)[:, None], (tokens[:, None] >> np.arange(digits - 1, -1, -1)) & 1], axis=1)
    return np.repeat(np.tile(powers, len(tokens)), taken.ravel()), taken.sum(axis=1)


def decompose(
    docs: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence_tokens: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    as_lists: bool = False,
) -> DataFrame:
    """One row per piece: ``id_col, start, length, doc_tokens, sequence_id, offset, ids``.

    ``ids`` are unsigned 32-bit little-endian token ids, or with ``as_lists`` arrays of integers, as ``token_lists`` gives
    them but without further workers. A piece is the sequence ``sequence_id`` from offset 0. A null
    or empty text is the end id alone. Repeated documents give repeated pieces with sequence ids of their own; null
    document ids pass through; other columns are left out. ``sequence_tokens`` must be a power of two. Narrow: no
    shuffle, and a task holds the tokens of a few megabytes of text, or of one document.
    """
    if sequence_tokens < 1 or sequence_tokens & (sequence_tokens - 1):
        raise ValueError("sequence_tokens must be a power of two")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer_file, end_id)
        for batch in text_chunks(batches):
            ids, tokens = encoder(batch.column("text"))
            lengths, counts = binary_pieces(tokens, sequence_tokens)
            ends = np.cumsum(lengths)
            row = np.repeat(np.arange(batch.num_rows), counts)
            starts = ends - lengths - (np.cumsum(tokens) - tokens)[row]
            if as_lists:
                held = lists(pa.array(ids.astype(np.int32)), lengths)
            else:
                held = pa.Array.from_buffers(
                    pa.binary(), len(lengths),
                    [None, pa.py_buffer(np.concatenate([[0], ends * 4]).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))],
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(row)), pa.array(starts), pa.array(lengths), pa.array(tokens[row]), held],
                names=["id", "start", "length", "doc_tokens", "ids"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        released(pieces), f"id {kind}, start bigint, length bigint, doc_tokens bigint, ids {'array<int>' if as_lists else 'binary'}"
    )
    return found.select(
        F.col("id").alias(id_col), "start", "length", "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"), "ids",
    )


def token_lists(pieces: DataFrame) -> DataFrame:
    """The pieces with ``ids`` as an array of integers."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("ids").to_pylist()
            flat = np.frombuffer(b"".join(raw), "<u4").astype(np.int32)
            sizes = np.fromiter((len(r) // 4 for r in raw), np.int64, len(raw))
            yield batch.set_column(batch.schema.get_field_index("ids"), "ids", lists(pa.array(flat), sizes))

    fields = ", ".join(f"`{f.name}` {'array<int>' if f.name == 'ids' else f.dataType.simpleString()}" for f in pieces.schema)
    return pieces.mapInArrow(unpack, fields)


def write_buckets(pieces: DataFrame, folder: str) -> None:
    """One folder per length, so that training reads batches of equal sequences."""
    pieces.write.partitionBy("length").parquet(folder)
