"""Groups of spelling variants by a dictionary of trie-node pairs.

All beginnings of words are nodes of a forward trie, all endings nodes of a trie over the reversed words; nodes are
numbered along the sorted words. A word cut before position i is the pair (node of what is before, node of the rest),
and with position i left out the pair (node before, node after). Two words that differ in one replaced character have a
pair with the same position left out in common; a word that has one character more than another gives, with it left
out, a pair that cuts the other word. Rows that meet in one of these integer pairs therefore are exactly the words one
edit apart, without spelling out edited words. Words are numbered in the order in which they are preferred as forms, so
the pairs carry one number for each word, and a group holds at most one word for each character and the word they
all come from.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefacts.llm.batches import lists, ragged, text_chunks, utf8
from sitefacts.plans.scratch import staged

LEAST_LENGTH, LEAST_COUNT = 7, 2  # of a word, in characters, and of its occurrences
FACTOR = 10  # a form occurs so many times as often as its variant
THINNED = 31  # one run in so many loses a character, by a hash of document and run

# The checksum is CRC-32 (reflected polynomial EDB88320), byte by byte through a table.
CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC = np.where(CRC & 1, np.uint32(0xEDB88320) ^ (CRC >> 1), CRC >> 1).astype(np.uint32)

# Runs are of A-Z, a-z and U+00C0 to U+00FF, which UTF-8 writes as C3 and a second byte.
LETTER = np.array([chr(b).isalpha() if b < 128 else b == 0xC3 for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def runs_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which bytes are in runs of letters, and the first byte and the end of each run."""
    inside = LETTER[data]
    inside[1:] |= data[:-1] == 0xC3
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    borders = offsets[1:-1]
    before[borders[borders < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[borders[borders > 0] - 1] = False
    return inside, starts, np.flatnonzero(inside & ~after) + 1


def checksums(crc: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC registers after the bytes of each run; runs still going on advance by one byte at a time."""
    crc = crc.copy()
    order = np.argsort(-sizes, kind="stable")
    left, at = crc[order], starts[order]
    going = np.searchsorted(-sizes[order], -np.arange(1, int(sizes.max(initial=0)) + 1), side="right")  # runs of that size or more
    for i, n in enumerate(going.tolist()):
        left[:n] = CRC[(left[:n] ^ data[at[:n] + i]) & 0xFF] ^ (left[:n] >> np.uint32(8))
    crc[order] = left
    return crc


def words_of(ids: pa.Array, texts: pa.Array, thinned: int) -> pa.Array:
    """The words of some texts: lower-cased runs, of which those chosen by their hash lose a character."""
    data, offsets = utf8(texts)
    inside, starts, ends = runs_of(data, offsets)
    data = LOWER[data]
    names, places = utf8(pc.binary_join_element_wise(ids.fill_null(""), pa.scalar(":"), pa.scalar("")))
    crc = checksums(np.full(len(ids), 0xFFFFFFFF, np.uint32), names, places[:-1], np.diff(places))
    row = np.searchsorted(offsets, starts, side="right") - 1
    hashes = checksums(crc[row], data, starts, ends - starts) ^ np.uint32(0xFFFFFFFF)
    # The byte where each character starts, for runs that lose one.
    hashes = hashes.astype(np.int64)
    cut = np.flatnonzero(hashes % thinned == 0)
    heads = inside & (data & 0xC0 != 0x80)
    before = np.concatenate([[0], np.cumsum(heads)])
    characters = before[ends[cut]] - before[starts[cut]]
    gone = np.flatnonzero(heads)[before[starts[cut]] + hashes[cut] % characters]
    sizes = ends - starts
    width = np.where(data[gone] == 0xC3, 2, 1)
    inside[gone] = False
    inside[gone[width == 2] + 1] = False
    sizes[cut] -= width
    return pa.Array.from_buffers(
        pa.string(), len(sizes), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.py_buffer(data[inside])]
    )


def word_counts(docs: DataFrame, id_col: str, text_col: str, least_length: int, thinned: int) -> DataFrame:
    """``word, n`` over all texts; a few megabytes of text are counted before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, limit=16 << 20):
            words = words_of(batch.column("id"), batch.column("text"), thinned)
            found = words.filter(pc.greater_equal(pc.utf8_length(words), least_length)).value_counts()
            yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=["word", "n"])

    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


PART_BITS = 40  # of a node number; those above say which part of the sorted words it comes from


def common_beginning(a: str, b: str) -> int:
    n, i = min(len(a), len(b)), 0
    while i < n and a[i] == b[i]:
        i += 1
    return i


def trie_numbers(words: DataFrame, spelling: Column, name: str) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray]]:
    """``(w, nodes)``: the nodes on each word's way through the trie of the spellings, root first; and node aliases.

    Along sorted words the nodes of a word are those it shares with the word before and new ones from there on. A task
    numbers the nodes of its part of the order. Where a part begins with what the part before ended with, its first
    nodes are aliases of nodes there: a few for each part.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, way, used, nth = "", [], 0, 0
        for batch in batches:
            ways, base = [], batch.column("part")[0].as_py() << PART_BITS if batch.num_rows else 0
            for word in batch.column("spelling").to_pylist():
                shared = common_beginning(before, word) + 1 if way else 0
                way = way[:shared] + list(range(base + used, base + used + len(word) + 1 - shared))
                used += len(word) + 1 - shared
                before = word
                ways.append(way)
            flat = pa.array(np.fromiter(itertools.chain.from_iterable(ways), np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("w"), batch.column("part"), pa.array(np.arange(nth, nth + len(ways))), batch.column("spelling"), lists(flat, np.array([len(x) for x in ways], np.int64))],
                names=["w", "part", "nth", "spelling", "nodes"],
            )
            nth += len(ways)

    in_order = words.select("w", spelling.alias("spelling")).repartitionByRange("spelling").sortWithinPartitions("spelling")
    parts = in_order.select("w", "spelling", F.spark_partition_id().alias("part"))
    found = staged(parts.mapInArrow(number, "w bigint, part int, nth bigint, spelling string, nodes array<bigint>"), f"{name}-trie")
    ends = found.groupBy("part").agg(F.min_by("spelling", "nth").alias("first"), F.max_by(F.struct("spelling", "nodes"), "nth").alias("last"))
    aliases: dict[int, int] = {}
    before = None
    for row in ends.orderBy("part").collect():  # one for each task
        if before:
            for i in range(common_beginning(before["spelling"], row["first"]) + 1):
                aliases[(row["part"] << PART_BITS) + i] = aliases.get(before["nodes"][i], before["nodes"][i])
        before = row["last"]
    return found.select("w", "nodes"), (np.array(list(aliases), np.int64), np.array(list(aliases.values()), np.int64))


def resolved(nodes: np.ndarray, aliases: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    names, values = aliases  # names rise, as parts and depths do
    if not len(names):
        return nodes
    at = np.minimum(np.searchsorted(names, nodes), len(names) - 1)
    return np.where(names[at] == nodes, values[at], nodes)


CUT, SKIP, FIRST_SKIP = 0, 1, 2  # FIRST_SKIP: the character left out differs from the one before it


def node_pairs(words: DataFrame) -> DataFrame:
    """``(p, s, v)``: the cuts of all words and the pairs with a position left out; ``v`` is 4 * w + kind.

    Of a run of equal characters only the first counts as an insertion, as leaving out any of them gives the same word.
    """
    before, before_aliases = trie_numbers(words, F.col("word"), "forward")
    after, after_aliases = trie_numbers(words, F.reverse("word"), "reversed")
    held = words.sparkSession.sparkContext.broadcast((before_aliases, after_aliases))  # the depth of a shared node at most, for each task
    both = words.select("w", "word").join(before.withColumnRenamed("nodes", "p"), "w").join(after.withColumnRenamed("nodes", "s"), "w")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forward, reversed_ = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            p = resolved(batch.column("p").flatten().to_numpy(), forward)
            s = resolved(batch.column("s").flatten().to_numpy(), reversed_)
            w, words = batch.column("w").to_numpy(), batch.column("word")
            sizes = pc.utf8_length(words).to_numpy().astype(np.int64)
            base = np.cumsum(sizes + 1) - (sizes + 1)  # of a word's nodes, one more than its characters
            letters = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), "<u4")
            changes = np.concatenate([[True], letters[1:] != letters[:-1]])
            changes[np.cumsum(sizes) - sizes] = True
            cut, skip = ragged(base, sizes + 1), ragged(base, sizes)
            last = base + sizes
            row_cut, row_skip = np.repeat(np.arange(len(w)), sizes + 1), np.repeat(np.arange(len(w)), sizes)
            found = [
                np.concatenate([p[cut], p[skip]]),
                np.concatenate([s[base[row_cut] + last[row_cut] - cut], s[base[row_skip] + last[row_skip] - 1 - skip]]),
                np.concatenate([4 * w[row_cut] + CUT, 4 * w[row_skip] + np.where(changes, FIRST_SKIP, SKIP)]),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(f) for f in found], names=["p", "s", "v"])

    return both.mapInArrow(pairs, "p bigint, s bigint, v bigint")


def neighbours(words: DataFrame) -> DataFrame:
    """``(w, n_near, best)``: how many words are one edit from each that has any, and the first of them in preference.

    A word meets each neighbour by a replaced character in exactly one group of words with a position left out, and one
    with an inserted or deleted character in the one group of the shorter word's cut.
    """
    groups = node_pairs(words).groupBy("p", "s").agg(F.sort_array(F.collect_list("v")).alias("vs")).where(F.size("vs") > 1)
    number = lambda v: F.shiftright(v, 2)
    kind = lambda v: v.bitwiseAND(F.lit(3))
    split = groups.select(
        F.transform(F.filter("vs", lambda v: kind(v) != CUT), number).alias("skips"),
        F.transform(F.filter("vs", lambda v: kind(v) == FIRST_SKIP), number).alias("firsts"),
        F.get(F.transform(F.filter("vs", lambda v: kind(v) == CUT), number), F.lit(0)).alias("cut"),
    )

    def link(w: Column, near: Column, best: Column) -> Column:
        return F.struct(w.alias("w"), near.cast("bigint").alias("near"), best.alias("best"))

    one, two, none = F.get("skips", F.lit(0)), F.get("skips", F.lit(1)), F.array().cast("array<struct<w:bigint,near:bigint,best:bigint>>")
    replaced = F.when(F.size("skips") > 1, F.transform("skips", lambda w: link(w, F.size("skips") - 1, F.when(w == one, two).otherwise(one))))
    longer = F.when(F.col("cut").isNotNull(), F.transform("firsts", lambda w: link(w, F.lit(1), F.col("cut"))))
    shorter = F.when(F.col("cut").isNotNull() & (F.size("firsts") > 0), F.array(link(F.col("cut"), F.size("firsts"), F.get("firsts", F.lit(0)))))
    links = split.select(F.inline(F.concat(*[F.coalesce(x, none) for x in (replaced, longer, shorter)])))
    return links.groupBy("w").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: where following forms ends, for words ``(word, form)`` that have one.

    Every step doubles the way. A form occurs more often than its word, so ways have no circles and are short.
    """
    ways = staged(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = staged(ways.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        ways = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return ways


def variant_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    factor: int = FACTOR,
    thinned: int = THINNED,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: every frequent word with its more frequent spelling.

    Words are runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased, of ``least_length`` characters and
    ``least_count`` occurrences in all texts together; where ``thinned`` divides the CRC-32 of ``<id>:<run>``, the
    run's character at the hash modulo its length is deleted first. Two words are near if one inserted, deleted or
    replaced character makes them equal; ``n_near`` counts the near words. ``form`` is the near word of largest ``n``
    (then first by code points) if that is ``factor`` times the word's or more, otherwise null; ``root`` follows
    forms to the last, or is the word itself.

    Null texts hold no words, a null id is written as nothing in the hash, repeated rows count again, other columns
    are left out, and an empty table gives no rows. Tasks hold some megabytes of text, or one document; all that is
    grouped or joined are rows for a position of a distinct word, and a group has at most one word for a character.
    """
    counts = word_counts(docs, id_col, text_col, least_length, thinned).where(F.col("n") >= least_count)
    preferred = counts.select("word", "n", (-F.col("n")).alias("order")).repartitionByRange("order", "word").sortWithinPartitions("order", "word")
    words = staged(preferred.select(F.monotonically_increasing_id().alias("w"), "word", "n"), "variant-words")
    near = neighbours(words).join(words.select(F.col("w").alias("best"), F.col("word").alias("near_word"), F.col("n").alias("near_n")), "best")
    found = words.join(near, "w", "left")
    frequent = F.col("near_n") >= factor * F.col("n")
    found = found.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(frequent, F.col("near_word")).alias("form"), F.when(frequent, F.col("near_n")).alias("form_n"),
    )
    found = staged(found, "variant-forms")
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
