"""Token ids as files of canonical, length-limited Huffman codes.

Ids are counted over all documents; package-merge gives the best code lengths up to a limit, and canonical codes follow
from the lengths alone. Documents are written in ascending order of their ids, in blocks that are read independently.
A block keeps the bit offset of every 128th id, so a reader decodes the parts between such checkpoints side by side
with one look-up table.

Format, a folder of Parquet files, which every store that Spark writes to can hold:

- ``codes``: ``id, length`` of every id that occurs. Codes of a length are consecutive numbers in order of id, shorter
  ones first.
- ``blocks``: ``shard, block, first_token, n_tokens, docs, lengths, checkpoints, bits``. Blocks hold whole documents.
  ``docs`` and ``lengths`` are the document ids and their numbers of token ids, ``first_token`` counts the token ids
  before the block in its shard, ``checkpoints`` are bit offsets as unsigned 64-bit little-endian integers, and ``bits``
  holds the codes, first bit highest. Shards, one for each writing task, are in ascending order of document id.
- ``shards``: ``shard, first_token``, the token ids in all shards before it.
"""

from __future__ import annotations

import functools
import itertools
import operator
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sitefacts.llm.batches import lists, ragged, strings, text_chunks, utf8
from sitefacts.plans.scratch import scratch_folder

END_ID = 0
LONGEST_CODE = 20  # bits; more only for more than 2**20 distinct ids. A table of 2**20 entries decodes them
TABLE_BITS = 25  # the longest code that one 32-bit window holds at any offset within a byte
CHECKPOINT = 128  # ids between two checkpoints
BLOCK_TOKENS = 1 << 18  # a block ends with the document that reaches this
TEXT_BYTES = 3 << 20  # tokenized at once, or one document
CACHED_PIECES = 420_000  # bounds a task's memory; the cache starts anew beyond it
PIECES_AT_ONCE = 20_000

# What may follow a space that begins a piece: visible ASCII, or the first byte of a character that is no white space
# (those beyond ASCII start with C2, E1, E2 or E3).
VISIBLE = np.array([0x21 <= b <= 0x7E or (b >= 0xC3 and b not in (0xE1, 0xE2, 0xE3)) for b in range(256)])
ASCII_LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])
ASCII_OTHER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
ASCII_MARK = np.array([0x21 <= b <= 0x7E and not chr(b).isalpha() and b != 0x27 for b in range(256)])  # no letter, no apostrophe
LATIN_END = np.array([0x80 <= b <= 0xBF and b not in (0x97, 0xB7) for b in range(256)])  # after C3: a letter, as these are the two signs

# Byte-level vocabularies write visible bytes as their Latin-1 characters and the others as those from U+0100 on.
_HIDDEN = [b for b in range(256) if b not in range(0x21, 0x7F) and b not in range(0xA1, 0xAD) and b not in range(0xAE, 0x100)]
WRITTEN = np.array([256 + _HIDDEN.index(b) if b in _HIDDEN else b for b in range(256)], "<u4")


ID = operator.attrgetter("id")


def latin_letters(data: np.ndarray) -> np.ndarray:
    """Which bytes are ASCII letters or end a Latin letter of two bytes that begins with C3."""
    letter = ASCII_LETTER[data]
    letter[1:] |= LATIN_END[data[1:]] & (data[:-1] == 0xC3)
    return letter


class PieceEncoder:
    """Token ids of texts, piece by piece, with the ids of recent pieces kept.

    A byte-level tokenizer always begins a new unit at a space that is followed by something visible, where letters
    end, and where letters follow a digit or a mark other than an apostrophe; so the ids of a text are those of the
    pieces between such places in order. Texts are cut at special tokens first.
    """

    def __init__(self, tokenizer_file: str, end_id: int):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_file)
        self.encode = functools.partial(tokenizer.encode_batch_fast, add_special_tokens=False)
        self.model = tokenizer.model
        self.special = [token.content.encode() for token in tokenizer.get_added_tokens_decoder().values()]
        self.end_id = end_id
        self.clear()

    def clear(self) -> None:
        """Keep only the end of a document, as piece 0."""
        self.known: dict[str, int] = {}
        self.ids, self.used = np.full(1 << 16, self.end_id, np.uint32), 1
        self.starts, self.sizes = np.zeros(1, np.int64), np.ones(1, np.int64)

    def ids_of(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some pieces, one after the other, and how many each has.

        Pieces of letters go to the vocabulary's merges directly, all others through the whole tokenizer.
        """
        data, offsets = utf8(pieces)
        letter = latin_letters(data)
        letter[:-1] |= (data[:-1] == 0xC3) & letter[1:]  # with the first bytes of letters of two
        spaced = offsets[:-1][data[offsets[:-1]] == 0x20]
        spaced = spaced[np.append(offsets[1:], 0)[np.searchsorted(offsets[:-1], spaced)] > spaced + 1]
        letter[spaced] = True  # a space before other characters is one unit with them
        single = np.logical_and.reduceat(letter, offsets[:-1])
        written = WRITTEN[data].tobytes().decode("utf-32-le")  # a character for each byte
        tokenize, sizes = self.model.tokenize, np.empty(len(pieces), np.int64)
        merged = [tokenize(written[a:b]) for a, b in zip(offsets[:-1][single].tolist(), offsets[1:][single].tolist())]
        others = [e.ids for e in self.encode(strings(pieces.filter(pa.array(~single))))]
        sizes[single], sizes[~single] = list(map(len, merged)), list(map(len, others))
        of_merged = np.repeat(single, sizes)
        ids, n = np.empty(len(of_merged), np.uint32), int(of_merged.sum())
        ids[of_merged] = np.fromiter(map(ID, itertools.chain.from_iterable(merged)), np.uint32, n)
        ids[~of_merged] = np.fromiter(itertools.chain.from_iterable(others), np.uint32, len(ids) - n)
        return ids, sizes

    def learn(self, words: list[str], pieces: pa.Array) -> None:
        for at in range(0, len(words), PIECES_AT_ONCE):
            some = words[at : at + PIECES_AT_ONCE]
            ids, sizes = self.ids_of(pieces.slice(at, PIECES_AT_ONCE))
            if self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(len(self.ids) + len(ids), np.uint32)])
            self.ids[self.used : self.used + len(ids)] = ids
            self.known.update(zip(some, range(len(self.starts), len(self.starts) + len(some))))
            self.starts = np.concatenate([self.starts, self.used + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.used += len(ids)

    def piece_starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The first byte of every piece; pieces end with their text."""
        begins, after = np.zeros(len(data) + 1, bool), data[1:]
        letter = latin_letters(data)
        begins[1:-1] = ((letter[:-1]) & ASCII_OTHER[after]) | (ASCII_MARK[data[:-1]] & ASCII_LETTER[after])
        begins[: max(0, len(data) - 1)] |= (data[:-1] == 0x20) & VISIBLE[after]
        for token in self.special:
            whole = data.tobytes() if token[0] in data else b""
            at = whole.find(token)
            while at >= 0:
                begins[max(0, at - 1) : at + len(token)] = False
                begins[[at, at + len(token)]] = True
                at = whole.find(token, at + len(token))
        begins[offsets] = True
        begins[-1] = False
        return np.flatnonzero(begins)

    def pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of all texts in order, by number, and how many each text has."""
        data, offsets = utf8(texts)
        firsts = self.piece_starts(data, offsets)
        places = np.append(firsts, len(data)).astype(np.int32)
        found = pa.Array.from_buffers(pa.string(), len(firsts), [None, pa.py_buffer(places), pa.py_buffer(data)])
        coded = pc.dictionary_encode(found)
        words = strings(coded.dictionary)
        if len(self.known) + len(words) > CACHED_PIECES:
            self.clear()
        numbers = np.fromiter(map(self.known.get, words, itertools.repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            numbers[new] = len(self.starts) + np.arange(len(new))  # the numbers that they are given now
            self.learn([words[i] for i in new.tolist()], coded.dictionary.take(pa.array(new)))
        return numbers[coded.indices.to_numpy()], np.diff(np.searchsorted(firsts, offsets))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each closed by the end id, and the number of ids of each text."""
        pieces, counts = self.pieces(texts)
        order = np.insert(pieces, np.cumsum(counts), 0)
        sizes = self.sizes[order]
        firsts = np.cumsum(counts + 1) - (counts + 1)
        return self.ids[ragged(self.starts[order], sizes)], np.add.reduceat(sizes, firsts)


def code_lengths(counts: np.ndarray, limit: int = LONGEST_CODE) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits, by package-merge; 0 for ids that do not occur.

    A list holds the ids by count; in each of ``limit`` rounds neighbours of the last list are packed in pairs and merged
    with the ids again. An id's length is the number of lists in which it is among the first items that the
    lightest 2n - 2 items of the last list consist of.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    limit = max(limit, (len(used) - 1).bit_length())
    if limit > TABLE_BITS:
        raise ValueError(f"codes are limited to {TABLE_BITS} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64 if counts.sum() > (1 << 62) // limit else np.int64)
    packages, singles = weights[:0], []
    for _ in range(limit):
        both = np.concatenate([weights, packages])
        merged = np.argsort(both, kind="stable")
        singles.append(merged < len(weights))
        pairs = both[merged][: len(merged) // 2 * 2]
        packages = pairs[::2] + pairs[1::2]
    taken, depth = 2 * len(weights) - 2, np.zeros(len(weights), np.int64)
    for single in reversed(singles):
        own = int(single[:taken].sum())
        depth[:own] += 1
        taken = 2 * (taken - own)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes, and the ids in order of their codes."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes, longest = np.zeros(len(lengths), np.uint64), int(lengths.max(initial=0))
    room = np.left_shift(np.uint64(1), (longest - lengths[order]).astype(np.uint64))  # of the longest codes, each code takes so many
    codes[order] = (np.cumsum(room) - room) >> (longest - lengths[order]).astype(np.uint64)
    return codes, order


def pack_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes of some ids one after the other, first bit highest, and the bit offset of every code."""
    sizes = lengths[ids]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    word, end = starts >> 6, (starts & 63) + sizes
    over = np.maximum(end - 64, 0)  # bits of a code that go on in the next word
    value = codes[ids]
    high = np.where(over > 0, value >> over.astype(np.uint64), value << np.maximum(64 - end, 0).astype(np.uint64))
    words = np.zeros(int(ends[-1] + 63 >> 6) if len(ends) else 0, np.uint64)
    if len(ids):
        firsts = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[firsts]] = np.bitwise_or.reduceat(high, firsts)
        split = np.flatnonzero(over)
        words[word[split] + 1] |= value[split] << (64 - over[split]).astype(np.uint64)
    return words.astype(">u8").tobytes(), starts


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For each number of as many bits as the longest code: the id it begins with, times 32, plus the code's length."""
    _, order = canonical_codes(lengths)
    longest = max(1, int(lengths.max(initial=0)))
    table = np.repeat(order * 32 + lengths[order], 1 << (longest - lengths[order]))
    return np.concatenate([table, np.zeros((1 << longest) - len(table), np.int64)]), longest


def unpack_bits(bits: bytes, n: int, checkpoints: np.ndarray, table: np.ndarray, longest: int) -> np.ndarray:
    """The ``n`` ids of a block; all parts between checkpoints advance by one id at a time."""
    raw = np.concatenate([np.frombuffer(bits, np.uint8), np.zeros(8, np.uint8)]).astype(np.uint32)
    windows = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    out = np.zeros((len(checkpoints), CHECKPOINT), np.uint32)
    at, end, mask = checkpoints.astype(np.int64), len(bits) * 8, (1 << longest) - 1
    for step in range(CHECKPOINT):
        found = table[windows[at >> 3] >> (32 - longest - (at & 7)).astype(np.uint32) & mask]
        out[:, step] = found >> 5
        at = np.minimum(at + (found & 31), end)  # the last part may be short; what it reads beyond is cut off
    return out.ravel()[:n]


def sources(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def id_type(tokenizer_file: str, end_id: int) -> str:
    """The shorter of two little-endian types that holds every id."""
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_file(tokenizer_file).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def tokenized(texts: DataFrame, tokenizer_file: str, end_id: int, width: str) -> DataFrame:
    """``(id, ids)`` of every text, in the order it is read, and at the end of each task a row of ``used, counts`` instead.

    Those are the ids that the task met, as 64-bit integers, and how often each occurred.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, total = PieceEncoder(tokenizer_file, end_id), np.zeros(1 << 16, np.int64)
        for batch in text_chunks(batches, limit=TEXT_BYTES):
            ids, sizes = encoder(batch.column("text"))
            total = added(total, np.bincount(ids))
            ids = ids.astype(width)
            places = np.concatenate([[0], np.cumsum(sizes) * ids.itemsize]).astype(np.int32)
            raw = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(places), pa.py_buffer(ids)])
            none = pa.nulls(len(sizes), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), raw, none, none], names=["id", "ids", "used", "counts"])
        used = np.flatnonzero(total)
        last = [pa.nulls(1, id_kind), pa.nulls(1, pa.binary()), *(pa.array([x.astype("<i8").tobytes()], pa.binary()) for x in (used, total[used]))]
        yield pa.RecordBatch.from_arrays(last, names=["id", "ids", "used", "counts"])

    id_kind = to_arrow_type(texts.schema["id"].dataType)
    return texts.mapInArrow(encode, f"id {texts.schema['id'].dataType.simpleString()}, ids binary, used binary, counts binary")


def added(total: np.ndarray, more: np.ndarray) -> np.ndarray:
    """The sum of two arrays of counts, as long as the longer one."""
    if len(more) > len(total):
        total = np.pad(total, (0, len(more) - len(total)))
    total[: len(more)] += more
    return total


def count_ids(rows: DataFrame, end_id: int) -> np.ndarray:
    """How often each id occurs, from the rows ``(used, counts)`` of tasks; a row for each id comes back."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for used, counts in zip(batch.column("used").to_pylist(), batch.column("counts").to_pylist()):
                ids = np.frombuffer(used, "<i8")
                more = np.zeros(int(ids.max(initial=-1)) + 1, np.int64)
                more[ids] = np.frombuffer(counts, "<i8")
                total = added(total, more)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    found = rows.mapInArrow(add, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in found), default=end_id) + 1, np.int64)
    for row in found:
        counts[row["id"]] = row["n"]
    return counts


def block_writer(width: str, code_of: Callable[[], tuple[np.ndarray, np.ndarray]], block_tokens: int):
    """A function for tasks: from ``shard, id, ids`` in order to blocks."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, lengths = code_of()
        shard, block, first = None, 0, 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            nonlocal block, first, held
            ids, sizes = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            bits, starts = pack_bits(ids, codes, lengths)
            row = [
                pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()), pa.array([len(ids)], pa.int64()),
                lists(pa.concat_arrays([h[0] for h in held]), np.array([len(sizes)])), lists(pa.array(sizes, pa.int64()), np.array([len(sizes)])),
                pa.array([starts[::CHECKPOINT].astype("<u8").tobytes()], pa.binary()), pa.array([bits], pa.binary()),
            ]
            block, first, held = block + 1, first + len(ids), []
            return pa.RecordBatch.from_arrays(row, names=["shard", "block", "first_token", "n_tokens", "docs", "lengths", "checkpoints", "bits"])

        for batch in batches:
            if not batch.num_rows:
                continue
            shard = batch.column("shard")[0].as_py()
            data, offsets = utf8(batch.column("ids"))
            ids, ends = data.view(width), offsets[1:] // np.dtype(width).itemsize
            sizes, at = np.diff(ends, prepend=0), 0
            while at < batch.num_rows:
                base = int(ends[at - 1]) if at else 0
                room = block_tokens - sum(len(h[1]) for h in held)
                to = min(batch.num_rows, int(np.searchsorted(ends, base + room)) + 1)  # with the document that fills the block
                held.append((batch.column("id").slice(at, to - at), ids[base : ends[to - 1]], sizes[at:to]))
                if ends[to - 1] - base >= room:
                    yield flush()
                at = to
        if held:
            yield flush()

    return write


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    longest_code: int = LONGEST_CODE,
    block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Write the token ids of all documents, each closed by ``end_id``, to a new folder in the format above.

    Documents are in ascending order of ``id_col``, null ids first, rows of equal ids in the order they are read; the
    order is dealt out by id and row, so a single id may have any number of rows. Null texts are empty: the end id
    alone. An empty table gives empty files. Other columns are left out. ``tokenizer_file`` must be a byte-level
    tokenizer without normalisation. Ids are counted and written out as they come, dealt out in order, and coded; a task
    holds a few megabytes of text and one block, or one document.
    """
    spark, texts, width = docs.sparkSession, sources(docs, id_col, text_col), id_type(tokenizer_file, end_id)
    plain = scratch_folder(spark, "plain-ids")
    numbered = tokenized(texts, tokenizer_file, end_id, width).withColumn("row", F.monotonically_increasing_id())
    numbered.write.option("compression", "zstd").parquet(plain)
    written = spark.read.schema(numbered.schema).parquet(plain)
    counts = count_ids(written.where("used is not null").select("used", "counts"), end_id)
    rows = written.where("used is null").select("id", "ids", "row")
    lengths = code_lengths(counts, longest_code)
    used = np.flatnonzero(lengths).tolist()
    codes = spark.createDataFrame([(i, int(lengths[i])) for i in used], "id bigint, length int")
    codes.coalesce(1).write.parquet(f"{folder}/codes")
    held = spark.sparkContext.broadcast((canonical_codes(lengths)[0], lengths))  # as long as the vocabulary

    ordered = rows.repartitionByRange("id", "row").sortWithinPartitions("id", "row")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"shard int, block int, first_token bigint, n_tokens bigint, docs array<{kind}>, lengths array<bigint>, checkpoints binary, bits binary"
    )
    write = block_writer(width, lambda: held.value, block_tokens)
    ordered.select(F.spark_partition_id().alias("shard"), "id", "ids").mapInArrow(write, schema).write.parquet(f"{folder}/blocks")

    sizes = spark.read.parquet(f"{folder}/blocks").groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()  # a row for each file
    before = np.cumsum([0, *(r["n"] for r in sizes)]).tolist()
    firsts = [(r["shard"], b) for r, b in zip(sizes, before)]
    spark.createDataFrame(firsts, "shard int, first_token bigint").coalesce(1).write.parquet(f"{folder}/shards")


def read_tokens(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col, start, n_tokens, ids`` of every document in a folder that ``write_tokens`` wrote.

    ``start`` counts the ids of all documents before, ``ids`` are unsigned 32-bit little-endian integers. Blocks are
    decoded independently: a task holds one at a time.
    """
    blocks = spark.read.parquet(f"{folder}/blocks")
    kind = blocks.schema["docs"].dataType.elementType.simpleString()
    codes = spark.read.parquet(f"{folder}/codes").collect()  # a row for each id of the vocabulary
    lengths = np.zeros(max((r["id"] for r in codes), default=0) + 1, np.int64)
    for row in codes:
        lengths[row["id"]] = row["length"]
    held = spark.sparkContext.broadcast(lengths)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, longest = decoding_table(held.value)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                n, sizes = row["n_tokens"].as_py(), row["lengths"].values.to_numpy().astype(np.int64)
                checkpoints = np.frombuffer(row["checkpoints"].as_buffer(), "<u8")
                ids = unpack_bits(row["bits"].as_buffer(), n, checkpoints, table, longest)
                ends = np.cumsum(sizes)
                raw = pa.Array.from_buffers(
                    pa.large_binary(), len(sizes),
                    [None, pa.py_buffer(np.concatenate([[0], ends * 4])), pa.py_buffer(ids.astype("<u4"))],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(sizes), row["shard"].as_py(), np.int32)), row["docs"].values,
                        pa.array(row["first_token"].as_py() + ends - sizes), pa.array(sizes), raw.cast(pa.binary()),
                    ],
                    names=["shard", "id", "place", "n_tokens", "ids"],
                )

    found = blocks.mapInArrow(decode, f"shard int, id {kind}, place bigint, n_tokens bigint, ids binary")
    shards = spark.read.parquet(f"{folder}/shards")
    placed = found.join(F.broadcast(shards), "shard")  # one short row for each file of the folder
    return placed.select(F.col("id").alias(id_col), (F.col("first_token") + F.col("place")).alias("start"), "n_tokens", "ids")
