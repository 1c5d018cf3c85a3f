"""Exact deduplication over an extendible-hash index in shared files.

Scan tasks merge equal texts of their own rows and write entries (hash key, text, document ids) to the shared folder.
A directory over the leading bits of the key doubles until its buckets fit a size; owner tasks then stream their key
ranges in order, chain texts of equal keys, and compare their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitefacts.plans.scratch import staged

SPACES = "[\\x20\\x09-\\x0D]+"
BUCKET_BYTES = 32 << 20
MAX_DEPTH = 16  # bounds the directory to 65,536 places; fuller buckets at this depth are streamed all the same
MERGE_BYTES = 32 << 20  # text a scan task holds before it writes its entries


def scan_entries(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Entries ``(entry, h, text, digest, ids)``: the equal texts of a task's rows as one, ids in order, nulls last."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 33, {}, 0
        schema = pa.schema([("entry", pa.int64()), ("h", pa.int64()), ("text", pa.string()), ("digest", pa.string()),
                            ("ids", pa.list_(pa.int64()))])

        def entries() -> Iterator[pa.RecordBatch]:
            nonlocal number
            rows = list(held.items())
            for at in range(0, len(rows), 4000):
                part = rows[at : at + 4000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(number, number + len(part))),
                        pa.array([v[0] for _, v in part], pa.int64()),
                        pa.array([t for t, _ in part], pa.string()),
                        pa.array([v[1] for _, v in part], pa.string()),
                        pa.array([sorted(v[2], key=lambda i: (i is None, i)) for _, v in part], pa.list_(pa.int64())),
                    ],
                    schema=schema,
                )
                number += len(part)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("id", "h", "text", "digest"))
            for doc, h, text, digest in zip(*columns):
                entry = held.get(text)
                if entry is None:
                    held[text] = (h, digest, [doc])
                    size += len(text) + 200
                else:
                    entry[2].append(doc)
                    size += 8
            if size > MERGE_BYTES:
                yield from entries()
                held, size = {}, 0
        yield from entries()

    norm = F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), SPACES, " ")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), norm.alias("text"))
    return rows.select("id", "text", F.xxhash64("text").alias("h"), F.sha2("text", 256).alias("digest")).mapInArrow(
        merge, "entry bigint, h bigint, text string, digest string, ids array<bigint>"
    )


def split_directory(sizes: np.ndarray, capacity: int) -> list[int]:
    """Bucket of each place of the directory.

    ``sizes`` holds the bytes under each of the 2**depth leading-bit patterns of the keys. The directory starts with
    one place; while a bucket is overfull its pattern is split by one more bit, and the directory doubles when that
    bucket already used all its bits.
    """
    deepest = len(sizes).bit_length() - 1
    sums = np.concatenate([[0], np.cumsum(sizes)])

    def load(prefix: int, depth: int) -> int:
        width = len(sizes) >> depth
        return int(sums[(prefix + 1) * width] - sums[prefix * width])

    depth, open_buckets, final = 0, [(0, 0)], []
    while open_buckets:
        prefix, local = open_buckets.pop()
        if local == deepest or load(prefix, local) <= capacity:
            final.append((prefix, local))
            continue
        depth = max(depth, local + 1)  # the directory doubles
        open_buckets += [(2 * prefix, local + 1), (2 * prefix + 1, local + 1)]
    places = [0] * (1 << depth)
    for number, (prefix, local) in enumerate(sorted(final, key=lambda b: b[0] / (1 << b[1]))):
        width = 1 << (depth - local)
        places[prefix * width : (prefix + 1) * width] = [number] * width
    return places


def leading_bits(depth: int):
    return F.shiftrightunsigned("h", 64 - depth).cast("int") if depth else F.lit(0)


def directory(entries: DataFrame, capacity: int, max_depth: int) -> tuple[list[int], int]:
    """The directory over the entries, and its depth."""
    loads = entries.groupBy(leading_bits(max_depth).alias("p")).agg(F.sum(F.octet_length("text") + 64).alias("n")).collect()
    sizes = np.zeros(1 << max_depth, np.int64)
    for row in loads:
        sizes[row["p"]] = row["n"]
    places = split_directory(sizes, capacity)
    return places, len(places).bit_length() - 1


def own_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of equal texts among entries in key order; a chain holds one text per group of the current key."""
    key, chain = None, {}

    def closed() -> tuple[list, list, list, list]:
        out: tuple[list, list, list, list] = ([], [], [], [])
        for members in chain.values():
            _, keep, holder = min(((first is None, first or 0, entry) for entry, first, _ in members))
            nulls = all(first is None for _, first, _ in members)
            total = sum(n for _, _, n in members)
            for entry, _, _ in members:
                for column, value in zip(out, (entry, None if nulls else keep, total, entry == holder)):
                    column.append(value)
        return out

    def batch_of(columns) -> pa.RecordBatch:
        kinds = (("entry", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("holds", pa.bool_()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], names=[n for n, _ in kinds])

    ready: list[list] = [[], [], [], []]
    for batch in batches:
        for entry, h, text, first, n in zip(*(batch.column(c).to_pylist() for c in ("entry", "h", "text", "first", "n"))):
            if h != key:
                for column, values in zip(ready, closed()):
                    column += values
                key, chain = h, {}
            chain.setdefault(text.encode(), []).append((entry, first, n))  # equal only if all bytes are
        if len(ready[0]) >= 10_000:
            yield batch_of(ready)
            ready = [[], [], [], []]
    for column, values in zip(ready, closed()):
        column += values
    yield batch_of(ready)


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
    max_depth: int = MAX_DEPTH,
) -> DataFrame:
    """One row per document: ``id_col, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after each run of ASCII white space becomes one space; null is the empty text. The
    smallest id of a group stays. Of repeated rows with that id exactly one has ``kept``. Null ids sort last; a group
    of null ids only keeps one of them and has a null ``keep_id``. Other columns play no part. A text that a third of
    all rows hold reaches its owner once per merged scan part, and its ids never do: they stay in the entry files and
    are joined by entry.
    """
    spark: SparkSession = docs.sparkSession
    entries = staged(scan_entries(docs, id_col, text_col), "exact-entries")
    places, depth = directory(entries, bucket_bytes, max_depth)
    table = F.broadcast(spark.createDataFrame(list(enumerate(places)), "place int, bucket int"))  # at most 2**max_depth rows
    owned = (
        entries.select("entry", "h", "text", F.get("ids", F.lit(0)).alias("first"), F.size("ids").cast("bigint").alias("n"), leading_bits(depth).alias("place"))
        .join(table, "place").drop("place")
        .repartition("bucket").sortWithinPartitions("h")
        .select("entry", "h", "text", "first", "n")
    )
    groups = owned.mapInArrow(own_ranges, "entry bigint, keep_id bigint, group_size bigint, holds boolean")
    rows = entries.select("entry", "digest", "ids").join(groups, "entry").select(
        "keep_id", "group_size", "holds", "digest", F.posexplode("ids").alias("at", "id")
    )
    return rows.select(
        F.col("id").alias(id_col), "keep_id", "group_size", (F.col("holds") & (F.col("at") == 0)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
