"""Arrow record batches inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20


def release() -> None:
    """Give memory that is free inside this process back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim:
        trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, a function for tasks that ends by giving its memory back.

    A worker waits for further tasks, and others start beside it; what it keeps of a task counts against its executor.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def released_group(run: Callable[[pa.Table], pa.Table]):
    """The same for a function of one group of rows, after each group."""

    def whole(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            release()

    return whole


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut by rows so that a part holds about ``limit`` bytes of text, or one row; null texts are empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column).cast(pa.string()).fill_null("")
        batch = batch.set_column(batch.schema.get_field_index(column), column, texts)
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows in them."""
    texts = pa.concat_arrays([texts])  # a slice becomes an array of its own
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    data = texts.buffers()[2]
    every = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return every[offsets[0] : offsets[-1]], offsets - offsets[0]


def strings(texts: pa.Array) -> list[str]:
    """A text column without nulls as a list; ``to_pylist`` makes a scalar of each text on the way."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``start, start + 1, ...`` of several runs, one after the other."""
    total = int(lengths.sum())
    firsts = np.cumsum(lengths) - lengths
    return np.repeat(starts - firsts, lengths) + np.arange(total)


def lists(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    """A list column from its flat values and the length of each list."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values)


def unused(name: str, taken: Iterable[str]) -> str:
    """A column name that is not taken, whatever the case of its letters."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name
