"""What a task leaves behind in its worker."""

from __future__ import annotations

import re
from pathlib import Path

import numpy as np
import pyarrow as pa

from sitefacts.llm.batches import released, released_group


def held_mb() -> float:
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def test_memory_goes_back_after_a_task(monkeypatch):
    calls = []
    monkeypatch.setattr("sitefacts.llm.batches.release", lambda: calls.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2])], names=["id"])
    assert list(released(lambda batches: (b.slice(1) for b in batches))(iter([batch]))) == [batch.slice(1)] and len(calls) == 1
    begun = released(lambda batches: iter([batch, batch]))(iter([batch]))
    next(begun)
    begun.close()  # a limit above ends a task early
    assert len(calls) == 2
    table = pa.table({"id": [1]})
    assert released_group(lambda t: t.append_column("n", pa.array([2])))(table).num_columns == 2 and len(calls) == 3


def test_what_a_task_kept_is_given_back():
    def run(batches):
        cache = {str(i) * 10: np.zeros(1) for i in range(300_000)}
        for batch in batches:
            yield batch
        assert len(cache) == 300_000

    batch = pa.RecordBatch.from_arrays([pa.array([1])], names=["id"])
    before = held_mb()
    running = released(run)(iter([batch]))
    next(running)
    most = held_mb()
    assert list(running) == []
    assert most - before > 40 and held_mb() - before < 0.5 * (most - before)
