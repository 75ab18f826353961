"""What a task holds at once and what a worker process keeps stay small, whatever the batches' size."""

import re
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from shardstream.llm import packing, quality
from shardstream.llm.words import give_back, runs_of_bytes, small_batches


def own_megabytes() -> float:
    return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


def test_batches_are_taken_in_slices():
    texts = ["ab" * (50 * i) for i in range(1, 200)] + [None, "", "x" * 500_000, None, "é"]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    parts = list(small_batches([batch], 1, most=100_000))
    assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
    assert len(parts) > 10 and all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column(1).to_pylist()) <= 100_000 for p in parts)
    nulls = pa.array([None, None], pa.string())
    assert list(runs_of_bytes(nulls, 10)) == [(0, 2)] and list(small_batches([batch.slice(0, 0)], 1)) == []


def test_neighbours_come_in_small_arrays():
    texts = [b"a b c d " * 100_000] * 2
    made = list(quality._neighbours(quality.Terms(), texts))
    assert sum(len(c) for c, _ in made) == 2 * 2 * 2 * (400_000 - 1)
    assert max(len(c) for c, _ in made) <= 4 * (1 << 18)


def test_vocabulary_is_bounded_and_forgotten():
    path = packing.vocabulary_path()
    known, made = packing.Vocabulary.of_process(path), np.random.default_rng(3)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    per_run = 40_000
    for _ in range(8):
        words = letters[made.integers(0, 26, (per_run, 9))]
        text = b" ".join(w.tobytes() for w in words)
        first = known.encoded(pa.array([text], pa.binary()))
    assert len(known.ids) + len(known.older) <= 2 * (packing.MEMO_WORDS + per_run)
    packing.Vocabulary.forget()
    assert packing.PROCESS_MODULE not in sys.modules
    packing.Vocabulary.forget()
    assert packing.Vocabulary.of_process(path).encoded(pa.array([text], pa.binary())) == first
    packing.Vocabulary.forget()


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_free_memory_is_given_back():
    pinned, held = [], []
    for _ in range(6_000):  # pieces between others that stay keep the system's allocator from shrinking by itself
        held.append(np.empty(2_000, np.float64))
        held[-1][:] = 1
        pinned.append(np.ones(70))
    before = own_megabytes()
    held.clear()
    give_back()
    assert own_megabytes() < before - 40
