"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned over every document."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .words import alnum_words, map_batches, pass_over, small_batches, text_bytes

WINDOW = 13
# Bytes of benchmark text that one broadcast may hold; a larger benchmark is scanned in slices, one pass after another.
SLICE_BYTES = 32 << 20
_SIEVE_BITS = 20


@dataclass
class Windows:
    """The distinct windows of one slice of the benchmark, by length, over numbered words."""

    words: dict[bytes, int] = field(default_factory=dict)
    items: dict[int, dict[bytes, set[str]]] = field(default_factory=dict)
    hashes: dict[int, np.ndarray] = field(default_factory=dict)
    sieves: dict[int, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def of(rows: list[tuple[str | None, bytes]], window: int) -> "Windows":
        out = Windows()
        for item, data in rows:
            numbered = [out.words.setdefault(w, len(out.words)) for w in alnum_words(data)]
            if not numbered:
                continue
            ids, size = np.array(numbered, np.int32), min(window, len(numbered))
            found = out.items.setdefault(size, {})
            for at in range(len(ids) - size + 1):
                found.setdefault(ids[at : at + size].tobytes(), set()).update(() if item is None else (item,))
        for size, found in out.items.items():
            table = np.frombuffer(b"".join(found), np.int32).reshape(-1, size)
            out.hashes[size] = np.unique(_hash(table.T))
            out.sieves[size] = np.zeros(1 << _SIEVE_BITS, bool)
            out.sieves[size][out.hashes[size] >> np.uint64(64 - _SIEVE_BITS)] = True
        return out

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie in an occurrence of a window, and the items whose windows occur."""
        hit, seen = np.zeros(len(words) + 1, np.int64), set()
        ids = np.fromiter((self.words.get(w, -1) for w in words), np.int32, len(words))
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        for size, found in self.items.items():
            n = len(ids) - size + 1
            if n <= 0:
                continue
            whole = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(whole):
                continue
            hashes = _hash([ids[whole + j] for j in range(size)])
            maybe = self.sieves[size][hashes >> np.uint64(64 - _SIEVE_BITS)]
            whole, hashes = whole[maybe], hashes[maybe]
            for at in whole[np.isin(hashes, self.hashes[size])].tolist():
                items = found.get(ids[at : at + size].tobytes())  # the words themselves decide
                if items is not None:
                    hit[at] += 1
                    hit[at + size] -= 1
                    seen |= items
        return np.cumsum(hit[:-1]) > 0, seen


def _hash(columns) -> np.ndarray:
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = (out + c.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _slices(benchmark: DataFrame, window: int, slice_bytes: int) -> Iterator[tuple[Windows, bool]]:
    """The benchmark's windows, slice by slice, and whether it is the last; each holds about ``slice_bytes`` of distinct texts at most."""
    narrow = materialize(benchmark.select(F.col("item_id").cast("string").alias("item"), text_bytes().alias("data")).distinct())
    total = narrow.agg(F.sum(F.length("data"))).first()[0] or 0
    parts = max(-(-total // slice_bytes), 1)
    at = F.pmod(F.xxhash64("item", "data"), F.lit(parts))
    for p in range(parts):
        yield Windows.of([(r[0], bytes(r[1])) for r in narrow.filter(at == p).collect()], window), p == parts - 1


def _marks(spans: list) -> list[tuple[int, int]]:
    return [(s["start"], s["end"]) for s in spans or []]


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Hits of benchmark windows in every document: doc_id, n_words, n_hit, items, spans (of word numbers).

    A window is ``window`` consecutive words of an item, or all words of a shorter item; items without
    words have none. A word is hit if it lies in any occurrence of a window. Documents are not shuffled: each slice of
    the benchmark is broadcast and the documents stream past it; what a slice but the last finds is stored. Null or empty texts have no words and
    no hits; equal rows are judged alike, row by row; items without an id mark words but are not
    listed; an empty benchmark hits nothing. Other columns of either table are not looked at.
    """
    spark = docs.sparkSession
    schema = "doc_id void, data binary, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"
    out = docs.select(
        "doc_id", text_bytes().alias("data"), F.lit(None).cast("array<string>").alias("items"),
        F.lit(None).cast("array<struct<start:long,end:long>>").alias("spans"),
    )
    for windows, last in _slices(benchmark, window, slice_bytes):
        shared = spark.sparkContext.broadcast(windows)

        def run(parts, shared=shared, last=last):
            for part in parts:
                counts, hits, listed, spans = [], [], [], []
                datas = part["data"].to_pylist()
                for data, items, marks in zip(datas, part["items"].to_pylist(), part["spans"].to_pylist()):
                    words = alnum_words(data)
                    hit, seen = shared.value.scan(words)
                    for start, end in _marks(marks):
                        hit[start:end] = True
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
                    counts.append(len(words))
                    hits.append(int(hit.sum()))
                    listed.append(sorted(seen.union(items or ())))
                    spans.append([{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
                data = pa.array([b""] * len(datas), pa.binary()) if last else part["data"]
                yield {"doc_id": part["doc_id"], "data": data, "n_words": counts, "n_hit": hits, "items": listed, "spans": spans}

        columns = {c: F.col(c) for c in ("doc_id", "data", "items", "spans")}
        out = pass_over(out, columns, schema, run)
        if not last:  # one slice at a time is held by workers
            out = materialize(out)
            shared.unpersist()
    return out.drop("data")


def contaminated(percent: int = 5):
    """The rule on a scan's columns: some word is hit, and at least ``percent`` in a hundred are."""
    return (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, percent: int = 5, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The documents that are not contaminated, with all their columns as they were.

    Rows are judged by their text; null and empty texts stay. No shuffle: the scan runs inside a pass
    that keeps or drops whole rows; a benchmark of several slices takes a stored pass for each but the last.
    """
    spark, out, at = docs.sparkSession, docs, docs.columns.index("text")
    marked = T.StructType([*docs.schema.fields, T.StructField("__hits", T.BinaryType())])
    for windows, last in _slices(benchmark, window, slice_bytes):
        shared = spark.sparkContext.broadcast(windows)

        def run(batches, shared=shared, last=last, width=len(docs.columns)):
            for batch in small_batches(batches, at):
                keep, hits = [], []
                before = batch.column(width).to_pylist() if batch.num_columns > width else [None] * batch.num_rows
                for text, earlier in zip(batch.column(at).to_pylist(), before):
                    words = alnum_words((text or "").encode())
                    hit = shared.value.scan(words)[0]
                    if earlier:
                        hit |= np.unpackbits(np.frombuffer(earlier, np.uint8), count=len(words)).astype(bool)
                    n = int(hit.sum())
                    keep.append(not (n and 100 * n >= percent * len(words)))  # later slices only add hits
                    hits.append(None if last or not n else np.packbits(hit).tobytes())
                columns, names = batch.columns[:width], batch.schema.names[:width]
                if not last:
                    columns, names = [*columns, pa.array(hits, pa.binary())], [*names, "__hits"]
                yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep, pa.bool_()))

        out = map_batches(out, run, docs.schema if last else marked)
        if not last:  # one slice at a time is held by workers
            out = materialize(out)
            shared.unpersist()
    return out
