"""Words, shingles and Arrow passes shared by the operators on texts."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
LOWERED = bytes.maketrans(UPPER, LOWER)


def _word_table() -> bytes:
    """Bytes of words [0-9a-z] and of non-ASCII characters stay, A-Z become lower case, all others a space."""
    keep = set(b"0123456789" + LOWER) | set(range(0x80, 0x100))
    return bytes(b if b in keep else 0x20 for b in LOWERED)


WORDS = _word_table()
# Words that a task remembers; more are looked up anew.
MEMO_WORDS = 1 << 18


def alnum_words(data: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` in UTF-8 bytes."""
    return data.translate(WORDS).split()


def spaced_words(data: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words between ASCII white space (``[^\\x20\\x09-\\x0D]+``) in UTF-8 bytes."""
    return data.translate(LOWERED).split()


class WordHashes(dict):
    """A 64-bit hash for each word, remembered while it stays small."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > MEMO_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: nearby values come out far apart."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of k values, in order."""
    n = len(hashes) - k + 1
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = out * _MIX + hashes[j : j + n]
    return mixed(out)


def shingle_set(words: list[bytes], k: int, memo: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; fewer words than k are one shingle, none are no shingle."""
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(rolling(memo.of(words), min(k, len(words))))


def give_back() -> None:
    """Hand memory that is free back to the system: a worker process outlives its tasks and would hold on to what they freed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim:
        trim(0)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` whose tasks hand back their memory when they are done."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return df.mapInArrow(tidy, schema)


def pass_over(
    df: DataFrame, columns: dict[str, Column], added: str, fn: Callable[[Iterator[dict[str, pa.Array]]], Iterable[dict]],
) -> DataFrame:
    """Run ``fn`` over Arrow batches of the given columns; it yields dicts of columns of the result.

    ``added`` is the schema of the columns that fn makes; a column of the result with the name of an
    input keeps that input's type. ``fn`` gets an iterator of dicts of Arrow arrays, so it can carry
    state from batch to batch and say something at the end.
    """
    narrow = df.select(*[c.alias(name) for name, c in columns.items()])
    kept = {f.name: f for f in narrow.schema.fields}
    made = T.StructType.fromDDL(added) if isinstance(added, str) else added
    schema = T.StructType([kept.get(f.name, f) if f.dataType == T.NullType() else f for f in made.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (dict(zip(b.schema.names, b.columns)) for b in batches if b.num_rows)
        for part in fn(parts):
            yield pa.RecordBatch.from_arrays([_as_array(part[f.name], f.type) for f in arrow], schema=arrow)

    return map_batches(narrow, run, schema)


def _as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, kind)


def runs_of_bytes(data: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """(start, stop) of runs of rows of about ``most`` bytes; a longer row is a run of its own, nulls have no bytes."""
    at, ends = 0, np.cumsum(pc.fill_null(pc.binary_length(data), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    while at < len(data):
        done = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, done + most)))
        yield at, min(end, len(data))
        at = end


def some_at_a_time(data: pa.Array, *others: pa.Array, most: int = 2 << 20) -> Iterator[tuple[list, ...]]:
    """The rows of a batch as lists, in runs of about ``most`` bytes: the words of a whole batch would take much memory."""
    for at, end in runs_of_bytes(data, most):
        yield tuple(a[at:end].to_pylist() for a in (data, *others))


def small_batches(batches: Iterable[pa.RecordBatch], at: int, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of batches with about ``most`` bytes in column ``at``: what is made of a slice is gone before the next comes."""
    for batch in batches:
        for start, stop in runs_of_bytes(batch.column(at), most):
            yield batch.slice(start, stop - start)


def text_bytes(name: str = "text") -> Column:
    """The text as UTF-8 bytes; null as empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))


def hashed_fold(column: str, folds: int) -> Column:
    """crc32 of an id's text, modulo folds; null ids fall into the fold of the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds
