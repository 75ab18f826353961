"""Batches under simultaneous limits, chunks by count or elapsed time, and their totals."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Limits
from .ordering import with_ordinal
from .scan import assign_chunks

PUT = ["stream_name", "put_id"]


class OpenBatch:
    """The newest batch of a put: totals, and totals per shard. The first record is never refused."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.clear()

    def start(self, key):
        self.clear()

    def clear(self):
        self.rows = deque()
        self.n_bytes = 0
        self.shards = {}

    def fits(self, row):
        shard, size = row
        limits = self.limits
        if len(self.rows) >= limits.max_request_records or self.n_bytes + size > limits.max_request_bytes:
            return False
        held = self.shards.get(shard)
        return held is None or (
            held[0] < limits.max_shard_records and held[1] + size <= limits.max_shard_bytes
        )

    def push(self, row):
        shard, size = row
        self.rows.append(row)
        self.n_bytes += size
        records, n_bytes = self.shards.get(shard, (0, 0))
        self.shards[shard] = (records + 1, n_bytes + size)
        return records

    def drop_first(self):
        shard, size = self.rows.popleft()
        self.n_bytes -= size
        records, n_bytes = self.shards[shard]
        if records == 1:
            del self.shards[shard]
        else:
            self.shards[shard] = (records - 1, n_bytes - size)
        return len(self.rows)


class OpenChunk:
    """A chunk that closes at ``n`` records, or once ``wait`` has passed since its first record."""

    def __init__(self, n: int, wait: int):
        self.n, self.wait = n, wait
        self.clear()

    def start(self, key):
        self.clear()

    def clear(self):
        self.times = deque()

    def fits(self, row):
        return len(self.times) < self.n and row[0] < self.times[0] + self.wait

    def push(self, row):
        self.times.append(row[0])
        return len(self.times) - 1

    def drop_first(self):
        self.times.popleft()
        return len(self.times)


def assign_batches(
    df: DataFrame,
    limits: Limits = Limits(),
    keys: list[str] = PUT,
    order: tuple[str, ...] = ("seq_in_put",),
    size: str = "n_bytes",
    group_rows: int | None = None,
    largest: int | None = None,
) -> DataFrame:
    """Add ``batch_no`` and ``request_index`` (the record's index among its shard's records of the batch).

    A put's records are walked in order (``order`` must be unique in a put); a record joins the open
    batch if the counts and bytes of the batch and of its shard in the batch stay within the limits.
    Each (batch, shard) is one request. The per-shard limits apply per batch; no clock is involved.
    """
    return assign_chunks(
        df,
        list(keys),
        list(order),
        ["shard_id", size],
        lambda: OpenBatch(limits),
        longest=limits.max_request_records,
        number="batch_no",
        place="request_index",
        place_by=["shard_id"],
        group_rows=group_rows,
        largest=largest,
    )


def with_request_index(df: DataFrame, order: tuple[str, ...] = ("seq_in_put",)) -> DataFrame:
    """Index of each record inside its request. A request holds at most one batch, so the window is bounded."""
    request = Window.partitionBy(*PUT, "batch_no", "shard_id").orderBy(*order)
    return df.withColumn("request_index", F.row_number().over(request).cast("bigint") - 1)


def batch_summary(batched: DataFrame) -> DataFrame:
    """Records and bytes of every request."""
    return batched.groupBy(*PUT, "batch_no", "shard_id").agg(
        F.count("*").alias("n_records"), F.sum("n_bytes").alias("n_bytes")
    )


def group_within(
    df: DataFrame,
    n: int,
    wait_us: int,
    keys: list[str],
    order: list[str],
    time_us: str,
    group_rows: int | None = None,
    largest: int | None = None,
) -> DataFrame:
    """Add ``chunk_no`` and ``place_in_chunk``: a chunk closes at ``n`` records or ``wait_us`` after its first.

    ``time_us`` is a bigint column of microseconds. A record exactly ``wait_us`` after the first opens
    a new chunk.
    """
    return assign_chunks(
        df,
        keys,
        order,
        [time_us],
        lambda: OpenChunk(n, wait_us),
        longest=n,
        number="chunk_no",
        place="place_in_chunk",
        place_by=[],
        group_rows=group_rows,
        largest=largest,
    )


def chunk_puts(df: DataFrame, n: int, keys: list[str], order: list[str]) -> DataFrame:
    """Cut a bulk load into puts of ``n`` records: adds ``put_id`` and ``seq_in_put`` per group."""
    numbered = with_ordinal(df, keys, order, "__at")
    return numbered.withColumns(
        {"put_id": F.expr(f"__at div {n}"), "seq_in_put": F.expr(f"CAST(__at % {n} AS INT)")}
    ).drop("__at")
