"""Chunks by count or time on a live stream, by the clock or by the records' own times."""

from __future__ import annotations

import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

BY_COUNT, BY_TIME = "count", "time"
# Column of the records' times in microseconds; processors see no names that begin with an underscore.
_US = "chunk_time_us"


class _GroupWithin(StatefulProcessor):
    """Holds the number of the open chunk, its size and when it closes; rows are passed on at once.

    ``time_us`` names the column of the records' times; without one the clock counts. With ``closes`` a row is
    added when a chunk closes: its number, its size and why.
    """

    def __init__(self, n: int, wait_us: int, keys: list[str], columns: list[str], time_us: str | None, order: list[str], closes: bool):
        self.n, self.wait_us, self.keys, self.columns = n, wait_us, keys, columns
        self.time_us, self.order, self.closes = time_us, order, closes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        state = T.StructType(
            [T.StructField("chunk", T.LongType()), T.StructField("size", T.LongType()), T.StructField("closes_us", T.LongType())]
        )
        self.open = handle.getValueState("open", state)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs() * 1000
        chunk, size, closes = self.open.get() if self.open.exists() else (0, 0, 0)
        before, closed = closes if size else None, []
        if self.time_us is not None:  # times in order within the batch; those of later batches come later
            rows = iter([pd.concat(list(rows)).sort_values([self.time_us, *self.order], kind="stable")])
        for batch in rows:
            times = np.full(len(batch), now) if self.time_us is None else batch[self.time_us].to_numpy()
            numbers, places, at = np.empty(len(batch), np.int64), np.empty(len(batch), np.int64), 0
            while at < len(batch):
                if not size:
                    closes = int(times[at]) + self.wait_us
                end = min(at + self.n - size, int(np.searchsorted(times, closes)))
                numbers[at:end], places[at:end] = chunk, np.arange(size, size + max(end - at, 0))
                size, why = size + max(end - at, 0), BY_COUNT
                if size < self.n:
                    if end >= len(batch):
                        break
                    why = BY_TIME
                closed.append((chunk, size, why))
                chunk, size, at = chunk + 1, 0, max(end, at)
            out = batch[self.columns].copy()
            out["chunk_no"], out["place_in_chunk"] = numbers, places
            if self.closes:
                out["closed_by"] = None
            yield out
        if closed and self.closes:
            yield self._closed(key, closed)
        self._reset_timer(before, closes if size else None)
        self.open.update((chunk, size, closes))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.open.exists():
            chunk, size, closes = self.open.get()
            if size and self._timer(closes) <= expiredTimerInfo.getExpiryTimeInMs():
                self.open.update((chunk + 1, 0, 0))
                if self.closes:
                    yield self._closed(key, [(chunk, size, BY_TIME)])

    def _closed(self, key, closed: list[tuple[int, int, str]]) -> pd.DataFrame:
        out = pd.DataFrame({c: [None] * len(closed) for c in self.columns}, dtype=object)
        for name, value in zip(self.keys, key):
            out[name] = value
        out["chunk_no"], out["place_in_chunk"], out["closed_by"] = zip(*closed)
        return out

    @staticmethod
    def _timer(closes_us: int) -> int:
        return -(-closes_us // 1000)

    def _reset_timer(self, before, after):
        if before == after:
            return
        if before is not None:
            self.handle.deleteTimer(self._timer(before))
        if after is not None:
            self.handle.registerTimer(self._timer(after))

    def close(self) -> None:
        pass


def drain(query: StreamingQuery, seconds: float | None = None) -> bool:
    """Stop a query once it finds no new input; an empty source ends it at once. Says whether it got that far.

    With ``seconds`` it is stopped after that time even if input is left; without, however long it takes. A query with
    timers of the clock goes on running empty batches, so an ``availableNow`` trigger would not end it.
    """
    until, drained = None if seconds is None else time.monotonic() + seconds, not query.isActive
    while query.isActive:
        if until is not None and time.monotonic() >= until:
            break
        # after a restart the first batch may be one that was planned before, so one empty batch alone says nothing
        rows, status = [progress["numInputRows"] for progress in query.recentProgress], query.status
        if rows and rows[-1] == 0 and (any(rows) or len(rows) > 1):
            drained = True
            break
        if status["message"].startswith("Waiting for data") and not status["isDataAvailable"]:
            drained = True
            break
        time.sleep(0.2)
    query.stop()
    if query.exception() is not None:
        raise query.exception()
    return drained


def _chunked(sdf: DataFrame, processor: _GroupWithin, fields: list[T.StructField], keys: list[str], mode: str) -> DataFrame:
    added = [T.StructField("chunk_no", T.LongType()), T.StructField("place_in_chunk", T.LongType())]
    if processor.closes:
        added.append(T.StructField("closed_by", T.StringType()))
    return sdf.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=T.StructType([*fields, *added]), outputMode="Append", timeMode=mode
    )


def _fields(sdf: DataFrame) -> list[T.StructField]:
    return [T.StructField(f.name, f.dataType) for f in sdf.schema.fields]


def group_within_stream(sdf: DataFrame, n: int, wait_ms: int, keys: list[str], closes: bool = False) -> DataFrame:
    """Number the chunks of each key as its records arrive: adds ``chunk_no`` and ``place_in_chunk``.

    A chunk closes at ``n`` records or ``wait_ms`` of processing time after its first. Only three
    numbers are kept per key; records are passed on, not held. With ``closes`` a row more tells that a chunk closed, as soon as
    it does: the key, the chunk's number, its size in ``place_in_chunk`` and 'count' or 'time' in ``closed_by``, which is null for
    records. ``keys`` should include what spreads a hot stream, such as the shard: like consumers of one stream, each key
    chunks for itself. Needs the RocksDB state store.
    """
    processor = _GroupWithin(n, wait_ms * 1000, keys, sdf.columns, None, [], closes)
    return _chunked(sdf, processor, _fields(sdf), keys, "ProcessingTime")


def group_within_event_time(
    sdf: DataFrame, n: int, wait_us: int, keys: list[str], time: str, order: list[str] = [], closes: bool = False  # noqa: B006
) -> DataFrame:
    """The same by the records' own times: what ``operators.batching.group_within`` makes of all records at once.

    ``time`` is a timestamp column; records come in its order, batch after batch, and by ``order`` within one time. Records that are
    earlier than the newest of the batches before are late, and dropped. A chunk that time closes does so when the stream's
    newest time has come to its end.
    """
    fields, columns = _fields(sdf), sdf.columns
    timed = sdf.withColumn(_US, F.unix_micros(time)).withWatermark(time, "0 seconds")
    return _chunked(timed, _GroupWithin(n, wait_us, keys, columns, _US, order, closes), fields, keys, "EventTime")
