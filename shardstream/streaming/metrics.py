"""Metrics on live streams: cumulative series exported every so often, totals of trailing windows, records not completed yet."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.metrics import DATUM_NAMESPACE, DATUMS_PER_REQUEST, POINT, to_datums
from ..sources.datums import write_datums

EXPORT_S = 60
ENQUEUED, COMPLETED = "enqueued", "completed"

_PARTS = ("value", "min", "max", "sum", "count")
_PARTIAL = "value double, min double, max double, sum double, count long"


def _merged(a: tuple | None, b: tuple) -> tuple:
    """Two partial points of a series; a part that neither has stays null."""
    if a is None:
        return b
    how = {"min": min, "max": max}
    both = zip(_PARTS, a, b)
    return tuple(x if y is None else y if x is None else how.get(name, lambda p, q: p + q)(x, y) for name, x, y in both)


def _plain(value):
    return None if value is None or pd.isna(value) else value.item() if hasattr(value, "item") else value


def _partials(rows: pd.DataFrame, by: np.ndarray) -> Iterator[tuple[int, tuple]]:
    """Rows of points combined by a number each."""
    groups = rows.groupby(by, sort=True)
    sums = groups[["value", "sum", "count"]].sum(min_count=1)
    low, high = groups["min"].min(), groups["max"].max()
    for at in sums.index:
        count = _plain(sums.loc[at, "count"])
        yield int(at), (_plain(sums.loc[at, "value"]), _plain(low[at]), _plain(high[at]), _plain(sums.loc[at, "sum"]), None if count is None else int(count))


class _Cumulative(StatefulProcessor):
    """What a series came to up to the last export, and what has come since, by export."""

    def __init__(self, tick_ms: int):
        self.tick_ms, self.partial, self.at = tick_ms, T.StructType.fromDDL(_PARTIAL), T.StructType.fromDDL("at_ms long")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", self.partial)
        self.ticks = handle.getMapState("ticks", self.at, self.partial)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        points = pd.concat(list(rows))
        passed = timerValues.getCurrentWatermarkInMs()
        for tick, partial in _partials(points, points["ts_ns"].to_numpy() // (self.tick_ms * 1_000_000) + 1):
            at = tick * self.tick_ms
            if at <= passed:  # exported already: counts from the next export on
                self.total.update(_merged(self.total.get() if self.total.exists() else None, partial))
            elif self.ticks.containsKey((at,)):
                self.ticks.updateValue((at,), _merged(tuple(self.ticks.getValue((at,))), partial))
            else:
                self.ticks.updateValue((at,), partial)
                self.handle.registerTimer(at)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Timers of a series go off in their order."""
        at = expiredTimerInfo.getExpiryTimeInMs()
        if not self.ticks.containsKey((at,)):
            return
        total = _merged(tuple(self.total.get()) if self.total.exists() else None, tuple(self.ticks.getValue((at,))))
        self.total.update(total)
        self.ticks.removeKey((at,))
        yield pd.DataFrame([[*key, at * 1_000_000, *total]], columns=[*_SERIES, "ts_ns", *_PARTS])

    def close(self) -> None:
        pass


_SERIES = ["metric", "unit", "kind", "dims"]


def _dims() -> Column:
    """Attributes in one text, alike for equal attributes."""
    return F.to_json(F.array_sort(F.map_entries("attributes"))).alias("dims")


def _timed(points: DataFrame, *extra: Column) -> DataFrame:
    return points.select(*extra, *POINT[:3], _dims(), "ts_ns", *_PARTS, F.timestamp_micros(F.expr("ts_ns div 1000")).alias("at")).withWatermark("at", "0 seconds")


def cumulative_points_stream(points: DataFrame, tick_ms: int = EXPORT_S * 1000) -> DataFrame:
    """Points of single events summed from the start up to the end of each export, given when the stream's time has come to it.

    What ``operators.metrics.cumulative_points`` makes of all points at once: an export has the series that changed since the
    last. Kept for each series: its sums so far, and those of exports that are still to come. Points come in the order of time, batch after
    batch; the last exports wait for a later point of any series. Needs the RocksDB state store.
    """
    made = _timed(points).groupBy(*_SERIES).transformWithStateInPandas(
        statefulProcessor=_Cumulative(tick_ms),
        outputStructType=T.StructType.fromDDL(f"metric string, unit string, kind string, dims string, ts_ns long, {_PARTIAL}"),
        outputMode="Append",
        timeMode="EventTime",
    )
    entries = F.from_json("dims", "array<struct<key:string,value:string>>")
    return made.select("metric", "unit", "kind", F.map_from_entries(entries).alias("attributes"), "ts_ns", *_PARTS)


def export_stream(
    points: DataFrame, path: str, checkpoint_location: str, tick_ms: int = EXPORT_S * 1000, namespace: str = DATUM_NAMESPACE,
    per_request: int = DATUMS_PER_REQUEST, trigger: dict | None = None,
) -> StreamingQuery:
    """Export a stream's metrics as numbered requests of datums, every ``tick_ms`` of its time.

    All series of an export come in one batch, which has a folder of its own: a batch that is run again writes the same
    requests in the same place.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_datums(to_datums(batch), f"{path}/batch={batch_id}", namespace, "overwrite", per_request)

    writer = cumulative_points_stream(points, tick_ms).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_location)
    return writer.trigger(**(trigger or {"processingTime": f"{EXPORT_S} seconds"})).start()


class _Windows(StatefulProcessor):
    """Panes of a series that a window still reaches, and what all came to. Wakes at the next pane's end while there are any."""

    def __init__(self, pane_ms: int, windows: list[int]):
        self.pane_ms, self.windows = pane_ms, windows
        self.ends, self.partial = T.StructType.fromDDL("ends long"), T.StructType.fromDDL(_PARTIAL)
        self.whole = T.StructType.fromDDL(f"upto long, timer long, {_PARTIAL}")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", self.ends, self.partial)
        self.total = handle.getValueState("total", self.whole)

    def _load(self) -> tuple[int, int | None, tuple | None]:
        upto, timer, *parts = self.total.get() if self.total.exists() else (0, None, *[None] * len(_PARTS))
        return upto, timer, None if all(p is None for p in parts) else tuple(parts)

    def _store(self, upto: int, timer: int | None, total: tuple | None) -> None:
        self.total.update((upto, timer, *(total or [None] * len(_PARTS))))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        points = pd.concat(list(rows))
        upto, timer, total = self._load()
        for pane, partial in _partials(points, -(-points["ts_ns"].to_numpy() // (self.pane_ms * 1_000_000))):
            ends = (pane * self.pane_ms,)
            held = tuple(self.panes.getValue(ends)) if self.panes.containsKey(ends) else None
            self.panes.updateValue(ends, _merged(held, partial))
            if ends[0] <= upto:
                total = _merged(total, partial)
        if timer is None:
            timer = (timerValues.getCurrentWatermarkInMs() // self.pane_ms + 1) * self.pane_ms
            self.handle.registerTimer(timer)
        self._store(upto, timer, total)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() // self.pane_ms * self.pane_ms
        upto, _, total = self._load()
        longest, panes = max(self.windows, default=0) * self.pane_ms, {}
        for ends, partial in list(self.panes.iterator()):
            panes[ends[0]] = tuple(partial)
        for ends in sorted(e for e in panes if upto < e <= now):
            total = _merged(total, panes[ends])
        out = []
        for n in self.windows:
            inside = None if n else total
            for ends in sorted(e for e in panes if n and now - n * self.pane_ms < e <= now):
                inside = _merged(inside, panes[ends])
            if inside is not None:
                out.append([*key, n, now, *inside])
        kept = [e for e in panes if e > now + self.pane_ms - longest]
        for ends in set(panes) - set(kept):
            if ends <= now:
                self.panes.removeKey((ends,))
        timer = now + self.pane_ms if kept else None
        if timer is not None:
            self.handle.registerTimer(timer)
        self._store(max(upto, now), timer, total)
        yield pd.DataFrame(out, columns=["metric", "unit", "dims", "panes", "now_ms", *_PARTS])

    def close(self) -> None:
        pass


def window_totals_stream(points: DataFrame, windows: list[int], pane_ms: int = 1000) -> DataFrame:
    """Totals of each metric over trailing windows, as the stream's time goes on: metric, unit, dimensions, panes, now_ms, sum, min, max, count.

    ``windows`` are lengths in panes of ``pane_ms`` (seconds by default; 0: everything so far). A window ends at the last pane's end that
    the stream's time has come to, and holds points after its beginning up to its end, as ``operators.metrics.metrics_window`` does; it has a row whenever
    it may have changed, and none if it holds nothing. Kept for each series: a partial for each pane in the longest window. Points come in
    the order of time, batch after batch. Needs the RocksDB state store.
    """
    sample = lambda c: F.coalesce("value", c).alias(c)
    shaped = points.select(
        "metric", "unit", _dims(), "ts_ns", F.lit(None).cast("double").alias("value"), sample("min"), sample("max"), sample("sum"),
        F.coalesce("count", F.lit(1)).cast("bigint").alias("count"), F.timestamp_micros(F.expr("ts_ns div 1000")).alias("at"),
    )
    made = shaped.withWatermark("at", "0 seconds").groupBy("metric", "unit", "dims").transformWithStateInPandas(
        statefulProcessor=_Windows(pane_ms, list(windows)),
        outputStructType=T.StructType.fromDDL(f"metric string, unit string, dims string, panes int, now_ms long, {_PARTIAL}"),
        outputMode="Append",
        timeMode="EventTime",
    )
    dimensions = F.from_json("dims", "array<struct<key:string,value:string>>").alias("dimensions")
    return made.select("metric", "unit", dimensions, "panes", "now_ms", "sum", "min", "max", "count")


class _Outstanding(StatefulProcessor):
    """Open records of a key in a queue by the time they were enqueued: the oldest is its head, however many there are.

    ``queue`` holds them by number, ``numbers`` finds a record's number. Records that are enqueued and completed in one batch
    never reach either.
    """

    def __init__(self, tick_ms: int, by: list[str]):
        self.tick_us, self.by = tick_ms * 1000, by
        self.number, self.at, self.record = (T.StructType.fromDDL(d) for d in ("number long", "at_us long", "record string"))
        self.whole = T.StructType.fromDDL("head long, tail long, n long, tick long")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.queue = handle.getMapState("queue", self.number, self.at)
        self.numbers = handle.getMapState("numbers", self.record, self.number)
        self.ends = handle.getValueState("ends", self.whole)

    def _head(self, head: int, tail: int) -> int:
        while head < tail and not self.queue.containsKey((head,)):
            head += 1
        return head

    def _row(self, key, tick: int, n: int, oldest: int | None) -> list:
        ends = (tick + 1) * self.tick_us
        return [*key, ends // 1000, n, None if oldest is None else (ends - oldest) // 1000]

    def _frame(self, rows: list[list]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=[*self.by, "now_ms", "n_outstanding", "oldest_ms"])
        out["oldest_ms"] = out["oldest_ms"].astype("Int64")
        return out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows))
        events = events.assign(later=events["kind"] == COMPLETED).sort_values(["at_us", "later"], kind="stable")
        head, tail, n, now = self.ends.get() if self.ends.exists() else (0, 0, 0, None)
        before, out, fresh, first = now, [], OrderedDict(), None  # first: time of the queue's head, once looked up

        def oldest() -> int | None:
            nonlocal head, first
            if n and first is None:
                head = self._head(head, tail)
                first = self.queue.getValue((head,))[0]
            times = ([first] if n else []) + ([next(iter(fresh.values()))] if fresh else [])
            return min(times, default=None)

        for record, kind, at in zip(events["record"], events["kind"], events["at_us"].tolist()):
            tick = at // self.tick_us
            if now is not None and tick > now:
                out.append(self._row(key, now, n + len(fresh), oldest()))
            now = tick if now is None else max(now, tick)
            if kind == ENQUEUED:
                fresh[record] = at
            elif record in fresh:
                del fresh[record]
            elif self.numbers.containsKey((record,)):
                number = self.numbers.getValue((record,))[0]
                self.numbers.removeKey((record,))
                self.queue.removeKey((number,))
                n, first = n - 1, None if number == head else first
        for record, at in fresh.items():
            self.queue.updateValue((tail,), (at,))
            self.numbers.updateValue((record,), (tail,))
            tail, n = tail + 1, n + 1
        if now != before:  # the tick that is now under way is told about when its end has come
            if before is not None:
                self.handle.deleteTimer((before + 1) * self.tick_us // 1000)
            self.handle.registerTimer((now + 1) * self.tick_us // 1000)
        self.ends.update((head, tail, n, now))
        if out:
            yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        head, tail, n, now = self.ends.get()
        if now is None:
            return
        oldest = None
        if n:
            head = self._head(head, tail)
            oldest = self.queue.getValue((head,))[0]
        self.ends.update((head, tail, n, None))
        yield self._frame([self._row(key, now, n, oldest)])

    def close(self) -> None:
        pass


def outstanding_stream(enqueued: DataFrame, completed: DataFrame, keys: list[str], time: str, tick_ms: int, by: list[str] = ["stream_name"]) -> DataFrame:  # noqa: B006
    """Records not completed yet and the age of the oldest, at the end of each tick in which something happened: ``by``, now_ms, n_outstanding, oldest_ms.

    Two streams with ``keys``, which identify a record, ``by`` and a timestamp column ``time``; they come in its order, batch after batch. At
    each tick the same as ``operators.metrics.outstanding`` finds by comparing all records. A completion of a record that is not open
    counts for nothing. ``by`` should include what spreads a hot stream. Needs the RocksDB state store.
    """

    def events(df: DataFrame, kind: str) -> DataFrame:
        return df.select(*by, F.to_json(F.struct(*keys)).alias("record"), F.lit(kind).alias("kind"), F.unix_micros(time).alias("at_us"), F.col(time).alias("at"))

    both = events(enqueued, ENQUEUED).unionByName(events(completed, COMPLETED)).withWatermark("at", "0 seconds")
    fields = [T.StructField(c, enqueued.schema[c].dataType) for c in by]
    found = T.StructType([*fields, *T.StructType.fromDDL("now_ms long, n_outstanding long, oldest_ms long").fields])
    return both.groupBy(*by).transformWithStateInPandas(
        statefulProcessor=_Outstanding(tick_ms, by), outputStructType=found, outputMode="Append", timeMode="EventTime"
    )
