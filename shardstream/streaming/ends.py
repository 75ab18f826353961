"""The end of a shard on a live stream: wait until its last record is committed, give up after a time, then the final checkpoint."""

from __future__ import annotations

import logging
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.positions import SHARD
from .process import write_checkpoints

log = logging.getLogger(__name__)

RECORD, COMMIT, END = "record", "commit", "end"
COMPLETE, TIMED_OUT, WAITING = "complete", "timed_out", "waiting"

_STATE = (
    "last_sequence string, last_sub long, done_sequence string, done_sub long, ended_ms long, status string, step long, timer_ms long"
)
STATUS = "stream_name string, shard_id string, step long, status string, final_checkpoint boolean, sequence_number string, sub_sequence_number long"


class ShardTimedOut(Exception):
    """Raised on request when the last record of an ended shard was not committed in time."""


def _place(sequence: str | None, sub: int | None) -> tuple[int, str, int] | None:
    """Order of positions, as ``functions.positions.position`` has it."""
    return None if sequence is None else (len(sequence), sequence, sub or 0)


class _ShardEnd(StatefulProcessor):
    """The newest record, the newest commit and the end of a shard; says when its status changes."""

    def __init__(self, timeout_ms: int | None):
        self.timeout_ms, self.state = timeout_ms, T.StructType.fromDDL(_STATE)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.shard = handle.getValueState("shard", self.state)

    def _load(self) -> dict:
        names = [part.split()[0] for part in _STATE.split(", ")]
        return dict(zip(names, self.shard.get() if self.shard.exists() else [None] * len(names)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self._load()
        newest = {RECORD: _place(known["last_sequence"], known["last_sub"]), COMMIT: _place(known["done_sequence"], known["done_sub"])}
        for batch in rows:
            for kind, part in batch.groupby("kind"):
                if kind == END:
                    known["ended_ms"] = min(int(part["at_ms"].min()), *([known["ended_ms"]] if known["ended_ms"] is not None else []), 1 << 62)
                    continue
                subs = part["sub_sequence_number"].fillna(0).astype("int64")
                places = [_place(s, int(n)) for s, n in zip(part["sequence_number"], subs)]
                newest[kind] = max([p for p in [newest[kind], *places] if p is not None], default=None)
        for name, kind in (("last", RECORD), ("done", COMMIT)):
            if newest[kind] is not None:
                _, known[f"{name}_sequence"], known[f"{name}_sub"] = newest[kind]
        yield from self._judged(key, known, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self._load()
        if known["timer_ms"] is not None and known["timer_ms"] <= expiredTimerInfo.getExpiryTimeInMs():
            known["timer_ms"] = None
        yield from self._judged(key, known, expiredTimerInfo.getExpiryTimeInMs())

    def _judged(self, key, known: dict, now_ms: int) -> Iterator[pd.DataFrame]:
        if known["ended_ms"] is not None:
            last, done = _place(known["last_sequence"], known["last_sub"]), _place(known["done_sequence"], known["done_sub"])
            due = None if self.timeout_ms is None else known["ended_ms"] + self.timeout_ms
            status = WAITING if due is None or now_ms < due else TIMED_OUT
            if last is None or done is not None and done >= last:
                status = COMPLETE
            if status == WAITING and due is not None and known["timer_ms"] is None:
                self.handle.registerTimer(due)
                known["timer_ms"] = due
            if status != known["status"]:
                known["status"], known["step"] = status, (known["step"] or 0) + 1
                row = [*key, known["step"], status, status != WAITING, known["last_sequence"], known["last_sub"]]
                yield pd.DataFrame([row], columns=[part.split()[0] for part in STATUS.split(", ")])
        self.shard.update(tuple(known.values()))

    def close(self) -> None:
        pass


def shard_end_stream(records: DataFrame, commits: DataFrame, ended: DataFrame, timeout_ms: int | None, time: str = "at") -> DataFrame:
    """The status of ended shards each time it changes: 'waiting', 'complete' once the last record is committed, 'timed_out'.

    Three streams: records and commits with their positions, ends with the shard; all with a timestamp column ``time``. What
    ``operators.checkpoints.shard_end_status`` says at a moment is the row with the highest ``step`` that the stream has given by then; the
    moment is the stream's newest time. A shard without records has nothing to wait for; without a timeout it waits for ever. A
    commit that comes after the time was up still completes a shard. Three positions are kept for each shard. Needs the RocksDB state store.
    """
    nowhere = {"sequence_number": F.lit(None).cast("string"), "sub_sequence_number": F.lit(None).cast("bigint")}

    def events(df: DataFrame, kind: str) -> DataFrame:
        return df.select(*SHARD, F.lit(kind).alias("kind"), "sequence_number", "sub_sequence_number", F.col(time).alias("at"))

    everything = events(records, RECORD).unionByName(events(commits, COMMIT)).unionByName(events(ended.withColumns(nowhere), END))
    timed = everything.withColumn("at_ms", F.unix_millis("at")).withWatermark("at", "0 seconds")
    return timed.groupBy(*SHARD).transformWithStateInPandas(
        statefulProcessor=_ShardEnd(timeout_ms), outputStructType=T.StructType.fromDDL(STATUS), outputMode="Append", timeMode="EventTime"
    )


def end_shards(
    statuses: DataFrame, out: str, store: str, checkpoint_location: str, raise_on_timeout: bool = True, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the statuses below ``out``, and give each shard that is done its final checkpoint, the position of its last record.

    A shard whose time was up is an error that stops the query before its final checkpoint, or with ``raise_on_timeout=False``
    is logged and gets one.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
            late = [f"{r.stream_name}/{r.shard_id}" for r in batch.filter(F.col("status") == TIMED_OUT).limit(20).collect()]  # named in the message
            if late and raise_on_timeout:
                raise ShardTimedOut(f"the last records were not committed in time: {', '.join(late)}")
            if late:
                log.error("the last records were not committed in time: %s", ", ".join(late))
            final = batch.filter("final_checkpoint AND sequence_number IS NOT NULL").select(*SHARD, "sequence_number", "sub_sequence_number")
            write_checkpoints(final, store, batch_id)
        finally:
            batch.unpersist()

    writer = statuses.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_location)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
