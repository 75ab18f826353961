"""Streaming puts: every micro-batch of records is put, with its failures retried."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..config import Limits
from ..functions.retry import Policy
from ..plans.put import REPORT, PutFn, put_until_done
from ..session import scratch_scope

log = logging.getLogger(__name__)

REFRESH_S = 3600.0


def refreshing(
    load: Callable[[], DataFrame], ttl_s: float = REFRESH_S, empty: DataFrame | None = None, clock=time.monotonic
) -> Callable[[], DataFrame]:
    """A shard-map supplier that loads again once its map is older than ``ttl_s``.

    A failed load keeps the map in use. Before the first success that is the ``empty`` map, with which
    every record goes to the default shard; without one the error is raised.
    """
    held: dict = {} if empty is None else {"map": empty}

    def current() -> DataFrame:
        if "at" not in held or clock() - held["at"] >= ttl_s:
            try:
                held["map"], held["at"] = load(), clock()
            except Exception:
                if "map" not in held:
                    raise
                held["at"] = clock()
                log.exception("shard map refresh failed; keeping the map in use")
        return held["map"]

    return current


def put_stream(
    sdf: DataFrame,
    shards: DataFrame | Callable[[], DataFrame],
    limits: Limits,
    put_fn: PutFn,
    outcomes_path: str,
    checkpoint_location: str,
    policy: Policy | None = None,
    trigger: dict | None = None,
    metrics_path: str | None = None,
) -> StreamingQuery:
    """Put the records of each micro-batch; outcomes land below ``outcomes_path``, one folder per batch.

    The trigger bounds the wait, the source's rate limit the batch. Stop with ``query.stop()``, or with
    ``streaming.chunks.drain(query, seconds)`` once what is there was put; an ``availableNow`` trigger drains what is there and ends.
    Below ``metrics_path`` each batch leaves a report of each of its attempts (``plans.put.REPORT``), observed as its
    outcomes are written. A put function with a method ``for_batch`` is asked for one of its own for each batch, so that
    a batch that is run again lands nothing twice.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark, reports = batch.sparkSession, []
        own = put_fn.for_batch(batch_id) if hasattr(put_fn, "for_batch") else put_fn
        with scratch_scope(spark):  # entries, responses and retry rounds go once the outcomes are written
            outcomes = put_until_done(batch, shards, limits, policy or Policy.always_give_up(), own, on_attempt=reports.append)
            outcomes.write.mode("overwrite").parquet(f"{outcomes_path}/batch={batch_id}")
        if metrics_path is not None:
            spark.createDataFrame(reports, REPORT).coalesce(1).write.mode("overwrite").parquet(f"{metrics_path}/batch={batch_id}")

    writer = sdf.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_location)
    return writer.trigger(**(trigger or {"processingTime": "100 milliseconds"})).start()
