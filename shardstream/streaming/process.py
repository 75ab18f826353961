"""Processing a stream of records batch by batch: callback, commit, failure mode, checkpoint store."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.positions import SHARD
from ..operators.checkpoints import checkpoints, gated_checkpoints, latest_state
from ..session import materialize, remove_folder, scratch_scope
from ..sources.manifest import read_table_or

log = logging.getLogger(__name__)

COMMIT_RETRIES = 5

STORED = "stream_name string, shard_id string, sequence_number string, sub_sequence_number long"


# So many batches apart, the store is put together into one folder.
COMPACT_BATCHES = 50


def write_checkpoints(new: DataFrame, path: str, batch_id: int) -> None:
    """Store a batch's checkpoints; the furthest position of a shard is its checkpoint."""
    write_batch(new.select(*SHARD, "sequence_number", "sub_sequence_number"), path, batch_id, checkpoints)


def write_batch(new: DataFrame, path: str, batch_id: int, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Store what a batch adds to a table that ``merge`` puts together. A batch that is run again overwrites its own folder only.

    Every COMPACT_BATCHES batches all folders put together go into the batch's own, and the older folders go; until they
    are gone they only repeat what it says.
    """
    spark = new.sparkSession
    own, compact = f"{path}/batch={batch_id}", batch_id > 0 and batch_id % COMPACT_BATCHES == 0
    stored = [f for f in _folders(spark, path) if f <= batch_id] if compact else []
    with scratch_scope(spark):
        if stored:
            # read before its own folder is overwritten: a batch that was run before may hold the older ones already
            new = materialize(merge(read_table_or(spark, path, new.schema).select(*new.columns).unionByName(new)))
        new.repartition(1).write.mode("overwrite").parquet(own)
    for batch in stored:
        if batch < batch_id:
            remove_folder(spark, f"{path}/batch={batch}")


def _folders(spark: SparkSession, path: str) -> list[int]:
    """The batches that have a folder in the store."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(where):
        return []
    names = [status.getPath().getName() for status in files.listStatus(where)]
    return sorted(int(name.removeprefix("batch=")) for name in names if name.startswith("batch="))


def read_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """The furthest stored position of each shard; none before the first commit, or if a crash left the store without a file."""
    return checkpoints(read_table_or(spark, path, STORED))


def _retrying(commit: Callable[[], None], retries: int = COMMIT_RETRIES) -> None:
    for attempt in range(retries + 1):
        try:
            return commit()
        except Exception:
            if attempt == retries:
                raise
            log.exception("commit failed, trying again")


def commit_batch(batch: DataFrame, batch_id: int, store: str, states: DataFrame | None = None) -> None:
    """Commit the newest position of each shard in the batch whose processor may commit."""
    new = checkpoints(batch) if states is None else gated_checkpoints(batch, states)
    _retrying(lambda: write_checkpoints(new, store, batch_id))


def process_stream(
    sdf: DataFrame,
    fn: Callable[[DataFrame], None],
    checkpoint_location: str,
    store: str | None = None,
    auto_commit: bool = True,
    states: DataFrame | None = None,
    raise_on_error: bool = True,
    quarantine: str | None = None,
    call_on_empty: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run ``fn`` on every batch of records, then commit the batch's positions.

    An error in ``fn`` stops the query; with ``raise_on_error=False`` it is logged, the batch goes to
    the ``quarantine`` folder, if given, without being committed, and the stream moves on. A commit that fails after all of
    its retries stops the query either way: the batch was processed, and is seen again after a restart. Delivery is
    at least once: ``fn`` may see a batch again after a failure.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                if call_on_empty:
                    fn(batch)
                return
            try:
                fn(batch)
            except Exception:
                if raise_on_error:
                    raise
                log.exception("batch %s failed; moving on may lose its records", batch_id)
                if quarantine is not None:
                    batch.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
            else:
                if auto_commit and store is not None:
                    commit_batch(batch, batch_id, store, states)
        finally:
            batch.unpersist()

    writer = sdf.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_location)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def commit_records(
    sdf: DataFrame,
    out: str,
    store: str,
    checkpoint_location: str,
    states: DataFrame | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Commit positions batch by batch and pass every record on, unchanged, to ``out``.

    Records are written before their positions, so a position never runs ahead of its records.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
            commit_batch(batch, batch_id, store, states)
        finally:
            batch.unpersist()

    writer = sdf.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_location)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


REPORT = "stream_name string, shard_id string, worker string, state string, ts timestamp"


def known_states(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """The last state of each shard's processor that was reported up to a batch."""
    stored = read_table_or(spark, path, f"{REPORT}, batch int").filter(F.col("batch") <= batch_id)
    return latest_state(stored)


def commit_gated_stream(
    records: DataFrame, reports: DataFrame, out: str, store: str, states: str, checkpoint_location: str, trigger: dict | None = None
) -> StreamingQuery:
    """Like :func:`commit_records`, with the processors' states as a second stream: a batch commits by the states known at its end.

    ``reports`` has stream_name, shard_id, worker, state and the time ``ts`` of the report. The reports of a batch are stored below
    ``states`` before its commits; a batch that is run again sees the states it saw then, and none of later batches.
    """
    one = records.select(F.struct(*records.columns).alias("record"))
    other = reports.select(F.struct(*SHARD, "worker", "state", F.col("ts").cast("timestamp").alias("ts")).alias("report"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            write_batch(latest_state(batch.filter("report IS NOT NULL").select("report.*")), states, batch_id, latest_state)
            arrived = batch.filter("record IS NOT NULL").select("record.*")
            arrived.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
            commit_batch(arrived, batch_id, store, known_states(batch.sparkSession, states, batch_id))
        finally:
            batch.unpersist()

    both = one.unionByName(other, allowMissingColumns=True)
    writer = both.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_location)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def route_rates(routed: DataFrame, time: str, width: str, late: str) -> DataFrame:
    """Records and bytes per shard and time window of a routed stream; windows close ``late`` after their end."""
    windowed = routed.withWatermark(time, late).groupBy(F.window(time, width), "stream_name", "shard_id")
    return windowed.agg(F.count("*").alias("n_records"), F.sum("n_bytes").alias("n_bytes")).select(
        F.col("window.start").alias("window_start"), "stream_name", "shard_id", "n_records", "n_bytes"
    )


RATES = "window_start timestamp, stream_name string, shard_id string, n_records long, n_bytes long, as_of long"


def _last_rates(stored: DataFrame) -> DataFrame:
    newest = stored.groupBy("window_start", *SHARD).agg(F.max(F.struct("as_of", "n_records", "n_bytes")).alias("__last"))
    return newest.select("window_start", *SHARD, *[F.col(f"__last.{c}").alias(c) for c in ("n_records", "n_bytes", "as_of")])


def keep_rates(rates: DataFrame, path: str, checkpoint_location: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the rates of all windows in a table, those that are still open as well: each batch stores the windows it changed."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.withColumn("as_of", F.lit(batch_id).cast("bigint")), path, batch_id, _last_rates)

    writer = rates.writeStream.outputMode("update").foreachBatch(handle).option("checkpointLocation", checkpoint_location)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    """The kept rates of each window, as of the last batch."""
    return _last_rates(read_table_or(spark, path, RATES)).drop("as_of")
