"""Queries run as streams: the events table is the source, drained once; the result is what the stream left."""

from pyspark.sql import functions as F

from ...config import Limits, Position
from ...functions.records import data_text
from ...functions.retry import Policy
from ...operators import produce, routing
from ...operators.packing import pack_records, unpack_records
from ...session import scratch_path
from ...sources import record_log
from ...streaming.process import commit_records, process_stream
from ...streaming.put import put_stream, refreshing
from ..testtables import DOCUMENT_LIMITS, consumer_log, listing, micros, records, table
from .batching_queries import as_consumed, documents_to_pack
from .consume_queries import MIDDLE, event_id
from .produce_queries import fails_user_mod_4_times
from .registry import DOCUMENTS, LOG, ORACLES, query
from .routing_queries import FOUR

NOW_TRIGGER = {"availableNow": True}
FILES = 5


def streamed(spark, sf_dir, shape):
    """A table mapping applied to the events as a stream instead of as a table.

    The events come in FILES files that hold whole puts, one file a micro-batch.
    """
    events, path = table(spark, sf_dir, "events"), scratch_path(spark, "events")
    events.repartition(FILES, F.floor(F.col("event_id") / 500)).write.parquet(path)
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return shape(_Source(spark, source), sf_dir)


class _Source:
    """Stands in for the session where a table mapping reads ``events``."""

    def __init__(self, spark, source):
        self.spark, self.source = spark, source

    @property
    def read(self):
        return self

    def parquet(self, path):
        return self.source


def stream_log(spark, sf_dir):
    return streamed(spark, sf_dir, consumer_log)


def finish(query):
    try:
        query.awaitTermination()
    finally:
        query.stop()


@query("stream_commit_passes_records", f"WITH {LOG} SELECT event_id, data_text FROM log")
def stream_commit_passes_records(spark, sf_dir):
    """A committing stream passes every record on unchanged."""
    base = scratch_path(spark, "commit")
    finish(commit_records(stream_log(spark, sf_dir), f"{base}/out", f"{base}/store", f"{base}/progress", trigger=NOW_TRIGGER))
    return spark.read.parquet(f"{base}/out").select(event_id(), data_text().alias("data_text"))


@query(
    "stream_process",
    f"WITH {LOG} SELECT stream_name, shard_id, count(*) AS n_records FROM log GROUP BY ALL",
)
def stream_process(spark, sf_dir):
    """A callback that counts each batch per shard, with automatic commits."""
    base = scratch_path(spark, "process")
    count = lambda batch: batch.groupBy("stream_name", "shard_id").count().write.mode("append").parquet(f"{base}/counts")
    finish(process_stream(stream_log(spark, sf_dir), count, f"{base}/progress", store=f"{base}/store"))
    counts = spark.read.parquet(f"{base}/counts")
    return counts.groupBy("stream_name", "shard_id").agg(F.sum("count").alias("n_records"))


@query("stream_quarantine", f"WITH {LOG} SELECT event_id FROM log")
def stream_quarantine(spark, sf_dir):
    """A failing callback that does not stop the stream: the batch is kept aside."""
    base = scratch_path(spark, "quarantine")

    def refuse(batch):
        raise ValueError("not today")

    finish(
        process_stream(
            stream_log(spark, sf_dir), refuse, f"{base}/progress", raise_on_error=False, quarantine=f"{base}/aside"
        )
    )
    return spark.read.parquet(f"{base}/aside").select(event_id())


@query("stream_put", ORACLES["put_until_done"])
def stream_put(spark, sf_dir):
    """The retried puts, fed from a stream, with a shard map that is loaded by the stream."""
    base = scratch_path(spark, "put")
    shards = refreshing(lambda: routing.shard_map(listing(spark, sf_dir, FOUR)))
    source = streamed(spark, sf_dir, records).drop("event_id")
    finish(
        put_stream(
            source,
            shards,
            Limits(),
            fails_user_mod_4_times,
            f"{base}/outcomes",
            f"{base}/progress",
            Policy.limit_retries(2),
            NOW_TRIGGER,
        )
    )
    return produce.put_summary(spark.read.parquet(f"{base}/outcomes"))


@query("stream_unpack", f"WITH {DOCUMENTS} SELECT partition_key, md5(data_text) AS digest FROM valid")
def stream_unpack(spark, sf_dir):
    """Packs landed in a log, then read and opened as a stream."""
    base = scratch_path(spark, "unpack")
    packed = as_consumed(pack_records(documents_to_pack(spark, sf_dir), DOCUMENT_LIMITS))
    landed = packed.withColumns({"arrival": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), "encryption_type": F.lit("NONE")})
    record_log.write_record_log(landed, f"{base}/log")
    log = record_log.read_record_log(spark, f"{base}/log", Position.trim_horizon(), streaming=True, files_per_trigger=4)
    writer = unpack_records(log).writeStream.format("parquet").option("path", f"{base}/out")
    finish(writer.option("checkpointLocation", f"{base}/progress").trigger(**NOW_TRIGGER).start())
    return spark.read.parquet(f"{base}/out").select("partition_key", F.md5("data").alias("digest"))


@query(
    "record_log_roundtrip",
    f"""WITH {LOG} SELECT event_id, data_text, epoch_us(arrival) AS arrival_us FROM log
        WHERE stream_name = 'stream-view' AND arrival >= TIMESTAMP '2024-01-15 12:00:00'""",
)
def record_log_roundtrip(spark, sf_dir):
    """A log written by stream, one stream of it read back from a point in time."""
    path = scratch_path(spark, "log")
    record_log.write_record_log(consumer_log(spark, sf_dir), path)
    log = record_log.read_record_log(spark, path, Position.at_timestamp(MIDDLE), stream_name="stream-view")
    return log.select(event_id(), data_text().alias("data_text"), micros("arrival").alias("arrival_us"))
