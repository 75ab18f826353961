"""Queries over a landed record log: files skipped on resume, restarted consumers, puts that land once, running metrics."""

import datetime as dt

from pyspark.sql import functions as F

from ...config import Limits, Position
from ...functions.records import data_text
from ...functions.retry import Policy
from ...operators import checkpoints as C
from ...operators import routing
from ...operators.packing import unpack_records
from ...session import scratch_path
from ...sources import manifest, record_log, starts
from ...streaming.process import process_stream, read_checkpoints
from ...streaming.put import put_stream
from ..put import REPORT, put_until_done
from ..testtables import consumer_log, listing, records, table
from .consume_queries import MIDDLE_SQL, early, event_id, stored
from .produce_queries import fails_user_mod_4_times
from .registry import LOG, RECORDS, query, ranges_sql
from .routing_queries import FOUR, LOOKUP
from .stream_queries import NOW_TRIGGER, finish, streamed

PARTS = 5


def _part(spark, sf_dir):
    """Which of PARTS landings an event comes with: even ranges of the events' numbers."""
    last = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    return F.expr(f"CAST(substring(sequence_number, 30, 27) AS BIGINT) * {PARTS} div {(last or 0) + 1}")


PARTED = LOG.replace("FROM events)", f"FROM events),\nparted AS (SELECT *, event_id * {PARTS} // (SELECT max(event_id) + 1 FROM events) AS part FROM log)")


def landed(spark, sf_dir, path, parts=range(PARTS), keep="true"):
    """Land parts of the log one after the other, as their records come."""
    log, part = consumer_log(spark, sf_dir).filter(keep), _part(spark, sf_dir)
    for k in parts:
        record_log.write_record_log(log.filter(part == k), path, commit=f"part-{k}")


def _starts(spark, checkpoints):
    return starts.plan_starts(spark.createDataFrame([], starts.START), checkpoints)


@query(
    "resume_skips_files",
    f"""WITH {PARTED}, stored AS (SELECT stream_name, shard_id, max(sequence_number) AS upto FROM log
          WHERE arrival < {MIDDLE_SQL} AND (shard_id <> 'shardId-000000000003' OR stream_name < 'stream-f') GROUP BY ALL)
        SELECT 'part-' || part::VARCHAR AS part, stream_name, count(*) AS n_records, coalesce(bool_and(sequence_number <= coalesce(upto, '')), FALSE) AS skipped
        FROM parted LEFT JOIN stored USING (stream_name, shard_id) GROUP BY ALL""",
)
def resume_skips_files(spark, sf_dir):
    """Which landings' files a consumer that resumes does not read, by the manifest, for each stream."""
    path = scratch_path(spark, "log")
    landed(spark, sf_dir, path)
    resume = C.checkpoints(early(spark, sf_dir).filter("shard_id <> 'shardId-000000000003' OR stream_name < 'stream-f'"))
    entries = manifest.needed(manifest.read_manifest(spark, path), _starts(spark, resume))
    files = entries.groupBy("commit", "stream_name", "file").agg(F.sum("n_records").alias("n"), F.bool_or("needed").alias("needed"))
    return files.groupBy(F.col("commit").alias("part"), "stream_name").agg(F.sum("n").alias("n_records"), (~F.bool_or("needed")).alias("skipped"))


@query(
    "resume_from_files",
    f"""WITH {LOG}, stored AS (SELECT stream_name, shard_id, max(sequence_number) AS upto FROM log
          WHERE arrival < {MIDDLE_SQL} AND shard_id <> 'shardId-000000000003' GROUP BY ALL)
        SELECT event_id, data_text FROM log LEFT JOIN stored USING (stream_name, shard_id) WHERE upto IS NULL OR sequence_number > upto""",
)
def resume_from_files(spark, sf_dir):
    """The records after the checkpoints, out of the files that hold some."""
    path = scratch_path(spark, "log")
    landed(spark, sf_dir, path)
    rest = starts.read_from_starts(spark, path, _starts(spark, stored(spark, sf_dir)), Position.trim_horizon())
    return rest.select(event_id(), data_text().alias("data_text"))


EARLY = dt.datetime(2024, 1, 5)
POSITIONS = {
    "stream-click": Position.latest(),
    "stream-view": Position.at_timestamp(EARLY),
    "stream-error": Position.trim_horizon(),
    "stream-signup": Position.latest(),
}
# shard 3 appears after the consumer has been stopped once
LATE_SHARD = "shardId-000000000003"

CONSUMED = f"""WITH {PARTED}, there AS (SELECT * FROM parted WHERE part >= 3 OR shard_id <> '{LATE_SHARD}'),
tips AS (SELECT stream_name, shard_id, max(sequence_number) AS tip FROM there WHERE part = 0 GROUP BY ALL),
consumed AS (
  SELECT there.*, CASE WHEN part < 3 THEN 1 ELSE 2 END AS run FROM there LEFT JOIN tips USING (stream_name, shard_id)
  WHERE (stream_name IN ('stream-click', 'stream-signup') AND (tip IS NULL OR sequence_number > tip))
     OR (stream_name = 'stream-view' AND arrival >= TIMESTAMP '2024-01-05 00:00:00') OR stream_name = 'stream-error')"""


def consumed(spark, sf_dir, lost_progress):
    """What a consumer processes that starts when part 0 is there, runs after part 2, and again after part 4, with or without its progress.

    Returns the processed records by run, and the store of its checkpoints.
    """
    base = scratch_path(spark, "consumer")
    path, captured, store = f"{base}/log", f"{base}/captured", f"{base}/store"
    landed(spark, sf_dir, path, [0], f"shard_id <> '{LATE_SHARD}'")
    starts.captured_starts(spark, path, POSITIONS, captured)
    for run, parts, keep in ((1, [1, 2], f"shard_id <> '{LATE_SHARD}'"), (2, [3, 4], "true")):
        landed(spark, sf_dir, path, parts, keep)
        known = read_checkpoints(spark, store) if lost_progress else None
        log = starts.resume_stream(spark, path, POSITIONS, captured, known)
        keep_batch = lambda batch, run=run: batch.write.mode("append").parquet(f"{base}/out/run={run}")
        # a consumer that lost its progress numbers its batches anew: each has a store of its own
        progress, own = (f"{base}/progress{run}", f"{store}/run={run}") if lost_progress else (f"{base}/progress", store)
        finish(process_stream(log, keep_batch, progress, store=own))
    return spark.read.parquet(f"{base}/out"), store


@query("stream_restart", f"{CONSUMED} SELECT event_id, run, count(*) AS times FROM consumed GROUP BY ALL")
def stream_restart(spark, sf_dir):
    """A consumer that lost its progress starts again after its checkpoints, and in a shard that is new at the beginning: nothing lost or seen twice."""
    out, _ = consumed(spark, sf_dir, True)
    return out.groupBy(event_id(), F.col("run").cast("int").alias("run")).agg(F.count("*").alias("times"))


@query("stream_uninterrupted", f"{CONSUMED} SELECT event_id, run, count(*) AS times FROM consumed GROUP BY ALL")
def stream_uninterrupted(spark, sf_dir):
    """The same consumer with its progress: it processes the same records."""
    out, _ = consumed(spark, sf_dir, False)
    return out.groupBy(event_id(), F.col("run").cast("int").alias("run")).agg(F.count("*").alias("times"))


@query(
    "stream_restart_commits",
    f"{CONSUMED} SELECT stream_name, shard_id, max(sequence_number) AS sequence_number, 0::BIGINT AS sub_sequence_number FROM consumed GROUP BY ALL",
)
def stream_restart_commits(spark, sf_dir):
    """The checkpoints that the automatic commits of both runs left."""
    return read_checkpoints(spark, consumed(spark, sf_dir, True)[1])


class RaisesAfterWriting:
    """A put function that lands its entries and then raises an error, at the first attempts."""

    def __init__(self, landing, attempts):
        self.landing, self.left = landing, attempts

    def __call__(self, entries):
        responses = self.landing(entries)
        if self.left:
            self.left -= 1
            raise ConnectionError("the answer never came")
        return responses

    def commit(self, spark, attempt):
        self.landing.commit(spark, attempt)


ROUTED = f"WITH {RECORDS}, {ranges_sql(FOUR)}, {LOOKUP}".replace("FROM sized z", "FROM checked z")


@query("put_lands_once", f"{ROUTED} SELECT stream_name, shard_id, partition_key, count(*) AS n_records FROM routed WHERE invalid_reason IS NULL GROUP BY ALL")
def put_lands_once(spark, sf_dir):
    """The records of a log into which two attempts wrote before they failed: each once."""
    path = scratch_path(spark, "log")
    put_fn = RaisesAfterWriting(record_log.landing_put_fn(path, dt.datetime(2024, 1, 1)), 2)
    shards = routing.shard_map(listing(spark, sf_dir, FOUR))
    put_until_done(records(spark, sf_dir).drop("event_id"), shards, Limits(), Policy.constant_delay(0), put_fn)
    opened = unpack_records(record_log.read_record_log(spark, path))
    return opened.groupBy("stream_name", "shard_id", "partition_key").agg(F.count("*").alias("n_records"))


ATTEMPTS = f"""{ROUTED},
tries AS (SELECT * FROM (VALUES (0), (1), (2)) t(attempt)),
packs AS (SELECT stream_name, put_id, shard_id, partition_key, user_id % 4 AS refusals, count(*) AS n FROM routed WHERE invalid_reason IS NULL GROUP BY ALL),
sent AS (SELECT attempt, count(*) AS n_entries, count(DISTINCT (stream_name, put_id, shard_id)) AS n_requests, sum(n) AS n_records,
                count(*) FILTER (attempt < refusals) AS n_failed FROM packs, tries WHERE refusals >= attempt GROUP BY ALL)
SELECT attempt, CASE WHEN attempt = 0 THEN (SELECT count(*) FROM checked) ELSE 0 END AS n_received,
       CAST(CASE WHEN attempt = 0 THEN (SELECT sum(n_bytes) FROM checked) ELSE 0 END AS BIGINT) AS received_bytes, n_requests, n_entries,
       CAST(n_records AS BIGINT) AS n_records, n_failed, CASE WHEN attempt = 0 THEN (SELECT count(*) FROM checked WHERE invalid_reason IS NOT NULL) ELSE 0 END AS n_invalid,
       n_requests AS duration_count, 0.5::DOUBLE AS duration_min, 0.5::DOUBLE AS duration_max, n_requests / 2 AS duration_sum FROM sent"""


def by_attempt(reports):
    sums = ["n_received", "received_bytes", "n_requests", "n_entries", "n_records", "n_failed", "n_invalid", "duration_count", "duration_sum"]
    return reports.groupBy("attempt").agg(
        *[F.sum(c).alias(c) for c in sums], F.min("duration_min").alias("duration_min"), F.max("duration_max").alias("duration_max")
    )


@query("put_attempt_metrics", ATTEMPTS)
def put_attempt_metrics(spark, sf_dir):
    """What each attempt of the retried puts reported while it ran."""
    shards, reports = routing.shard_map(listing(spark, sf_dir, FOUR)), []
    put_until_done(
        records(spark, sf_dir).drop("event_id"), shards, Limits(), Policy.limit_retries(2), fails_user_mod_4_times, on_attempt=reports.append
    )
    return by_attempt(spark.createDataFrame(reports, REPORT))


@query("stream_put_metrics", ATTEMPTS)
def stream_put_metrics(spark, sf_dir):
    """The same reports of a streaming put, summed over its batches."""
    base = scratch_path(spark, "put")
    shards = routing.shard_map(listing(spark, sf_dir, FOUR))
    source = streamed(spark, sf_dir, records).drop("event_id")
    finish(
        put_stream(
            source, shards, Limits(), fails_user_mod_4_times, f"{base}/outcomes", f"{base}/progress", Policy.limit_retries(2), NOW_TRIGGER,
            metrics_path=f"{base}/metrics",
        )
    )
    return by_attempt(spark.read.parquet(f"{base}/metrics"))


@query("stream_process_commits", f"WITH {LOG} SELECT stream_name, shard_id, max(sequence_number) AS sequence_number, 0::BIGINT AS sub_sequence_number FROM log GROUP BY ALL")
def stream_process_commits(spark, sf_dir):
    """The checkpoints of a callback with automatic commits."""
    base = scratch_path(spark, "process")
    finish(process_stream(streamed(spark, sf_dir, consumer_log), lambda batch: batch.count(), f"{base}/progress", store=f"{base}/store"))
    return read_checkpoints(spark, f"{base}/store")


@query(
    "stream_empty_batches",
    f"""WITH {PARTED}, parts AS (SELECT unnest(range({PARTS})) AS part)
        SELECT p.part::BIGINT AS part, count(event_id) AS n_records FROM parts p LEFT JOIN (SELECT * FROM parted WHERE part % 2 = 1) x USING (part) GROUP BY ALL""",
)
def stream_empty_batches(spark, sf_dir):
    """A callback that is also called for batches of which nothing is left: the records of each call."""
    base = scratch_path(spark, "empty")
    part = _part(spark, sf_dir)
    for run in range(PARTS):
        landed(spark, sf_dir, f"{base}/log", [run])
        log = record_log.read_record_log(spark, f"{base}/log", streaming=True).filter(part % 2 == 1)

        def count(batch, run=run):
            counts = batch.agg(F.count("*").alias("n_records")).select(F.lit(run).cast("bigint").alias("part"), "n_records")
            counts.write.mode("overwrite").parquet(f"{base}/calls/run{run}")

        finish(process_stream(log, count, f"{base}/progress", call_on_empty=True))
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/calls")
