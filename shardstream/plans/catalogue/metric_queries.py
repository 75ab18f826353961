"""Queries over metrics: producer and buffer metrics, points, datums and their export requests."""

import datetime as dt

from pyspark.sql import functions as F

from ...functions.records import with_payload_size
from ...operators import metrics, produce
from ...session import materialize
from ...sources.datums import datum_requests
from ..testtables import micros, records, table
from .produce_queries import OUTCOMES, outcomes
from .registry import RECORDS, query

TS_NS = 1_706_745_600_000_000_000
NOW = dt.datetime(2024, 2, 1, 0, 0, 0)


def received(spark, sf_dir):
    return with_payload_size(records(spark, sf_dir))


@query(
    "received_metrics",
    f"WITH {RECORDS} SELECT stream_name, count(*) AS n_records, CAST(sum(n_bytes) AS BIGINT) AS n_bytes FROM sized GROUP BY ALL",
)
def received_metrics(spark, sf_dir):
    return metrics.received_metrics(received(spark, sf_dir))


REQUESTS = f"""{OUTCOMES}, requests AS (
  SELECT stream_name, put_id, attempt, shard_id, count(*) AS n_records, CAST(sum(n_bytes) AS BIGINT) AS n_bytes, max(duration_s) AS duration_s
  FROM outcomes WHERE batch_no IS NOT NULL GROUP BY ALL)"""


@query(
    "shard_put_metrics",
    f"""{REQUESTS} SELECT stream_name, shard_id, CAST(sum(n_records) AS BIGINT) AS n_records, CAST(sum(n_bytes) AS BIGINT) AS n_bytes,
          count(duration_s) AS duration_count, min(duration_s) AS duration_min, max(duration_s) AS duration_max,
          sum(duration_s) AS duration_sum FROM requests GROUP BY ALL""",
)
def shard_put_metrics(spark, sf_dir):
    return metrics.shard_put_metrics(produce.requests(outcomes(spark, sf_dir)))


RETRIES = """retries AS (SELECT stream_name, count(*) AS retries_count, min(attempt) AS retries_min, max(attempt) AS retries_max,
  CAST(sum(attempt) AS BIGINT) AS retries_sum FROM (SELECT DISTINCT stream_name, put_id, attempt FROM outcomes WHERE error_code IS NOT NULL) GROUP BY ALL)"""


@query("retry_metrics", f"{OUTCOMES}, {RETRIES} SELECT * FROM retries")
def retry_metrics(spark, sf_dir):
    return metrics.retry_metrics(outcomes(spark, sf_dir))


def buffer_events(spark, sf_dir):
    """Each event enters its stream's buffer; most leave it later, some are dropped instead."""
    event = table(spark, sf_dir, "events").select(
        F.concat(F.lit("stream-"), "event_type").alias("stream_name"), "event_id", micros("ts").alias("ts_us")
    )
    entered = event.filter("event_id % 10 <> 3").select("*", F.lit("enqueued").alias("kind"))
    left = event.filter("event_id % 10 NOT IN (3, 4)").select(
        "stream_name",
        "event_id",
        (F.col("ts_us") + 3_600_000_000).alias("ts_us"),
        F.lit("dequeued").alias("kind"),
        (F.col("event_id") % 16 / 8).alias("waited_s"),
    )
    reason = F.when(F.col("event_id") % 20 == 3, metrics.QUEUE_FULL).otherwise(metrics.SHUTDOWN)
    dropped = event.filter("event_id % 10 = 3").select("*", F.lit("dropped").alias("kind"), reason.alias("reason"))
    return entered.unionByName(left, allowMissingColumns=True).unionByName(dropped, allowMissingColumns=True)


BUFFER = """WITH event AS (SELECT 'stream-' || event_type AS stream_name, event_id, epoch_us(ts) AS ts_us FROM events),
buffer AS (
  SELECT stream_name, event_id, ts_us, 'enqueued' AS kind, NULL::DOUBLE AS waited_s, NULL AS reason FROM event WHERE event_id % 10 <> 3
  UNION ALL SELECT stream_name, event_id, ts_us + 3600000000, 'dequeued', (event_id % 16) / 8, NULL FROM event WHERE event_id % 10 NOT IN (3, 4)
  UNION ALL SELECT stream_name, event_id, ts_us, 'dropped', NULL, CASE WHEN event_id % 20 = 3 THEN 'queue_full' ELSE 'shutdown' END
    FROM event WHERE event_id % 10 = 3),
measured AS (
  SELECT stream_name, count(*) FILTER (kind = 'enqueued') - count(*) FILTER (kind = 'dequeued') AS pending,
         count(waited_s) AS n_waited, min(waited_s) AS min_waited, max(waited_s) AS max_waited, sum(waited_s) AS sum_waited,
         count(*) FILTER (reason = 'queue_full') AS dropped_queue_full, count(*) FILTER (reason = 'shutdown') AS dropped_shutdown
  FROM buffer GROUP BY ALL)"""


@query("buffer_metrics", f"{BUFFER} SELECT * FROM measured")
def buffer_metrics(spark, sf_dir):
    return metrics.buffer_metrics(buffer_events(spark, sf_dir))


@query(
    "pending_over_time",
    f"""{BUFFER}, net AS (SELECT stream_name, ts_us // 86400000000 AS interval_no,
            count(*) FILTER (kind = 'enqueued') - count(*) FILTER (kind = 'dequeued') AS net FROM buffer GROUP BY ALL)
        SELECT stream_name, interval_no, CAST(sum(net) OVER (PARTITION BY stream_name ORDER BY interval_no) AS BIGINT) AS pending FROM net""",
)
def pending_over_time(spark, sf_dir):
    return metrics.pending_over_time(buffer_events(spark, sf_dir), "ts_us", 86_400_000_000)


def points(spark, sf_dir):
    out = materialize(outcomes(spark, sf_dir))  # as a put leaves them
    producer = metrics.producer_points(
        received(spark, sf_dir), produce.requests(out), out, produce.error_counts(out), TS_NS
    )
    return producer.unionByName(metrics.buffer_points(buffer_events(spark, sf_dir), TS_NS))


_S, _SH = "'stream.name=' || stream_name", "'shard.id=' || shard_id || ',stream.name=' || stream_name"


def _sum(metric, unit, value, dims, source):
    return f"SELECT 'producer.{metric}' AS metric, '{unit}' AS unit, {dims} AS dims, {value}::DOUBLE AS value, NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS sum, NULL::BIGINT AS count FROM {source}"


def _histogram(metric, unit, low, high, total, count, dims, source):
    return f"SELECT 'producer.{metric}', '{unit}', {dims}, NULL, {low}::DOUBLE, {high}::DOUBLE, {total}::DOUBLE, {count} FROM {source}"


_BUFFER_PARTS = BUFFER.removeprefix("WITH ")
POINTS = f"""{REQUESTS}, {RETRIES}, {_BUFFER_PARTS},
received AS (SELECT stream_name, count(*) AS n_records, sum(n_bytes) AS n_bytes FROM sized GROUP BY ALL),
put AS (SELECT stream_name, shard_id, sum(n_records) AS n_records, sum(n_bytes) AS n_bytes, count(duration_s) AS c, min(duration_s) AS low,
               max(duration_s) AS high, sum(duration_s) AS total FROM requests GROUP BY ALL),
errors AS (SELECT stream_name, CASE WHEN invalid_reason IS NOT NULL THEN 'InvalidRecord' ELSE error_code END AS code, count(*) AS n
           FROM outcomes WHERE invalid_reason IS NOT NULL OR error_code IS NOT NULL GROUP BY ALL),
drops AS (SELECT stream_name, reason, count(*) AS n FROM buffer WHERE kind = 'dropped' GROUP BY ALL),
points AS (
  {_sum('user_records.received', '{record}', 'n_records', _S, 'received')} UNION ALL
  {_sum('user_records.bytes', 'By', 'n_bytes', _S, 'received')} UNION ALL
  {_sum('kinesis_records.put', '{record}', 'n_records', _SH, 'put')} UNION ALL
  {_sum('kinesis_records.bytes', 'By', 'n_bytes', _SH, 'put')} UNION ALL
  {_histogram('request.duration', 's', 'low', 'high', 'total', 'c', _SH, 'put')} UNION ALL
  {_histogram('retries', '{retry}', 'retries_min', 'retries_max', 'retries_sum', 'retries_count', _S, 'retries')} UNION ALL
  {_sum('errors', '{error}', 'n', "'error.code=' || code || ',stream.name=' || stream_name", 'errors')} UNION ALL
  {_sum('buffer.records.pending', '{record}', 'pending', _S, 'measured')} UNION ALL
  {_histogram('buffer.time', 's', 'min_waited', 'max_waited', 'sum_waited', 'n_waited', _S, 'measured')} UNION ALL
  {_sum('buffer.records.dropped', '{record}', 'n', "'reason=' || reason || ',stream.name=' || stream_name", 'drops')})"""


def dims_text(column):
    return F.array_join(F.transform(column, lambda d: F.concat(d["name"], F.lit("="), d["value"])), ",")


@query(
    "datums",
    f"""{POINTS} SELECT metric AS metric_name, CASE unit WHEN 'By' THEN 'Bytes' WHEN 's' THEN 'Seconds' ELSE 'Count' END AS unit,
          dims, value, min, max, sum, count::DOUBLE AS count, {TS_NS // 1_000_000}::BIGINT AS timestamp_ms FROM points""",
)
def datums(spark, sf_dir):
    made = metrics.to_datums(points(spark, sf_dir))
    statistics = [F.col(f"statistic_values.{c}").alias(c) for c in ("min", "max", "sum", "count")]
    return made.select("metric_name", "unit", dims_text("dimensions").alias("dims"), "value", *statistics, "timestamp_ms")


def event_points(spark, sf_dir):
    """One point per event: a sum for most, a histogram of the user's number for every fourth."""
    sampled = F.col("event_id") % 4 == 0
    sample = F.when(sampled, F.col("user_id").cast("double"))
    return table(spark, sf_dir, "events").select(
        F.when(sampled, "producer.request.duration").otherwise("producer.user_records.received").alias("metric"),
        F.when(sampled, "s").otherwise("{record}").alias("unit"),
        F.when(sampled, "histogram").otherwise("sum").alias("kind"),
        F.create_map(F.lit("stream.name"), F.concat(F.lit("stream-"), "event_type")).alias("attributes"),
        (micros("ts") * 1000).alias("ts_ns"),
        F.when(~sampled, F.lit(1.0)).alias("value"),
        sample.alias("min"),
        sample.alias("max"),
        sample.alias("sum"),
        F.when(sampled, F.lit(1).cast("bigint")).alias("count"),
    )


EVENT_POINTS = """WITH points AS (
  SELECT CASE WHEN event_id % 4 = 0 THEN 'producer.request.duration' ELSE 'producer.user_records.received' END AS metric,
         'stream.name=stream-' || event_type AS dims, epoch_us(ts) * 1000 AS ts_ns, CASE WHEN event_id % 4 <> 0 THEN 1.0::DOUBLE END AS value,
         CASE WHEN event_id % 4 = 0 THEN user_id::DOUBLE END AS sample FROM events)"""

HOUR_NS = 3_600_000_000_000


@query(
    "cumulative_points",
    f"""{EVENT_POINTS}, ticks AS (SELECT metric, dims, (ts_ns // {HOUR_NS} + 1) * {HOUR_NS} AS ts_ns, sum(value) AS value, min(sample) AS low,
             max(sample) AS high, sum(sample) AS total, count(sample) AS n FROM points GROUP BY ALL)
        SELECT metric, dims, ts_ns, sum(value) OVER w AS value, min(low) OVER w AS min, max(high) OVER w AS max, sum(total) OVER w AS sum,
               CAST(CASE WHEN metric LIKE '%duration' THEN sum(n) OVER w END AS BIGINT) AS count
        FROM ticks WINDOW w AS (PARTITION BY metric, dims ORDER BY ts_ns)""",
)
def cumulative_points(spark, sf_dir):
    running = metrics.cumulative_points(event_points(spark, sf_dir), HOUR_NS)
    dims = F.concat(F.lit("stream.name="), F.element_at("attributes", "stream.name"))
    return running.select("metric", dims.alias("dims"), "ts_ns", "value", "min", "max", "sum", "count")


@query(
    "datum_requests",
    f"""{EVENT_POINTS}, placed AS (SELECT *, ts_ns // 1000000 AS timestamp_ms FROM points),
        ticks AS (SELECT metric, dims, ts_ns // {HOUR_NS} AS tick, count(*) AS n FROM placed GROUP BY ALL),
        numbered AS (SELECT tick, (row_number() OVER (PARTITION BY tick ORDER BY metric, dims) - 1) // 3 AS request_no FROM ticks)
        SELECT CAST((tick + 1) * {HOUR_NS // 1_000_000} AS BIGINT) AS timestamp_ms, request_no, count(*) AS n_datums, 'KinesisProducerLibrary' AS namespace
        FROM numbered GROUP BY ALL""",
)
def numbered_datums(spark, sf_dir):
    """The hourly datums of all series, at most three per export request."""
    hourly = metrics.to_datums(metrics.cumulative_points(event_points(spark, sf_dir), HOUR_NS))
    requests = datum_requests(hourly, per_request=3)
    return requests.groupBy("namespace", "timestamp_ms", "request_no").agg(F.count("datum").alias("n_datums"))


@query(
    "metrics_window",
    f"""{EVENT_POINTS} SELECT metric, dims, sum(coalesce(value, sample)) AS sum, min(coalesce(value, sample)) AS min,
          max(coalesce(value, sample)) AS max, count(*) AS count FROM points
        WHERE metric = 'producer.request.duration' AND ts_ns > {TS_NS - 864_000 * 10**9} AND ts_ns <= {TS_NS} GROUP BY ALL""",
)
def trailing_window(spark, sf_dir):
    found = metrics.metrics_window(event_points(spark, sf_dir), TS_NS, name="producer.request.duration", seconds=864_000)
    dims = F.transform("dimensions", lambda e: F.struct(e["key"].alias("name"), e["value"].alias("value")))
    return found.select("metric", dims_text(dims).alias("dims"), "sum", "min", "max", "count")


@query(
    "outstanding",
    """SELECT 'stream-' || event_type AS stream_name, count(*) AS n_outstanding,
         CAST((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(min(ts))) // 1000 AS BIGINT) AS oldest_ms
       FROM events WHERE event_id % 6 = 0 GROUP BY event_type""",
)
def outstanding(spark, sf_dir):
    enqueued = table(spark, sf_dir, "events").select(F.concat(F.lit("stream-"), "event_type").alias("stream_name"), "event_id", "ts")
    completed = enqueued.filter("event_id % 6 <> 0")
    return metrics.outstanding(enqueued, completed, ["event_id"], F.lit(NOW).cast("timestamp_ntz"))
