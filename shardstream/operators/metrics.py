"""Producer and buffer metrics, their points, and the datums a monitoring service takes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import with_ordinal

# Datums per request, export namespace, units, attribute names, drop reasons.
DATUMS_PER_REQUEST = 1000
DATUM_NAMESPACE = "KinesisProducerLibrary"
UNITS = {"By": "Bytes", "s": "Seconds", "{record}": "Count", "{error}": "Count", "{retry}": "Count"}
STREAM, SHARD_ID, ERROR_CODE, REASON = "stream.name", "shard.id", "error.code", "reason"
QUEUE_FULL, SHUTDOWN = "queue_full", "shutdown"

POINT = ["metric", "unit", "kind", "attributes", "ts_ns", "value", "min", "max", "sum", "count"]


def received_metrics(records: DataFrame) -> DataFrame:
    """User records and bytes received per stream: once per put, invalid included, retries not."""
    return records.groupBy("stream_name").agg(F.count("*").alias("n_records"), F.sum("n_bytes").alias("n_bytes"))


def shard_put_metrics(requests: DataFrame) -> DataFrame:
    """Records and bytes sent and request durations per shard: every attempt, failed records included."""
    return requests.groupBy("stream_name", "shard_id").agg(
        F.sum("n_records").alias("n_records"),
        F.sum("n_bytes").alias("n_bytes"),
        *_histogram("duration_s", "duration"),
    )


def retry_metrics(attempts: DataFrame) -> DataFrame:
    """Retries-so-far per stream, one sample for each attempt of a put that left failures.

    ``attempts`` are put outcomes; the attempts are first made distinct, map-side.
    """
    failing = attempts.filter("error_code IS NOT NULL").select("stream_name", "put_id", "attempt").distinct()
    return failing.groupBy("stream_name").agg(*_histogram("attempt", "retries"))


def buffer_metrics(events: DataFrame) -> DataFrame:
    """Per stream: records pending in the buffer, waiting times in seconds, drops by reason."""
    kind, reason = F.col("kind"), F.col("reason")
    waited = F.when(kind == "dequeued", F.col("waited_s"))
    step = F.when(kind == "enqueued", 1).when(kind == "dequeued", -1).otherwise(0)
    dropped = lambda why: F.count_if((kind == "dropped") & (reason == why))
    return events.groupBy("stream_name").agg(
        F.sum(step).alias("pending"),
        F.count(waited).alias("n_waited"),
        F.min(waited).alias("min_waited"),
        F.max(waited).alias("max_waited"),
        F.sum(waited).alias("sum_waited"),
        dropped(QUEUE_FULL).alias("dropped_queue_full"),
        dropped(SHUTDOWN).alias("dropped_shutdown"),
    )


def pending_over_time(events: DataFrame, ts_us: str, width_us: int) -> DataFrame:
    """Records pending at the end of each interval. Summed per interval first: the running sum sees intervals, not rows."""
    step = F.when(F.col("kind") == "enqueued", 1).when(F.col("kind") == "dequeued", -1).otherwise(0)
    net = events.groupBy("stream_name", F.expr(f"{ts_us} div {width_us}").alias("interval_no")).agg(F.sum(step).alias("net"))
    so_far = Window.partitionBy("stream_name").orderBy("interval_no")
    return net.select("stream_name", "interval_no", F.sum("net").over(so_far).alias("pending"))


def _histogram(value: str, name: str):
    return [
        F.count(value).alias(f"{name}_count"),
        F.min(value).alias(f"{name}_min"),
        F.max(value).alias(f"{name}_max"),
        F.sum(value).alias(f"{name}_sum"),
    ]


def sum_point(metric: str, unit: str, value: str, attributes: dict[str, str], ts_ns: int) -> Column:
    """A sum point of a row of a metric table; ``attributes`` maps attribute names to columns."""
    null = F.lit(None).cast("double")
    return _point(metric, unit, "sum", attributes, ts_ns, F.col(value).cast("double"), null, null, null, F.lit(None))


def histogram_point(metric: str, unit: str, name: str, attributes: dict[str, str], ts_ns: int) -> Column:
    """A histogram point of a row, from the columns ``name``_min, _max, _sum and _count; null if it has no samples."""
    low, high, total = (F.col(f"{name}_{part}").cast("double") for part in ("min", "max", "sum"))
    count, null = F.col(f"{name}_count"), F.lit(None).cast("double")
    return F.when(count > 0, _point(metric, unit, "histogram", attributes, ts_ns, null, low, high, total, count))


def _point(metric, unit, kind, attributes, ts_ns, value, low, high, total, count):
    pairs = [part for name, column in attributes.items() for part in (F.lit(name), F.col(column))]
    values = [F.lit(metric), F.lit(unit), F.lit(kind), F.create_map(*pairs), F.lit(ts_ns).cast("bigint"), value, low, high, total, count.cast("bigint")]
    return F.struct(*[v.alias(name) for name, v in zip(POINT, values)])


def points_of(df: DataFrame, *points: Column) -> DataFrame:
    """All points of each row of a metric table, in one pass over it."""
    return df.select(F.inline(F.array_compact(F.array(*points))))


def producer_points(
    records: DataFrame, requests: DataFrame, outcomes: DataFrame, errors: DataFrame, ts_ns: int, prefix: str = "producer"
) -> DataFrame:
    """The seven producer metrics of a set of puts as points: one aggregation for each grain they have."""
    stream, shard = {STREAM: "stream_name"}, {STREAM: "stream_name", SHARD_ID: "shard_id"}
    code = {STREAM: "stream_name", ERROR_CODE: "error_code"}
    parts = [
        points_of(
            received_metrics(records),
            sum_point(f"{prefix}.user_records.received", "{record}", "n_records", stream, ts_ns),
            sum_point(f"{prefix}.user_records.bytes", "By", "n_bytes", stream, ts_ns),
        ),
        points_of(
            shard_put_metrics(requests),
            sum_point(f"{prefix}.kinesis_records.put", "{record}", "n_records", shard, ts_ns),
            sum_point(f"{prefix}.kinesis_records.bytes", "By", "n_bytes", shard, ts_ns),
            histogram_point(f"{prefix}.request.duration", "s", "duration", shard, ts_ns),
        ),
        points_of(retry_metrics(outcomes), histogram_point(f"{prefix}.retries", "{retry}", "retries", stream, ts_ns)),
        points_of(errors, sum_point(f"{prefix}.errors", "{error}", "n_errors", code, ts_ns)),
    ]
    return _union(parts)


def buffer_points(events: DataFrame, ts_ns: int, prefix: str = "producer") -> DataFrame:
    """The three buffer metrics as points, in one pass: first by stream and drop reason, then by stream."""
    kind = F.col("kind")
    waited = F.when(kind == "dequeued", F.col("waited_s"))
    step = F.when(kind == "enqueued", 1).when(kind == "dequeued", -1).otherwise(0)
    by_reason = events.groupBy("stream_name", F.when(kind == "dropped", F.col("reason")).alias("reason")).agg(
        F.sum(step).alias("pending"), F.count_if(kind == "dropped").alias("n"), *_histogram(waited, "time")
    )
    measured = by_reason.groupBy("stream_name").agg(
        F.sum("pending").alias("pending"),
        F.min("time_min").alias("time_min"),
        F.max("time_max").alias("time_max"),
        F.sum("time_sum").alias("time_sum"),
        F.sum("time_count").alias("time_count"),
        F.collect_list(F.when(F.col("n") > 0, F.struct("reason", "n"))).alias("drops"),
    )
    stream = {STREAM: "stream_name"}
    fixed = F.array(
        sum_point(f"{prefix}.buffer.records.pending", "{record}", "pending", stream, ts_ns),
        histogram_point(f"{prefix}.buffer.time", "s", "time", stream, ts_ns),
    )
    null, text = F.lit(None).cast("double"), F.lit("{record}")

    def dropped(drop):
        attributes = F.create_map(F.lit(STREAM), F.col("stream_name"), F.lit(REASON), drop["reason"])
        values = [F.lit(f"{prefix}.buffer.records.dropped"), text, F.lit("sum"), attributes, F.lit(ts_ns).cast("bigint"), drop["n"].cast("double"), null, null, null, F.lit(None).cast("bigint")]
        return F.struct(*[v.alias(name) for name, v in zip(POINT, values)])

    return measured.select(F.inline(F.array_compact(F.concat(fixed, F.transform("drops", dropped)))))


def _union(parts):
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def cumulative_points(points: DataFrame, tick_ns: int) -> DataFrame:
    """Points of single events summed from the start up to the end of each export tick.

    Points are combined per tick first; the running window then holds one row per tick of a series.
    """
    series = ["metric", "unit", "kind", "__attributes"]
    keyed = points.withColumn("__attributes", F.array_sort(F.map_entries("attributes")))
    per_tick = keyed.groupBy(*series, ((F.expr(f"ts_ns div {tick_ns}") + 1) * tick_ns).alias("ts_ns")).agg(
        F.sum("value").alias("value"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.sum("sum").alias("sum"),
        F.sum("count").alias("count"),
    )
    so_far = Window.partitionBy(*series).orderBy("ts_ns")
    running = per_tick.select(
        *series,
        "ts_ns",
        F.sum("value").over(so_far).alias("value"),
        F.min("min").over(so_far).alias("min"),
        F.max("max").over(so_far).alias("max"),
        F.sum("sum").over(so_far).alias("sum"),
        F.sum("count").over(so_far).alias("count"),
    )
    return running.withColumn("attributes", F.map_from_entries("__attributes")).select(*POINT)


def to_datums(points: DataFrame) -> DataFrame:
    """Points as datums: sums carry a value, histograms a statistic set, any other kind is left out."""
    unit = F.lit("None")
    for annotation, name in UNITS.items():
        unit = F.when(F.col("unit") == annotation, name).otherwise(unit)
    dimensions = F.transform(
        F.array_sort(F.map_entries("attributes")), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("value"))
    )
    statistics = F.struct("min", "max", "sum", F.col("count").cast("double").alias("count"))
    return points.filter(F.col("kind").isin("sum", "histogram")).select(
        F.col("metric").alias("metric_name"),
        F.when(F.col("kind") == "sum", F.col("value")).alias("value"),
        F.when(F.col("kind") == "histogram", statistics).alias("statistic_values"),
        unit.alias("unit"),
        dimensions.alias("dimensions"),
        F.expr("ts_ns div 1000000").alias("timestamp_ms"),
    )


def number_requests(
    datums: DataFrame, keys: list[str], order: list[str], per_request: int = DATUMS_PER_REQUEST
) -> DataFrame:
    """Add ``request_no``: at most ``per_request`` datums of a group go into one export request."""
    numbered = with_ordinal(datums, keys, order, "__at")
    return numbered.withColumn("request_no", F.expr(f"__at div {per_request}")).drop("__at")


def metrics_window(
    points: DataFrame, now_ns: int, name: str | None = None, seconds: int | None = None
) -> DataFrame:
    """Metric totals, optionally of one metric and of the trailing window of ``seconds`` before ``now_ns``."""
    if name is not None:
        points = points.filter(F.col("metric") == name)
    if seconds is not None:
        points = points.filter((F.col("ts_ns") > now_ns - seconds * 1_000_000_000) & (F.col("ts_ns") <= now_ns))
    series = ["metric", "unit", "dimensions"]
    keyed = points.withColumn("dimensions", F.array_sort(F.map_entries("attributes")))
    sample = F.coalesce("value", "sum")
    return keyed.groupBy(*series).agg(
        F.sum(sample).alias("sum"),
        F.min(F.coalesce("value", "min")).alias("min"),
        F.max(F.coalesce("value", "max")).alias("max"),
        F.sum(F.coalesce("count", F.lit(1))).alias("count"),
    )


def outstanding(enqueued: DataFrame, completed: DataFrame, keys: list[str], now) -> DataFrame:
    """Records of each stream not completed yet, and the age in milliseconds of the oldest.

    ``enqueued`` has ``keys``, stream_name and ts; ``keys`` identify a record.
    """
    now = F.lit(now) if not hasattr(now, "_jc") else now
    pending = enqueued.join(completed.select(*keys), keys, "left_anti")
    return pending.groupBy("stream_name").agg(
        F.count("*").alias("n_outstanding"), F.timestamp_diff("MILLISECOND", F.min("ts"), now).alias("oldest_ms")
    )
