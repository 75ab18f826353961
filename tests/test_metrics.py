from pyspark.sql import functions as F

from shardstream.operators import metrics as M
from shardstream.sources.datums import datum_requests, write_datums

POINT = "metric string, unit string, kind string, attributes map<string,string>, ts_ns long, value double, min double, max double, sum double, count long"


def test_buffer(spark):
    rows = [("s", "enqueued", None, None), ("s", "enqueued", None, None), ("s", "dequeued", 0.02, None), ("s", "dropped", None, "queue_full")]
    events = spark.createDataFrame(rows, "stream_name string, kind string, waited_s double, reason string")
    row = M.buffer_metrics(events).first()
    assert (row.pending, row.n_waited, row.sum_waited, row.dropped_queue_full, row.dropped_shutdown) == (1, 1, 0.02, 1, 0)
    points = {p.metric: p for p in M.buffer_points(events, 7).collect()}
    assert points["producer.buffer.records.pending"].value == 1
    assert points["producer.buffer.time"]["count"] == 1
    assert points["producer.buffer.records.dropped"].attributes == {"stream.name": "s", "reason": "queue_full"}


def test_producer_points(spark):
    received = spark.createDataFrame([("s", 50)] * 5, "stream_name string, n_bytes long")
    requests = spark.createDataFrame([("s", "shard-1", 3, 150, 0.012)], "stream_name string, shard_id string, n_records long, n_bytes long, duration_s double")
    outcomes = spark.createDataFrame(
        [("s", 0, 0, "x"), ("s", 0, 0, "x"), ("s", 0, 1, "x"), ("s", 0, 2, "x"), ("s", 0, 3, None)], "stream_name string, put_id long, attempt int, error_code string"
    )
    errors = spark.createDataFrame([("s", "x", 1)], "stream_name string, error_code string, n_errors long")
    points = {p.metric: p for p in M.producer_points(received, requests, outcomes, errors, 9, prefix="p").collect()}
    assert len(points) == 7
    assert (points["p.user_records.received"].value, points["p.user_records.bytes"].value) == (5, 250)
    assert (points["p.kinesis_records.put"].value, points["p.kinesis_records.bytes"].value) == (3, 150)
    assert points["p.request.duration"].max == 0.012 and points["p.request.duration"].attributes["shard.id"] == "shard-1"
    retries = points["p.retries"]
    assert (retries["count"], retries.min, retries.max, retries.sum) == (3, 0, 2, 3)
    assert points["p.errors"].attributes == {"stream.name": "s", "error.code": "x"}


def test_datums(spark):
    rows = [
        ("a", "{record}", "sum", {"z": "1", "b": "2"}, 2_000_000, 3.0, None, None, None, None),
        ("b", "s", "histogram", {}, 1_999_999, None, 1.0, 5.0, 6.0, 2),
        ("c", "furlongs", "sum", {}, 0, 1.0, None, None, None, None),
        ("d", "By", "gauge", {}, 0, 1.0, None, None, None, None),
    ]
    datums = {d.metric_name: d for d in M.to_datums(spark.createDataFrame(rows, POINT)).collect()}
    assert sorted(datums) == ["a", "b", "c"]
    a, b = datums["a"], datums["b"]
    assert (a.value, a.unit, a.timestamp_ms, a.statistic_values) == (3.0, "Count", 2, None)
    assert [d.name for d in a.dimensions] == ["b", "z"]
    assert (b.value, b.unit, b.timestamp_ms) == (None, "Seconds", 1)
    assert tuple(b.statistic_values) == (1.0, 5.0, 6.0, 2.0)
    assert datums["c"].unit == "None"


def test_requests_hold_at_most_their_limit(spark, tmp_path):
    rows = [("m", "By", "sum", {"i": str(i)}, t, 1.0, None, None, None, None) for i in range(25) for t in (0, 10**6)]
    datums = M.to_datums(spark.createDataFrame(rows, POINT))
    sizes = datum_requests(datums, per_request=10).groupBy("timestamp_ms", "request_no").count().collect()
    assert sorted(s["count"] for s in sizes) == [5, 5, 10, 10, 10, 10]
    write_datums(datums, str(tmp_path / "d"))
    assert spark.read.json(str(tmp_path / "d")).count() == 50


def test_cumulative(spark):
    rows = [("m", "By", "sum", {"s": "x"}, t, v, None, None, None, None) for t, v in [(0, 1.0), (5, 2.0), (12, 4.0), (31, 8.0)]]
    points = M.cumulative_points(spark.createDataFrame(rows, POINT), 10).orderBy("ts_ns").collect()
    assert [(p.ts_ns, p.value) for p in points] == [(10, 3.0), (20, 7.0), (40, 15.0)]


def test_window_by_name_and_time(spark):
    s = 10**9
    rows = [(n, "By", "sum", {}, t * s, 1.0, None, None, None, None) for n in "ab" for t in range(1, 11)]
    points = spark.createDataFrame(rows, POINT)
    total = lambda **kw: {r.metric: r.sum for r in M.metrics_window(points, 10 * s, **kw).collect()}
    assert total() == {"a": 10, "b": 10}
    assert total(name="a", seconds=3) == {"a": 3}


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_points_and_messages_take_few_passes(spark, tmp_path):
    from shardstream.operators import produce

    schema = (
        "stream_name string, put_id long, attempt int, batch_no long, shard_id string, request_index long, seq_in_put int, n_bytes int,"
        " invalid_reason string, error_code string, error_message string, duration_s double"
    )
    path = str(tmp_path / "outcomes")
    spark.createDataFrame([], schema).write.parquet(path)
    outcomes = spark.read.parquet(path)
    assert scans(produce.error_messages(outcomes)) <= 3
    points = M.producer_points(outcomes, produce.requests(outcomes), outcomes, produce.error_counts(outcomes), 9)
    assert scans(points) == 4
    events = outcomes.select("stream_name", F.col("error_code").alias("kind"), F.col("duration_s").alias("waited_s"), F.col("error_message").alias("reason"))
    assert scans(M.buffer_points(events, 9)) == 1
