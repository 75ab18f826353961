"""Queries whose streams run slice by slice of time, each slice a new run that goes on from the last; results equal those of the whole tables."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from ...functions.records import with_payload_size
from ...operators import consume, routing
from ...session import scratch_path
from ...streaming.chunks import drain, group_within_event_time, group_within_stream
from ...streaming.ends import end_shards, shard_end_stream
from ...streaming.metrics import cumulative_points_stream, export_stream, outstanding_stream, window_totals_stream
from ...streaming.process import commit_gated_stream, keep_rates, read_checkpoints, read_rates, route_rates
from ..testtables import consumer_log, listing, micros, table
from .batching_queries import GROUPED, SIX_HOURS_US
from .consume_queries import _STATES_SQL, COMPARED, event_id, lifecycle, thinned
from .metric_queries import EVENT_POINTS, HOUR_NS, dims_text, event_points
from .registry import LOG, ORACLES, RECORDS, query, ranges_sql
from .routing_queries import FOUR, LOOKUP
from .stream_queries import NOW_TRIGGER, finish, stream_log

SLICES, MANY_SLICES = 2, 4
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_US = 86_400_000_000


@contextmanager
def rocks_state(spark):
    """Streams started inside keep their state in RocksDB, as those with timers need."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def at_time():
    return F.timestamp_micros("at_us").alias("at")


class Slices:
    """Tables with a column ``at_us`` whose rows come slice by slice of time, as streams that run once for each slice."""

    def __init__(self, spark, slices=SLICES, **tables):
        self.spark, self.slices, self.tables, self.base = spark, slices, tables, scratch_path(spark, "live")
        ranges = [df.agg(F.min("at_us"), F.max("at_us")).first() for df in tables.values()]
        self.first = min((r[0] for r in ranges if r[0] is not None), default=0)
        self.last = max((r[1] for r in ranges if r[1] is not None), default=0)
        self.width = (self.last - self.first) // slices + 1

    def run(self, start, marks=None):
        """Land a slice, run the stream over it to its end, and so on; then ``marks``, rows of the tables that are later than all others."""
        for k in range(self.slices + bool(marks)):
            for name, df in self.tables.items():
                late = marks.get(name) if k == self.slices else None
                part = df.filter(F.expr(f"(at_us - {self.first}) div {self.width}") == k) if k < self.slices else df.limit(0) if late is None else late
                part.write.mode("append").parquet(f"{self.base}/{name}")
            streams = {n: self.spark.readStream.schema(df.schema).parquet(f"{self.base}/{n}") for n, df in self.tables.items()}
            finish(start(streams, f"{self.base}/progress"))

    def mark(self, name, values, at_us):
        """A row of a table with the given values and null else, at a time."""
        df = self.tables[name]
        row = [F.lit(at_us if f.name == "at_us" else values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
        return self.spark.range(1).select(*row)


def appended(spark, base, sdf, checkpoint):
    """Write a stream's rows below ``base`` in runs."""
    writer = sdf.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", checkpoint)
    return writer.trigger(**NOW_TRIGGER).start()


# ---- chunks ---------------------------------------------------------------------------------


def chunked_log(spark, sf_dir):
    log = consumer_log(spark, sf_dir)
    return log.select("stream_name", event_id(), micros("arrival").alias("at_us"))


def live_chunks(spark, sf_dir, closes):
    slices = Slices(spark, log=chunked_log(spark, sf_dir))

    def start(streams, progress):
        timed = streams["log"].withColumn("at", at_time())
        chunks = group_within_event_time(timed, 50, SIX_HOURS_US, ["stream_name"], "at", ["event_id"], closes)
        return appended(spark, slices.base, chunks, progress)

    with rocks_state(spark):
        slices.run(start, {"log": slices.mark("log", {"stream_name": "mark"}, slices.last + DAY_US)})
    return spark.read.parquet(f"{slices.base}/out").filter("stream_name <> 'mark'")


@query("stream_group_within", GROUPED)
def stream_group_within(spark, sf_dir):
    """The chunks of the live log, by the records' own times: those of the whole log."""
    return live_chunks(spark, sf_dir, False).select("event_id", "chunk_no", "place_in_chunk")


CLOSED = f"""SELECT stream_name, chunk_no, count(*) AS n_records, CASE WHEN count(*) = 50 THEN 'count' ELSE 'time' END AS closed_by
FROM ({GROUPED}) g JOIN (SELECT event_id, 'stream-' || event_type AS stream_name FROM events) e USING (event_id) GROUP BY ALL"""


@query("stream_chunks_closed", CLOSED)
def stream_chunks_closed(spark, sf_dir):
    """What was told of each chunk when it closed."""
    closed = live_chunks(spark, sf_dir, True).filter("closed_by IS NOT NULL")
    return closed.select("stream_name", "chunk_no", F.col("place_in_chunk").alias("n_records"), "closed_by")


@query(
    "stream_chunks_by_clock",
    f"""WITH {LOG}, placed AS (SELECT *, (row_number() OVER (PARTITION BY stream_name, shard_id ORDER BY event_id) - 1) // 50 AS chunk_no FROM log)
        SELECT stream_name, shard_id, chunk_no, count(*) AS n_records, count(*) = 50 AS closed FROM placed GROUP BY ALL""",
)
def stream_chunks_by_clock(spark, sf_dir):
    """Chunks by the clock, which in ten minutes closes none here: their sizes, and which of them told that they were full."""
    base = scratch_path(spark, "chunks")
    log = stream_log(spark, sf_dir).select("stream_name", "shard_id", "sequence_number")
    with rocks_state(spark):
        chunked = group_within_stream(log, 50, 600_000, ["stream_name", "shard_id"], closes=True)
        writer = chunked.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/progress")
        drain(writer.trigger(processingTime="200 milliseconds").start())
    rows = spark.read.parquet(f"{base}/out")
    return rows.groupBy("stream_name", "shard_id", "chunk_no").agg(
        F.count_if(F.col("closed_by").isNull()).alias("n_records"), F.coalesce(F.bool_or(F.col("closed_by") == "count"), F.lit(False)).alias("closed")
    )


# ---- rates ----------------------------------------------------------------------------------


def timed_records(spark, sf_dir):
    """Records with their size and their event time."""
    event = table(spark, sf_dir, "events")
    data = F.concat_ws("|", F.col("event_id").cast("string"), "event_type", "props").cast("binary")
    shaped = event.select(
        F.concat(F.lit("stream-"), "event_type").alias("stream_name"),
        F.col("user_id").cast("string").alias("partition_key"),
        data.alias("data"),
        micros("ts").alias("at_us"),
    )
    return with_payload_size(shaped).drop("data")


@query(
    "stream_route_rates",
    f"""WITH {RECORDS}, {ranges_sql(FOUR)}, {LOOKUP}
        SELECT epoch_us(time_bucket(INTERVAL 1 DAY, ts)) AS window_us, stream_name, shard_id, count(*) AS n_records,
               CAST(sum(n_bytes) AS BIGINT) AS n_bytes FROM routed GROUP BY ALL""",
)
def stream_route_rates(spark, sf_dir):
    """Daily records and bytes per shard of a routed stream, all days, kept as they change."""
    shards = routing.shard_map(listing(spark, sf_dir, FOUR))
    slices = Slices(spark, MANY_SLICES, records=timed_records(spark, sf_dir))

    def start(streams, progress):
        routed = routing.predict_shard(streams["records"].withColumn("ts", F.timestamp_micros("at_us")), shards)
        return keep_rates(route_rates(routed, "ts", "1 day", "1 hour"), f"{slices.base}/rates", progress, NOW_TRIGGER)

    slices.run(start)
    return read_rates(spark, f"{slices.base}/rates").withColumn("window_us", F.unix_micros("window_start")).drop("window_start")


# ---- commits and ends -----------------------------------------------------------------------

SLICED = f"""WITH {LOG}, edges AS (SELECT min(epoch_us(ts)) AS first, (max(epoch_us(ts)) - min(epoch_us(ts))) // {MANY_SLICES} + 1 AS width FROM events),
sliced AS (SELECT log.*, (epoch_us(arrival) - first) // width AS slice FROM log, edges)"""


@query(
    "stream_commit",
    f"""{SLICED}, numbered AS (SELECT unnest(range({MANY_SLICES})) AS slice),
        reports AS (SELECT stream_name, shard_id, slice, arrival, ({_STATES_SQL})[event_id % 6 + 1] AS state FROM sliced),
        known AS (SELECT stream_name, shard_id, n.slice, arg_max(state, arrival) AS state FROM reports r JOIN numbered n ON r.slice <= n.slice GROUP BY ALL),
        ends AS (SELECT stream_name, shard_id, slice, max(sequence_number) AS sequence_number FROM sliced GROUP BY ALL)
        SELECT stream_name, shard_id, max(sequence_number) AS sequence_number, 0::BIGINT AS sub_sequence_number
        FROM ends JOIN known USING (stream_name, shard_id, slice) WHERE state IN ('Processing', 'ShardEnded') GROUP BY ALL""",
)
def stream_commit(spark, sf_dir):
    """Checkpoints left by a stream that commits by the states that its processors had reported by then."""
    log = consumer_log(spark, sf_dir).withColumn("at_us", micros("arrival"))
    reports = lifecycle(spark, sf_dir).withColumn("at_us", micros("ts")).drop("ts")
    slices = Slices(spark, MANY_SLICES, log=log, reports=reports)
    folder = slices.base

    def start(streams, progress):
        states = streams["reports"].withColumn("ts", F.timestamp_micros("at_us"))
        return commit_gated_stream(streams["log"].drop("at_us"), states, f"{folder}/out", f"{folder}/store", f"{folder}/states", progress, NOW_TRIGGER)

    slices.run(start)
    return read_checkpoints(spark, f"{folder}/store")


ENDED = ("shardId-000000000000", "shardId-000000000002")
ENDS = f"""WITH {LOG}, ends AS (SELECT stream_name, shard_id, max(arrival) AS ended_at, max(sequence_number) AS sequence_number, max(event_id) AS last FROM log
                     WHERE shard_id IN {ENDED} GROUP BY ALL),
done AS (SELECT stream_name, shard_id, max(event_id) AS done FROM log WHERE event_id % 4 < 3 GROUP BY ALL),
status AS (SELECT stream_name, shard_id, sequence_number, CASE WHEN done >= last THEN 'complete'
    WHEN epoch_ms((SELECT max(arrival) FROM log)) - epoch_ms(ended_at) >= {2 * 3_600_000} THEN 'timed_out' ELSE 'waiting' END AS status
  FROM ends LEFT JOIN done USING (stream_name, shard_id))"""


def ending_shards(spark, sf_dir):
    """Run the ends of shards 0 and 2 of each stream, which end with their last record; one in four records is never committed."""
    log = consumer_log(spark, sf_dir).withColumn("at_us", micros("arrival")).select(
        "stream_name", "shard_id", "sequence_number", "sub_sequence_number", "at_us"
    )
    ends = log.filter(F.col("shard_id").isin(*ENDED)).groupBy("stream_name", "shard_id").agg(F.max("at_us").alias("at_us"))
    slices = Slices(spark, log=log, commits=log.filter(event_id() % 4 < 3), ends=ends)
    folder = slices.base

    def start(streams, progress):
        timed = [streams[name].withColumn("at", at_time()) for name in ("log", "commits", "ends")]
        return end_shards(shard_end_stream(*timed, 2 * 3_600_000), f"{folder}/out", f"{folder}/store", progress, raise_on_timeout=False, trigger=NOW_TRIGGER)

    with rocks_state(spark):
        slices.run(start)
    return spark.read.parquet(f"{folder}/out"), f"{folder}/store"


@query("stream_shard_ends", f"{ENDS} SELECT stream_name, shard_id, status, status <> 'waiting' AS final_checkpoint FROM status")
def stream_shard_ends(spark, sf_dir):
    """What the live stream said last of each ended shard: the status that the whole log gives."""
    said, _ = ending_shards(spark, sf_dir)
    last = said.groupBy("stream_name", "shard_id").agg(F.max(F.struct("step", "status", "final_checkpoint")).alias("last"))
    return last.select("stream_name", "shard_id", "last.status", "last.final_checkpoint")


@query("stream_final_checkpoints", f"{ENDS} SELECT stream_name, shard_id, sequence_number, 0::BIGINT AS sub_sequence_number FROM status WHERE status <> 'waiting'")
def stream_final_checkpoints(spark, sf_dir):
    """The final checkpoints of the shards that were done, or given up."""
    return read_checkpoints(spark, ending_shards(spark, sf_dir)[1])


# ---- metrics --------------------------------------------------------------------------------


def live_points(spark, sf_dir):
    return event_points(spark, sf_dir).withColumn("at_us", F.expr("ts_ns div 1000"))


def run_points(spark, sf_dir, start):
    slices = Slices(spark, points=live_points(spark, sf_dir))
    end = (slices.last * 1000 // HOUR_NS + 1) * HOUR_NS // 1000 + 1000  # just past the end of the last hour
    mark = slices.mark("points", {"metric": "mark", "unit": "", "kind": "mark", "ts_ns": end * 1000}, end)
    with rocks_state(spark):
        slices.run(lambda streams, progress: start(streams["points"].drop("at_us"), slices.base, progress), {"points": mark})
    return slices.base


@query("stream_cumulative_points", ORACLES["cumulative_points"])
def stream_cumulative_points(spark, sf_dir):
    """Hourly exports of cumulative series, as the stream's time came to them."""
    write = lambda points, base, progress: appended(spark, base, cumulative_points_stream(points, HOUR_NS // 1_000_000), progress)
    running = spark.read.parquet(f"{run_points(spark, sf_dir, write)}/out").filter("metric <> 'mark'")
    dims = F.concat(F.lit("stream.name="), F.element_at("attributes", "stream.name"))
    return running.select("metric", dims.alias("dims"), "ts_ns", "value", "min", "max", "sum", "count")


@query("stream_datum_requests", ORACLES["datum_requests"])
def stream_datum_requests(spark, sf_dir):
    """The numbered requests that the exports wrote."""
    write = lambda points, base, progress: export_stream(points, f"{base}/requests", progress, HOUR_NS // 1_000_000, per_request=3, trigger=NOW_TRIGGER)
    written = spark.read.json(f"{run_points(spark, sf_dir, write)}/requests")
    return written.groupBy("namespace", "timestamp_ms", "request_no").agg(F.count("datum").alias("n_datums"))


WINDOWS = [0, 1, 6, 60]


@query(
    "stream_metric_windows",
    f"""{EVENT_POINTS}, panes AS (SELECT metric, dims, coalesce(value, sample) AS sample, (ts_ns + {HOUR_NS} - 1) // {HOUR_NS} AS ends FROM points),
        now AS (SELECT max(ts_ns) // {HOUR_NS} + 1 AS now FROM points)
        SELECT metric, dims, w.panes::INTEGER AS panes, sum(sample) AS sum, min(sample) AS min, max(sample) AS max, count(*) AS count
        FROM panes, now, (SELECT unnest({WINDOWS}) AS panes) w WHERE w.panes = 0 OR ends > now - w.panes GROUP BY ALL""",
)
def stream_metric_windows(spark, sf_dir):
    """Totals of trailing windows of so many hours (0: all) when the stream ended."""
    write = lambda points, base, progress: appended(spark, base, window_totals_stream(points, WINDOWS, HOUR_NS // 1_000_000), progress)
    told = spark.read.parquet(f"{run_points(spark, sf_dir, write)}/out").filter("metric <> 'mark'")
    end = told.agg(F.max("now_ms")).first()[0]
    keys = ["metric", "dims", "panes"]
    told = told.withColumn("dims", dims_text(F.transform("dimensions", lambda e: F.struct(e["key"].alias("name"), e["value"].alias("value")))))
    last = told.groupBy(*keys).agg(F.max(F.struct("now_ms", "sum", "min", "max", "count")).alias("last"))
    # what all came to holds until it changes; a window that says nothing at the end is empty then
    return last.filter(f"panes = 0 OR last.now_ms = {end or 0}").select(*keys, *[F.col(f"last.{c}").alias(c) for c in ("sum", "min", "max", "count")])


TICK_US = SIX_HOURS_US


@query(
    "stream_outstanding",
    f"""WITH open AS (SELECT 'stream-' || event_type AS stream_name, event_id, epoch_us(ts) AS since,
             CASE WHEN event_id % 6 <> 0 THEN epoch_us(ts) + 3600000000 * (1 + event_id % 30) END AS upto FROM events),
        ticks AS (SELECT DISTINCT stream_name, (since // {TICK_US} + 1) * {TICK_US} AS now FROM open
                  UNION SELECT DISTINCT stream_name, (upto // {TICK_US} + 1) * {TICK_US} FROM open WHERE upto IS NOT NULL)
        SELECT t.stream_name, t.now // 1000 AS now_ms, count(event_id) AS n_outstanding, CAST((t.now - min(since)) // 1000 AS BIGINT) AS oldest_ms
        FROM ticks t LEFT JOIN open o ON o.stream_name = t.stream_name AND since < t.now AND (upto IS NULL OR upto >= t.now) GROUP BY t.stream_name, t.now""",
)
def stream_outstanding(spark, sf_dir):
    """Records that were open at each tick, and the age of the oldest; five in six are completed 1 to 30 hours later."""
    event = table(spark, sf_dir, "events").select(F.concat(F.lit("stream-"), "event_type").alias("stream_name"), "event_id", micros("ts").alias("at_us"))
    completed = event.filter("event_id % 6 <> 0").withColumn("at_us", F.expr("at_us + 3600000000 * (1 + event_id % 30)"))
    slices = Slices(spark, enqueued=event, completed=completed)

    def start(streams, progress):
        timed = [streams[name].withColumn("at", at_time()) for name in ("enqueued", "completed")]
        return appended(spark, slices.base, outstanding_stream(*timed, ["event_id"], "at", TICK_US // 1000), progress)

    with rocks_state(spark):
        slices.run(start, {"enqueued": slices.mark("enqueued", {"stream_name": "mark"}, slices.last + 2 * DAY_US)})
    return spark.read.parquet(f"{slices.base}/out").filter("stream_name <> 'mark'")


# ---- reconciliation -------------------------------------------------------------------------


@query("stream_reconcile", f"{COMPARED} SELECT event_id, n_produced, n_consumed, status FROM compared")
def stream_reconcile(spark, sf_dir):
    """Produced against consumed records, compared while both run; consumers are an hour late, or two."""
    produced, consumed = thinned(spark, sf_dir)
    times = table(spark, sf_dir, "events").select("event_id", micros("ts").alias("at_us"))
    late = F.expr("at_us + 3600000000 * (1 + abs(event_id) % 2)")
    produced = produced.join(times, "event_id")
    consumed = consumed.join(times.withColumnRenamed("event_id", "of"), F.abs(F.col("event_id")) == F.col("of")).drop("of").withColumn("at_us", late)
    slices = Slices(spark, produced=produced, consumed=consumed)

    def start(streams, progress):
        timed = [streams[name].withColumn("at", at_time()) for name in ("produced", "consumed")]
        return appended(spark, slices.base, consume.reconcile_stream(*timed, ["event_id"], "at", "3 hours"), progress)

    slices.run(start, {"produced": slices.mark("produced", {"stream_name": "mark"}, slices.last + 2 * DAY_US)})
    return spark.read.parquet(f"{slices.base}/out").filter("event_id IS NOT NULL")
