"""Queries of the consuming side: positions, checkpoints, shard ends, many streams, events, catalog."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from ...config import Position
from ...functions.positions import order_by_position
from ...functions.records import data_text
from ...operators import checkpoints as C
from ...operators import consume
from ...sources import catalog, lambda_events, record_log
from ..testtables import consumer_log, micros, records, table
from .registry import LOG, query

MIDDLE = dt.datetime(2024, 1, 15, 12, 0, 0)
NOW = dt.datetime(2024, 2, 1, 0, 0, 0)
NOW_SQL = "TIMESTAMP '2024-02-01 00:00:00'"
MIDDLE_SQL = "TIMESTAMP '2024-01-15 12:00:00'"


def early(spark, sf_dir):
    """The log up to the middle of the month: what was there when a consumer started or committed."""
    return consumer_log(spark, sf_dir).filter(F.col("arrival") < F.lit(MIDDLE).cast("timestamp_ntz"))


STORED = f"""WITH {LOG}, early AS (SELECT * FROM log WHERE arrival < {MIDDLE_SQL}),
stored AS (SELECT stream_name, shard_id, max(sequence_number) AS sequence_number FROM early
           WHERE shard_id <> 'shardId-000000000003' GROUP BY ALL)"""


def stored(spark, sf_dir):
    """Checkpoints of all shards but the last at the middle of the month."""
    return C.checkpoints(early(spark, sf_dir).filter("shard_id <> 'shardId-000000000003'"))


def event_id():
    return F.substring("sequence_number", 30, 27).cast("bigint").alias("event_id")


@query(
    "checkpoints",
    f"WITH {LOG} SELECT stream_name, shard_id, max(sequence_number) AS sequence_number, 0::BIGINT AS sub_sequence_number FROM log GROUP BY ALL",
)
def checkpoints(spark, sf_dir):
    return C.checkpoints(consumer_log(spark, sf_dir))


@query(
    "checkpoints_unpadded",
    """SELECT 'stream-' || event_type AS stream_name, 'shardId-' || lpad((user_id % 4)::VARCHAR, 12, '0') AS shard_id,
         event_id // 1000 AS chunk, max(event_id)::VARCHAR AS sequence_number, 0::BIGINT AS sub_sequence_number FROM events GROUP BY ALL""",
)
def checkpoints_unpadded(spark, sf_dir):
    """Per chunk of 1000 events, with sequence numbers of different widths: 9 comes before 10."""
    log = consumer_log(spark, sf_dir).withColumn("chunk", F.expr("CAST(substring(sequence_number, 30, 27) AS BIGINT) div 1000"))
    bare = log.withColumn("sequence_number", event_id().cast("string"))
    return C.checkpoints(bare, by=("chunk",))


@query(
    "merge_checkpoints",
    f"""WITH {LOG}, old AS (SELECT stream_name, shard_id, max(event_id) AS e FROM log WHERE event_id % 2 = 0 GROUP BY ALL),
        new AS (SELECT stream_name, shard_id, max(event_id) AS e FROM log WHERE event_id % 3 = 0 GROUP BY ALL)
        SELECT stream_name, shard_id, lpad(max(e)::VARCHAR, 56, '0') AS sequence_number, 0::BIGINT AS sub_sequence_number
        FROM (SELECT * FROM old UNION ALL SELECT * FROM new) GROUP BY ALL""",
)
def merge_checkpoints(spark, sf_dir):
    log = consumer_log(spark, sf_dir)
    old, new = (C.checkpoints(log.filter(event_id() % n == 0)) for n in (2, 3))
    return C.merge_checkpoints(old, new)


STATES = ["Created", "Initialized", "Processing", "ShardEnded", "Shutdown", "LeaseLost"]


def lifecycle(spark, sf_dir):
    """Each event as a state report of its shard's processor, by one of three workers."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("stream-"), "event_type").alias("stream_name"),
        F.format_string("shardId-%012d", F.col("user_id") % 4).alias("shard_id"),
        F.concat(F.lit("worker-"), (F.col("user_id") % 3).cast("string")).alias("worker"),
        F.get(F.array(*[F.lit(s) for s in STATES]), (F.col("event_id") % 6).cast("int")).alias("state"),
        "ts",
    )


_STATES_SQL = "[" + ", ".join(f"'{s}'" for s in STATES) + "]"
LIFECYCLE = f"""WITH {LOG}, states AS (
  SELECT stream_name, shard_id, 'worker-' || (user_id % 3)::VARCHAR AS worker, ({_STATES_SQL})[event_id % 6 + 1] AS state, arrival AS ts
  FROM log),
latest AS (SELECT stream_name, shard_id, arg_max(worker, ts) AS worker, arg_max(state, ts) AS state, max(ts) AS ts
           FROM states GROUP BY ALL)"""


@query(
    "latest_state",
    f"{LIFECYCLE} SELECT stream_name, shard_id, worker, state, CAST(epoch_us(ts) AS BIGINT) AS ts_us FROM latest",
)
def latest_state(spark, sf_dir):
    last = C.latest_state(lifecycle(spark, sf_dir))
    return last.select("stream_name", "shard_id", "worker", "state", micros("ts").alias("ts_us"))


@query(
    "workers_started",
    """WITH w AS (SELECT 'worker-' || (user_id % 30)::VARCHAR AS worker, ts,
                       CASE event_id % 3 WHEN 0 THEN 'CREATED' WHEN 1 THEN 'STARTED' ELSE 'SHUT_DOWN' END AS state FROM events)
       SELECT worker, arg_max(state, ts) AS state, arg_max(state, ts) = 'STARTED' AS started FROM w GROUP BY worker""",
)
def workers_started(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("worker-"), (F.col("user_id") % 30).cast("string")).alias("worker"),
        F.get(F.array(F.lit("CREATED"), F.lit("STARTED"), F.lit("SHUT_DOWN")), (F.col("event_id") % 3).cast("int")).alias("state"),
        "ts",
    )
    return C.workers_started(events)


@query(
    "can_checkpoint",
    f"""{LIFECYCLE} SELECT event_id, state IN ('Processing', 'ShardEnded') AS can_checkpoint
        FROM log JOIN latest USING (stream_name, shard_id)""",
)
def can_checkpoint(spark, sf_dir):
    states = C.latest_state(lifecycle(spark, sf_dir))
    return C.can_checkpoint(consumer_log(spark, sf_dir), states).select(event_id(), "can_checkpoint")


@query(
    "checkpoint_gated",
    f"""{LIFECYCLE} SELECT stream_name, shard_id, max(sequence_number) AS sequence_number, 0::BIGINT AS sub_sequence_number
        FROM log JOIN latest USING (stream_name, shard_id) WHERE state IN ('Processing', 'ShardEnded') GROUP BY ALL""",
)
def checkpoint_gated(spark, sf_dir):
    return C.gated_checkpoints(consumer_log(spark, sf_dir), C.latest_state(lifecycle(spark, sf_dir)))


@query(
    "after_checkpoint",
    f"""{STORED} SELECT event_id FROM log LEFT JOIN stored s USING (stream_name, shard_id)
        WHERE s.sequence_number IS NULL OR log.sequence_number > s.sequence_number""",
)
def after_checkpoint(spark, sf_dir):
    return C.after_checkpoint(consumer_log(spark, sf_dir), stored(spark, sf_dir)).select(event_id())


@query("from_trim_horizon", f"WITH {LOG} SELECT event_id FROM log")
def from_trim_horizon(spark, sf_dir):
    return record_log.from_position(consumer_log(spark, sf_dir), Position.trim_horizon()).select(event_id())


@query("from_timestamp", f"WITH {LOG} SELECT event_id FROM log WHERE arrival >= {MIDDLE_SQL}")
def from_timestamp(spark, sf_dir):
    return record_log.from_position(consumer_log(spark, sf_dir), Position.at_timestamp(MIDDLE)).select(event_id())


@query(
    "from_latest",
    f"""WITH {LOG}, tips AS (SELECT stream_name, shard_id, max(sequence_number) AS tip FROM log WHERE arrival < {MIDDLE_SQL} GROUP BY ALL)
        SELECT event_id FROM log LEFT JOIN tips USING (stream_name, shard_id) WHERE tip IS NULL OR sequence_number > tip""",
)
def from_latest(spark, sf_dir):
    tips = record_log.shard_tips(early(spark, sf_dir))
    return record_log.from_position(consumer_log(spark, sf_dir), Position.latest(), tips).select(event_id())


@query(
    "order_by_position",
    f"""WITH {LOG} SELECT stream_name, shard_id, event_id, coalesce(lag(event_id) OVER (PARTITION BY stream_name, shard_id ORDER BY event_id), -1) AS event_before
        FROM log""",
)
def in_order(spark, sf_dir):
    """Each record with the one before it in its shard, as the order of the rows has it."""
    rows = order_by_position(consumer_log(spark, sf_dir)).withColumn("place", F.monotonically_increasing_id())
    before = F.lag(event_id()).over(Window.partitionBy("stream_name", "shard_id").orderBy("place"))
    return rows.select("stream_name", "shard_id", event_id(), F.coalesce(before, F.lit(-1)).alias("event_before"))


@query(
    "mark_last_in_shard",
    f"""WITH {LOG} SELECT event_id, shard_id IN ('shardId-000000000000', 'shardId-000000000002')
          AND event_id = max(event_id) OVER (PARTITION BY stream_name, shard_id) AS is_last_in_shard FROM log""",
)
def mark_last_in_shard(spark, sf_dir):
    return C.mark_last_in_shard(consumer_log(spark, sf_dir), ended(spark, sf_dir)).select(event_id(), "is_last_in_shard")


def ended(spark, sf_dir):
    """Shards 0 and 2 of each stream ended when they got their last record."""
    shards = consumer_log(spark, sf_dir).filter("shard_id IN ('shardId-000000000000', 'shardId-000000000002')")
    return shards.groupBy("stream_name", "shard_id").agg(F.max("arrival").alias("ended_at"))


@query(
    "shard_end_status",
    f"""WITH {LOG}, ends AS (SELECT stream_name, shard_id, max(arrival) AS ended_at, max(event_id) AS last FROM log
                             WHERE shard_id IN ('shardId-000000000000', 'shardId-000000000002') GROUP BY ALL),
        done AS (SELECT stream_name, shard_id, max(event_id) AS done FROM log WHERE event_id % 4 < 3 GROUP BY ALL),
        status AS (SELECT stream_name, shard_id, CASE WHEN done >= last THEN 'complete'
            WHEN TIMESTAMP '2024-01-31 00:00:00' - ended_at >= INTERVAL 2 HOUR THEN 'timed_out' ELSE 'waiting' END AS status
          FROM ends LEFT JOIN done USING (stream_name, shard_id))
        SELECT *, status <> 'waiting' AS final_checkpoint FROM status""",
)
def shard_end_status(spark, sf_dir):
    log = consumer_log(spark, sf_dir)
    committed = C.checkpoints(log.filter(event_id() % 4 < 3))
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return C.shard_end_status(log, committed, ended(spark, sf_dir), 2 * 3600 * 1_000_000, now)


@query(
    "read_many_streams",
    f"""WITH {LOG}, tips AS (SELECT stream_name, shard_id, max(sequence_number) AS tip FROM log WHERE arrival < {MIDDLE_SQL} GROUP BY ALL)
        SELECT event_id FROM log LEFT JOIN tips USING (stream_name, shard_id)
        WHERE stream_name = 'stream-click' OR (stream_name = 'stream-view' AND arrival >= TIMESTAMP '2024-01-20 00:00:00')
           OR (stream_name = 'stream-error' AND (tip IS NULL OR sequence_number > tip))""",
)
def read_many_streams(spark, sf_dir):
    positions = {
        "stream-click": Position.trim_horizon(),
        "stream-view": Position.at_timestamp(dt.datetime(2024, 1, 20)),
        "stream-error": Position.latest(),
    }
    tips = record_log.shard_tips(early(spark, sf_dir))
    return record_log.select_many(consumer_log(spark, sf_dir), positions, tips).select(event_id())


def stream_catalog(spark, sf_dir):
    """Account and creation time of each stream: when its first event came."""
    return table(spark, sf_dir, "events").groupBy(F.concat(F.lit("stream-"), "event_type").alias("stream_name")).agg(
        F.lit("123456789012").alias("account_id"), (F.min(micros("ts")) / 1000).cast("bigint").alias("created_ms")
    )


@query(
    "stream_identifiers",
    f"""WITH {LOG} SELECT event_id, '123456789012:' || stream_name || ':' || (epoch_us(min(arrival) OVER (PARTITION BY stream_name)) // 1000)::VARCHAR
          AS stream_identifier FROM log""",
)
def stream_identifiers(spark, sf_dir):
    named = record_log.with_stream_identifier(consumer_log(spark, sf_dir), stream_catalog(spark, sf_dir))
    return named.select(event_id(), "stream_identifier")


def dated_checkpoints(spark, sf_dir):
    log = consumer_log(spark, sf_dir)
    updated = log.groupBy("stream_name", "shard_id").agg(F.max("arrival").alias("updated"))
    return C.checkpoints(log).join(updated, ["stream_name", "shard_id"])


def _former(mode, condition):
    @query(
        f"former_checkpoints_{mode}",
        f"""WITH {LOG} SELECT stream_name, shard_id, max(sequence_number) AS sequence_number FROM log GROUP BY ALL
            HAVING {condition} AND TIMESTAMP '2024-01-31 00:00:00' - max(arrival) >= INTERVAL 2 HOUR""",
    )
    def former(spark, sf_dir):
        names = table(spark, sf_dir, "events").select(F.concat(F.lit("stream-"), "event_type").alias("stream_name")).distinct()
        listed = names.filter("stream_name IN ('stream-click', 'stream-view')")
        now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
        found = consume.former_checkpoints(dated_checkpoints(spark, sf_dir), listed, mode, 2 * 3600 * 1_000_000, now)
        return found.select("stream_name", "shard_id", "sequence_number")


_former("none", "FALSE")
_former("detect", "stream_name NOT IN ('stream-click', 'stream-view')")
_former("provided", "stream_name IN ('stream-click', 'stream-view')")


def thinned(spark, sf_dir):
    """What a consumer of the events got: some lost, some twice, some changed, some never produced."""
    produced = records(spark, sf_dir).select("stream_name", "event_id", "data")
    consumed = produced.filter("event_id % 11 <> 0")
    twice = consumed.filter("event_id % 13 = 0")
    foreign = consumed.filter("event_id % 17 = 0").withColumn("event_id", -F.col("event_id"))
    changed = F.when(F.col("event_id") % 19 == 0, F.lit("?").cast("binary")).otherwise(F.col("data"))
    return produced, consumed.withColumn("data", changed).unionByName(twice).unionByName(foreign)


COMPARED = """WITH p AS (SELECT event_id FROM events), c AS (SELECT event_id FROM p WHERE event_id % 11 <> 0),
seen AS (SELECT event_id, event_id % 19 = 0 AS changed FROM c UNION ALL SELECT event_id, FALSE FROM c WHERE event_id % 13 = 0
         UNION ALL SELECT -event_id, FALSE FROM c WHERE event_id % 17 = 0),
counts AS (SELECT event_id, count(*) AS n, bool_or(changed) AS changed FROM seen GROUP BY event_id),
compared AS (
  SELECT event_id, CAST(CASE WHEN p.event_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_produced, coalesce(n, 0) AS n_consumed,
         CASE WHEN p.event_id IS NULL THEN 'foreign' WHEN n IS NULL THEN 'lost' WHEN n > 1 THEN 'duplicated'
              WHEN changed THEN 'differs' ELSE 'ok' END AS status
  FROM p FULL JOIN counts USING (event_id))"""


@query("reconcile", f"{COMPARED} SELECT event_id, n_produced, n_consumed, status FROM compared")
def reconcile(spark, sf_dir):
    produced, consumed = thinned(spark, sf_dir)
    return consume.reconcile(produced, consumed, ["event_id"])


@query(
    "reconcile_summary",
    f"""{COMPARED} SELECT status, count(*) AS n_keys, CAST(sum(n_produced) AS BIGINT) AS n_produced,
          CAST(sum(n_consumed) AS BIGINT) AS n_consumed FROM compared GROUP BY status""",
)
def reconcile_summary(spark, sf_dir):
    produced, consumed = thinned(spark, sf_dir)
    return consume.reconcile_summary(consume.reconcile(produced, consumed, ["event_id"]))


@query(
    "consumer_lag",
    f"""{STORED}, joined AS (SELECT log.*, s.sequence_number IS NOT NULL AND log.sequence_number <= s.sequence_number AS was_read
                            FROM log LEFT JOIN stored s USING (stream_name, shard_id)),
        shards AS (SELECT stream_name, shard_id, count(*) FILTER (NOT was_read) AS n_behind,
                          coalesce(max(arrival) FILTER (was_read), min(arrival)) AS since FROM joined GROUP BY ALL)
        SELECT stream_name, shard_id, n_behind,
               CAST(CASE WHEN n_behind = 0 THEN 0 ELSE (epoch_us({NOW_SQL}) - epoch_us(since)) // 1000 END AS BIGINT) AS millis_behind_latest
        FROM shards""",
)
def consumer_lag(spark, sf_dir):
    return consume.consumer_lag(consumer_log(spark, sf_dir), stored(spark, sf_dir), F.lit(NOW).cast("timestamp_ntz"))


# ---- invocation events ----------------------------------------------------------------------

ARN = "arn:aws:kinesis:us-east-1:123456789012:stream/"


def invocation_records(spark, sf_dir):
    """Events with the fields of an invocation; every third is encrypted."""
    return table(spark, sf_dir, "events").select(
        "event_type",
        F.col("event_id").alias("nr"),
        F.lit("us-east-1").alias("aws_region"),
        F.concat(F.lit("shardId-000000000000:"), F.col("event_id").cast("string")).alias("event_id"),
        F.lit("aws:kinesis:record").alias("event_name"),
        F.lit("aws:kinesis").alias("event_source"),
        F.concat(F.lit(ARN), "event_type").alias("event_source_arn"),
        F.lit("1.0").alias("event_version"),
        F.lit("arn:aws:iam::123456789012:role/reader").alias("invoke_identity_arn"),
        (micros("ts") / 1000).cast("bigint").alias("arrival_ms"),
        F.concat_ws("|", F.col("event_id").cast("string"), "props").cast("binary").alias("data"),
        F.lit("1.0").alias("schema_version"),
        F.col("user_id").cast("string").alias("partition_key"),
        F.when(F.col("event_id") % 3 == 0, F.lit("KMS")).alias("encryption_type"),
        F.lpad(F.col("event_id").cast("string"), 56, "0").alias("sequence_number"),
    )


_RECORD_JSON = f"""'{{"awsRegion":"us-east-1","eventID":"shardId-000000000000:' || event_id::VARCHAR ||
  '","eventName":"aws:kinesis:record","eventSource":"aws:kinesis","eventSourceARN":"{ARN}' || event_type ||
  '","eventVersion":"1.0","invokeIdentityArn":"arn:aws:iam::123456789012:role/reader","kinesis":{{"approximateArrivalTimestamp":' ||
  (epoch_us(ts) // 1000000)::VARCHAR || '.' || lpad((epoch_us(ts) // 1000 % 1000)::VARCHAR, 3, '0') || ',"data":"' ||
  base64(encode(event_id::VARCHAR || '|' || props)) || '","kinesisSchemaVersion":"1.0","partitionKey":"' || user_id::VARCHAR ||
  '","encryptionType":' || CASE WHEN event_id % 3 = 0 THEN '"KMS"' ELSE 'null' END || ',"sequenceNumber":"' ||
  lpad(event_id::VARCHAR, 56, '0') || '"}}}}'"""


def invocations(spark, sf_dir):
    return lambda_events.to_lambda_events(invocation_records(spark, sf_dir), ["event_type"], ["nr"], "arrival_ms")


@query(
    "lambda_format",
    f"""WITH n AS (SELECT *, (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 100 AS event_no FROM events)
        SELECT event_type, event_no, '{{"Records":[' || string_agg({_RECORD_JSON}, ',' ORDER BY event_id) || ']}}' AS event
        FROM n GROUP BY event_type, event_no""",
)
def lambda_format(spark, sf_dir):
    return invocations(spark, sf_dir)


@query(
    "lambda_parse",
    f"""SELECT 'shardId-000000000000:' || event_id::VARCHAR AS event_id, '{ARN}' || event_type AS event_source_arn,
          lpad(event_id::VARCHAR, 56, '0') AS sequence_number, CAST(epoch_us(ts) // 1000 AS BIGINT) AS arrival_ms,
          event_id::VARCHAR || '|' || props AS data, user_id::VARCHAR AS partition_key,
          CASE WHEN event_id % 3 = 0 THEN 'KMS' END AS encryption_type FROM events""",
)
def lambda_parse(spark, sf_dir):
    read = lambda_events.unpack_lambda_events(invocations(spark, sf_dir))
    return read.select(
        "event_id",
        "event_source_arn",
        "sequence_number",
        F.unix_millis("arrival").alias("arrival_ms"),
        data_text().alias("data"),
        "partition_key",
        "encryption_type",
    )


@query(
    "lambda_malformed",
    "SELECT event_id AS nr FROM events WHERE event_id % 5 IN (0, 1, 2)",
)
def lambda_malformed(spark, sf_dir):
    """One event per record, three of five broken: unknown encryption, bad base64, no JSON."""
    single = lambda_events.to_lambda_events(invocation_records(spark, sf_dir), ["nr"], ["sequence_number"], "arrival_ms")
    case = F.col("nr") % 5
    broken = (
        F.when(case == 0, F.regexp_replace("event", '"encryptionType":(null|"KMS")', '"encryptionType":"ROT13"'))
        .when(case == 1, F.regexp_replace("event", '"data":"', '"data":"%%'))
        .when(case == 2, F.substring("event", 1, 200))
        .otherwise(F.col("event"))
    )
    return lambda_events.malformed_events(single.withColumn("event", broken)).select("nr")


# ---- catalog --------------------------------------------------------------------------------


def arns(spark, sf_dir):
    """A stream ARN per customer, in regions named by nation; some are malformed."""
    region = F.when(F.col("n_nationkey") % 5 == 0, "mars-north-1").when(F.col("n_nationkey") % 5 == 1, "cn-north-1").otherwise("eu-west-1")
    joined = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    arn = F.concat(
        F.lit("arn:aws:kinesis:"), region, F.lit(":"), F.lpad(F.col("c_custkey").cast("string"), 12, "0"), F.lit(":stream/"), F.lower("n_name")
    )
    whole = F.when(F.col("c_custkey") % 7 == 0, F.regexp_replace(arn, "/.*", "")).otherwise(arn)
    return joined.select("c_custkey", whole.alias("stream_arn"))


ARNS = """WITH a AS (
  SELECT c_custkey, lpad(c_custkey::VARCHAR, 12, '0') AS account, lower(n_name) AS name, c_custkey % 7 = 0 AS cut,
         CASE n_nationkey % 5 WHEN 0 THEN 'mars-north-1' WHEN 1 THEN 'cn-north-1' ELSE 'eu-west-1' END AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
p AS (SELECT *, CASE WHEN cut THEN 'no stream name'
                     WHEN region LIKE 'mars%' THEN 'unknown region: mars-north-1' END AS arn_error
      FROM a)"""


@query(
    "parse_stream_arns",
    f"""{ARNS} SELECT c_custkey, arn_error, CASE WHEN arn_error IS NULL THEN name END AS stream_name,
          CASE WHEN arn_error IS NULL THEN region END AS aws_region, CASE WHEN arn_error IS NULL THEN account END AS account_id FROM p""",
)
def parse_stream_arns(spark, sf_dir):
    return catalog.parse_stream_arns(arns(spark, sf_dir)).drop("stream_arn")


@query(
    "format_stream_arns",
    f"""{ARNS} SELECT c_custkey, CASE WHEN arn_error IS NULL THEN 'arn:' || CASE WHEN region LIKE 'cn%' THEN 'aws-cn' ELSE 'aws' END
          || ':kinesis:' || region || ':' || account || ':stream/' || name END AS stream_arn FROM p""",
)
def format_stream_arns(spark, sf_dir):
    parsed = catalog.parse_stream_arns(arns(spark, sf_dir)).drop("stream_arn")
    return catalog.format_stream_arns(parsed).select("c_custkey", "stream_arn")


@query(
    "parse_consumer_arns",
    f"""{ARNS}, q AS (SELECT *, CASE WHEN arn_error IS NOT NULL THEN arn_error WHEN c_custkey % 11 = 0 THEN 'creation time is no number' END AS e FROM p)
        SELECT c_custkey, e AS arn_error, CASE WHEN e IS NULL THEN name END AS stream_name, CASE WHEN e IS NULL THEN region END AS aws_region,
               CASE WHEN e IS NULL THEN account END AS account_id, CASE WHEN e IS NULL THEN 'reader' || c_custkey::VARCHAR END AS consumer_name,
               CASE WHEN e IS NULL THEN 1700000000 + c_custkey END AS created_s FROM q""",
)
def parse_consumer_arns(spark, sf_dir):
    created = F.when(F.col("c_custkey") % 11 == 0, "soon").otherwise((F.col("c_custkey") + 1_700_000_000).cast("string"))
    consumer = F.concat("stream_arn", F.lit("/consumer/reader"), F.col("c_custkey").cast("string"), F.lit(":"), created)
    whole = arns(spark, sf_dir).withColumn("cut", ~F.col("stream_arn").contains("/"))
    # a stream ARN without a name stays one: its consumer suffix must not be taken for a name
    text = F.when(F.col("cut"), F.col("stream_arn")).otherwise(consumer)
    return catalog.parse_consumer_arns(whole.select("c_custkey", text.alias("consumer_arn"))).drop("consumer_arn")


@query(
    "format_consumer_arns",
    f"""{ARNS} SELECT c_custkey, CASE WHEN arn_error IS NULL THEN 'arn:' || CASE WHEN region LIKE 'cn%' THEN 'aws-cn' ELSE 'aws' END
          || ':kinesis:' || region || ':' || account || ':stream/' || name || '/consumer/r:' || c_custkey::VARCHAR END AS consumer_arn FROM p""",
)
def format_consumer_arns(spark, sf_dir):
    parsed = catalog.parse_stream_arns(arns(spark, sf_dir)).withColumns({"consumer_name": F.lit("r"), "created_s": F.col("c_custkey")})
    return catalog.format_consumer_arns(parsed).select("c_custkey", "consumer_arn")
