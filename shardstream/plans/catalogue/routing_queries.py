"""Queries that route records to shards."""

from pyspark.sql import functions as F

from ...functions.records import with_payload_size
from ...operators import routing
from ..testtables import even_ranges, listing, micros, records, shard_name, table
from .registry import HEX_VALUE, RECORDS, query, ranges_sql

FOUR, SEVEN = even_ranges(4), even_ranges(7)
GAPS = [r for r in SEVEN if r[0] not in (2, 5)]
TOP = 1 << 128
OVERLAPPING = [(0, TOP // 4, 3 * TOP // 4), (1, 0, TOP // 2), (2, TOP // 8, TOP - TOP // 8), (3, TOP // 2 + 1, TOP // 2 + 9)]

# the lookup per distinct key keeps the SQL check linear in the records
LOOKUP = """
keyed AS (SELECT k.hash_key, arg_min(s.shard_id, s.pos) AS found
          FROM (SELECT DISTINCT hash_key FROM sized) k JOIN shards s ON k.hash_key BETWEEN s.lo AND s.hi GROUP BY k.hash_key),
routed AS (SELECT z.*, coalesce(found, 'DEFAULT') AS shard_id FROM sized z LEFT JOIN keyed USING (hash_key))"""


def route(spark, sf_dir, ranges):
    return routing.predict_shard(records(spark, sf_dir), routing.shard_map(listing(spark, sf_dir, ranges)))


def routing_oracle(ranges):
    return f"WITH {RECORDS}, {ranges_sql(ranges)}, {LOOKUP} SELECT event_id, shard_id FROM routed"


def _register(name, ranges):
    @query(name, routing_oracle(ranges))
    def routed(spark, sf_dir):
        return route(spark, sf_dir, ranges).select("event_id", "shard_id")


_register("predict_shard_uniform_4", FOUR)
_register("predict_shard_uniform_7", SEVEN)
_register("predict_shard_with_gaps", GAPS)
_register("predict_shard_overlap_first_wins", OVERLAPPING)


@query(
    "shard_map",
    f"""WITH {ranges_sql(GAPS)} SELECT 'stream-' || event_type AS stream_name, shard_id, pos, lo AS lo_hex, hi AS hi_hex,
          lpad({HEX_VALUE.format('lo')}::VARCHAR, 39, '0') AS lo_dec, lpad({HEX_VALUE.format('hi')}::VARCHAR, 39, '0') AS hi_dec
        FROM (SELECT DISTINCT event_type FROM events), shards""",
)
def shard_map(spark, sf_dir):
    found = routing.shard_map(listing(spark, sf_dir, GAPS))
    return found.select("stream_name", "shard_id", "pos", "lo_hex", "hi_hex", "lo_dec", "hi_dec")


def refreshes(spark, sf_dir):
    """A refresh of each stream in every hour with events: it worked if the hour has an even number of them."""
    events = table(spark, sf_dir, "events")
    hours = events.groupBy(
        F.concat(F.lit("stream-"), "event_type").alias("stream_name"), F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("listed_at")
    ).agg((F.count("*") % 2 == 0).alias("ok"))
    shards = F.array(
        *[
            F.array(
                *[
                    F.struct(
                        F.lit(shard_name(i)).alias("shard_id"),
                        F.lit(i).alias("pos"),
                        F.lit(str(lo)).alias("starting_hash_key"),
                        F.lit(str(hi)).alias("ending_hash_key"),
                    )
                    for i, lo, hi in even_ranges(n)
                ]
            )
            for n in (2, 3, 4)
        ]
    )
    listed = hours.select("*", F.inline(F.get(shards, F.hour("listed_at") % 3)))
    return listed.withColumn("ending_sequence_number", F.lit(None).cast("string"))


_MAPS = ", ".join(
    f"({n - 2}, '{shard_name(i)}', '{lo:032x}', '{hi:032x}')" for n in (2, 3, 4) for i, lo, hi in even_ranges(n)
)


@query(
    "shard_map_refresh",
    f"""WITH maps(kind, shard_id, lo_hex, hi_hex) AS (VALUES {_MAPS}),
        hours AS (SELECT 'stream-' || event_type AS stream_name, date_trunc('hour', ts) AS listed_at, count(*) % 2 = 0 AS ok
                  FROM events GROUP BY ALL),
        newest AS (SELECT stream_name, max(listed_at) AS listed_at FROM hours
                   WHERE ok AND listed_at <= TIMESTAMP '2024-01-10 12:30:00' GROUP BY stream_name)
        SELECT stream_name, shard_id, lo_hex, hi_hex, CAST(epoch_us(listed_at) AS BIGINT) AS listed_us,
               TIMESTAMP '2024-01-10 12:30:00' - listed_at >= INTERVAL 1 HOUR AS stale
        FROM newest JOIN maps ON kind = hour(listed_at) % 3""",
)
def shard_map_refresh(spark, sf_dir):
    now = F.lit("2024-01-10 12:30:00").cast("timestamp_ntz")
    current = routing.shard_map_as_of(refreshes(spark, sf_dir), now)
    return current.select("stream_name", "shard_id", "lo_hex", "hi_hex", micros("last_updated").alias("listed_us"), "stale")


@query(
    "routing_skew",
    f"""WITH {RECORDS}, {ranges_sql(GAPS)}, {LOOKUP}
        SELECT stream_name, shard_id, count(*) AS n_records, CAST(sum(n_bytes) AS BIGINT) AS n_bytes,
               round(count(*) / sum(count(*)) OVER (PARTITION BY stream_name), 9) AS share, shard_id = 'DEFAULT' AS missed
        FROM routed GROUP BY stream_name, shard_id""",
)
def routing_skew(spark, sf_dir):
    report = routing.routing_report(with_payload_size(route(spark, sf_dir, GAPS)))
    return report.withColumn("share", F.round("share", 9))
