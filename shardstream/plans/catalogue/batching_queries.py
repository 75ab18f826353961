"""Queries that batch, chunk, pack and unpack."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ...config import Limits
from ...functions import records as R
from ...functions.records import MAGIC
from ...operators import routing
from ...operators.batching import assign_batches, batch_summary, chunk_puts, group_within, with_request_index
from ...operators.consume import reconcile, reconcile_summary
from ...operators.packing import pack_records, packed_sizes, unpack_records
from ..put import prepare
from ..testtables import DOCUMENT_LIMITS, consumer_log, document_records, listing, micros, records
from .registry import DOCUMENTS, HEX_VALUE, RECORDS, query, ranges_sql
from .routing_queries import FOUR, LOOKUP

BY_COUNT = Limits(max_request_records=20, aggregate=False)


def routed_events(spark, sf_dir):
    valid = R.validate(R.with_payload_size(records(spark, sf_dir))).filter("invalid_reason IS NULL").drop("invalid_reason")
    return routing.predict_shard(valid, routing.shard_map(listing(spark, sf_dir, FOUR)))


def routed_documents(spark, sf_dir):
    """Valid documents on four even shards, chosen by the leading hex digit of their hash key."""
    sized = R.with_payload_size(document_records(spark, sf_dir))
    valid = R.validate(sized, DOCUMENT_LIMITS).filter("invalid_reason IS NULL").drop("invalid_reason")
    quarter = F.floor(F.conv(F.substring(R.hash_key(), 1, 1), 16, 10).cast("int") / 4).cast("int")
    return valid.withColumn("shard_id", F.format_string("shardId-%012d", quarter))


COUNTED = f"""WITH {RECORDS}, {ranges_sql(FOUR)}, {LOOKUP},
numbered AS (SELECT *, (row_number() OVER (PARTITION BY stream_name, put_id ORDER BY seq_in_put) - 1) // 20 AS batch_no
             FROM routed WHERE invalid_reason IS NULL)""".replace("FROM sized z", "FROM checked z")


@query(
    "batches_by_count",
    f"""{COUNTED} SELECT event_id, batch_no, row_number() OVER (PARTITION BY stream_name, put_id, batch_no, shard_id
          ORDER BY seq_in_put) - 1 AS request_index FROM numbered""",
)
def batches_by_count(spark, sf_dir):
    batched = assign_batches(routed_events(spark, sf_dir), BY_COUNT)
    return batched.select("event_id", "batch_no", "request_index")


@query(
    "batch_summary",
    f"""{COUNTED} SELECT stream_name, put_id, batch_no, shard_id, count(*) AS n_records, CAST(sum(n_bytes) AS BIGINT) AS n_bytes
        FROM numbered GROUP BY ALL""",
)
def batch_totals(spark, sf_dir):
    return batch_summary(assign_batches(routed_events(spark, sf_dir), BY_COUNT))


@query(
    "request_index",
    f"""{COUNTED} SELECT event_id, row_number() OVER (PARTITION BY stream_name, put_id, batch_no, shard_id
          ORDER BY seq_in_put) - 1 AS request_index FROM numbered""",
)
def request_index(spark, sf_dir):
    batched = assign_batches(routed_events(spark, sf_dir), BY_COUNT).drop("request_index")
    return with_request_index(batched).select("event_id", "request_index")


def _shard_state(i, fresh):
    """SQL for the open batch's records and bytes of shard ``i`` after the next row."""
    mine = f"CASE WHEN n.shard = {i} THEN 1 ELSE 0 END", f"CASE WHEN n.shard = {i} THEN n.n_bytes ELSE 0 END"
    if fresh:
        return f"{mine[0]} AS c{i}, {mine[1]} AS b{i}"
    return f"CASE WHEN ok THEN s.c{i} ELSE 0 END + {mine[0]} AS c{i}, CASE WHEN ok THEN s.b{i} ELSE 0 END + {mine[1]} AS b{i}"


_FITS = " AND ".join(
    f"(n.shard <> {i} OR s.c{i} = 0 OR (s.c{i} + 1 <= 40 AND s.b{i} + n.n_bytes <= 65536))" for i in range(4)
)

BATCHED_DOCUMENTS = f"""WITH RECURSIVE {DOCUMENTS},
numbered AS (SELECT *, row_number() OVER (PARTITION BY put_id ORDER BY seq_in_put) AS rn,
                    ('0x' || substr(hash_key, 1, 1))::INTEGER // 4 AS shard FROM valid),
walk AS (
  SELECT n.put_id, n.rn, n.doc_id, n.shard, n.n_bytes AS size, 0 AS batch_no, 1 AS c, n.n_bytes AS b,
         {', '.join(_shard_state(i, True) for i in range(4))} FROM numbered n WHERE rn = 1
  UNION ALL
  SELECT put_id, rn, doc_id, shard, n_bytes, batch_no, c, b, {', '.join(f'c{i}, b{i}' for i in range(4))} FROM (
    SELECT n.put_id, n.rn, n.doc_id, n.shard, n.n_bytes, CASE WHEN ok THEN s.batch_no ELSE s.batch_no + 1 END AS batch_no,
           CASE WHEN ok THEN s.c + 1 ELSE 1 END AS c, CASE WHEN ok THEN s.b + n.n_bytes ELSE n.n_bytes END AS b,
           {', '.join(_shard_state(i, False) for i in range(4))}
    FROM (SELECT s.*, s.c + 1 <= 50 AND s.b + n.n_bytes <= 131072 AND {_FITS} AS ok
          FROM walk s JOIN numbered n ON n.put_id = s.put_id AND n.rn = s.rn + 1) s
    JOIN numbered n ON n.put_id = s.put_id AND n.rn = s.rn + 1))"""


@query(
    "batches_by_bytes",
    f"""{BATCHED_DOCUMENTS} SELECT doc_id, CAST(batch_no AS BIGINT) AS batch_no,
          row_number() OVER (PARTITION BY put_id, batch_no, shard ORDER BY rn) - 1 AS request_index FROM walk""",
)
def batches_by_bytes(spark, sf_dir):
    batched = assign_batches(routed_documents(spark, sf_dir), DOCUMENT_LIMITS)
    return batched.select("doc_id", "batch_no", "request_index")


@query(
    "batches_of_large_puts",
    f"""{BATCHED_DOCUMENTS} SELECT doc_id, CAST(batch_no AS BIGINT) AS batch_no,
          row_number() OVER (PARTITION BY put_id, batch_no, shard ORDER BY rn) - 1 AS request_index FROM walk""",
)
def batches_of_large_puts(spark, sf_dir):
    """The same batches with every put cut into blocks of 64 records, the way puts beyond one task are done."""
    batched = assign_batches(routed_documents(spark, sf_dir), DOCUMENT_LIMITS, group_rows=64)
    return batched.select("doc_id", "batch_no", "request_index")


@query(
    "chunk_puts",
    """WITH n AS (SELECT event_id, 'stream-' || event_type AS stream_name,
                         row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS nr FROM events)
       SELECT event_id, nr // 300 AS put_id, CAST(nr % 300 AS INTEGER) AS seq_in_put FROM n""",
)
def bulk_puts(spark, sf_dir):
    bulk = records(spark, sf_dir).select("stream_name", "event_id")
    return chunk_puts(bulk, 300, ["stream_name"], ["event_id"]).select("event_id", "put_id", "seq_in_put")


SIX_HOURS_US = 6 * 3600 * 1_000_000

GROUPED = """WITH RECURSIVE n AS (
  SELECT event_id, event_type, epoch_us(ts) AS t, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn
  FROM events),
walk AS (
  SELECT event_type, rn, event_id, t AS first_t, 0 AS chunk_no, 0 AS place FROM n WHERE rn = 1
  UNION ALL
  SELECT n.event_type, n.rn, n.event_id,
         CASE WHEN w.place + 1 < 50 AND n.t < w.first_t + 21600000000 THEN w.first_t ELSE n.t END,
         CASE WHEN w.place + 1 < 50 AND n.t < w.first_t + 21600000000 THEN w.chunk_no ELSE w.chunk_no + 1 END,
         CASE WHEN w.place + 1 < 50 AND n.t < w.first_t + 21600000000 THEN w.place + 1 ELSE 0 END
  FROM walk w JOIN n ON n.event_type = w.event_type AND n.rn = w.rn + 1)
SELECT event_id, CAST(chunk_no AS BIGINT) AS chunk_no, CAST(place AS BIGINT) AS place_in_chunk FROM walk"""


def timed_log(spark, sf_dir):
    log = consumer_log(spark, sf_dir)
    return log.select("stream_name", micros("arrival").alias("at_us"), F.col("sequence_number").cast("decimal(38,0)").cast("bigint").alias("event_id"))


@query("group_within", GROUPED)
def chunks(spark, sf_dir):
    grouped = group_within(timed_log(spark, sf_dir), 50, SIX_HOURS_US, ["stream_name"], ["at_us", "event_id"], "at_us")
    return grouped.select("event_id", "chunk_no", "place_in_chunk")


@query("group_within_large_streams", GROUPED)
def chunks_of_large_streams(spark, sf_dir):
    """The same chunks with every stream cut into blocks of 200 records."""
    grouped = group_within(
        timed_log(spark, sf_dir), 50, SIX_HOURS_US, ["stream_name"], ["at_us", "event_id"], "at_us", group_rows=200
    )
    return grouped.select("event_id", "chunk_no", "place_in_chunk")


def documents_to_pack(spark, sf_dir):
    """Every third document has an explicit hash key of its own."""
    hash_key = F.when(F.col("doc_id") % 3 == 0, F.concat(F.col("doc_id").cast("string"), F.lit("7777777777")))
    return routed_documents(spark, sf_dir).withColumn("explicit_hash_key", hash_key)


def _varint_len(x):
    return f"CASE WHEN {x} < 128 THEN 1 WHEN {x} < 16384 THEN 2 ELSE 3 END"


_ENTRY = f"(n.d + 1 + {_varint_len('n.d')} + 4)"
_ADDED = f"({_ENTRY} + 1 + {_varint_len(_ENTRY)})"

PACKED = f"""WITH RECURSIVE {DOCUMENTS},
keyed AS (SELECT *, strlen(data_text) AS d,
                 CASE WHEN doc_id % 3 = 0 THEN doc_id::VARCHAR || '7777777777' ELSE {HEX_VALUE.format('hash_key')}::VARCHAR END AS h
          FROM valid),
numbered AS (SELECT *, row_number() OVER (PARTITION BY put_id, partition_key ORDER BY seq_in_put) AS rn FROM keyed),
sized AS (SELECT put_id, partition_key, rn, h, {_ADDED} AS entry, strlen(h) + 2 AS listed,
                 20 + 2 + strlen(partition_key) AS frame FROM numbered n),
walk AS (
  SELECT put_id, partition_key, rn, 0 AS pack_no, frame + listed + entry AS size, [h] AS hs FROM sized WHERE rn = 1
  UNION ALL
  SELECT put_id, partition_key, rn, CASE WHEN grown <= 8192 THEN pack_no ELSE pack_no + 1 END,
         CASE WHEN grown <= 8192 THEN grown ELSE frame + listed + entry END,
         CASE WHEN grown > 8192 THEN [h] WHEN known THEN hs ELSE list_append(hs, h) END
  FROM (SELECT n.*, w.pack_no, w.hs, list_contains(w.hs, n.h) AS known,
               w.size + n.entry + CASE WHEN list_contains(w.hs, n.h) THEN 0 ELSE n.listed END AS grown
        FROM walk w JOIN sized n ON n.put_id = w.put_id AND n.partition_key = w.partition_key AND n.rn = w.rn + 1))
SELECT put_id, partition_key, CAST(pack_no AS BIGINT) AS pack_no, count(*) AS n_records,
       CAST(max(size) AS BIGINT) AS size_bytes FROM walk GROUP BY ALL"""


def _packs(packed):
    """Pack sizes; a record too large for a frame of its own is counted at the size its pack would have had."""
    alone = F.lit(R.FRAME_BYTES) + R.packed_size_alone()
    size = F.when(F.col("oversize"), alone).otherwise(F.col("size_bytes"))
    return packed.select("put_id", "partition_key", "pack_no", "n_records", size.alias("size_bytes"))


@query("pack_counts", PACKED)
def pack_counts(spark, sf_dir):
    return _packs(pack_records(documents_to_pack(spark, sf_dir), DOCUMENT_LIMITS))


@query("pack_counts_large_puts", PACKED)
def pack_counts_large_puts(spark, sf_dir):
    """The same packs with puts walked in blocks."""
    return _packs(pack_records(documents_to_pack(spark, sf_dir), DOCUMENT_LIMITS, group_rows=8))


@query(
    "packed_sizes",
    f"""{PACKED.rsplit('SELECT put_id', 1)[0].rstrip()[:-1].replace('[h] AS hs FROM', '[h] AS hs, frame - 20 + listed + entry AS own FROM').replace(
        'ELSE list_append(hs, h) END', 'ELSE list_append(hs, h) END, CASE WHEN grown <= 8192 THEN grown - before ELSE frame - 20 + listed + entry END'
    ).replace('w.pack_no, w.hs,', 'w.pack_no, w.hs, w.size AS before,')})
        SELECT put_id, partition_key, rn, CAST(pack_no AS BIGINT) AS pack_no, CAST(own AS BIGINT) AS packed_size FROM walk""",
)
def sizes_in_packs(spark, sf_dir):
    measured = packed_sizes(documents_to_pack(spark, sf_dir), DOCUMENT_LIMITS)
    place = Window.partitionBy("put_id", "partition_key").orderBy("seq_in_put")  # a put's documents of one source
    numbered = measured.withColumn("rn", F.row_number().over(place).cast("bigint"))
    return numbered.select("put_id", "partition_key", "rn", "pack_no", "packed_size")


def _varint_hex(x):
    return (
        f"CASE WHEN {x} < 128 THEN printf('%02x', {x}) WHEN {x} < 16384 THEN printf('%02x%02x', {x} % 128 + 128, {x} // 128)"
        f" ELSE printf('%02x%02x%02x', {x} % 128 + 128, {x} // 128 % 128 + 128, {x} // 16384) END"
    )


def _field_hex(tag, text):
    return f"'{tag}' || {_varint_hex(f'strlen({text})')} || lower(hex(encode({text})))"


WIRE = f"""{PACKED[: PACKED.rindex('SELECT put_id')]},
entries AS (
  SELECT w.put_id, w.partition_key, pack_no, w.rn, size, hs, data_text, printf('%02x', list_position(hs, k.h) - 1) AS place, d
  FROM walk w JOIN (SELECT *, row_number() OVER (PARTITION BY put_id, partition_key ORDER BY seq_in_put) AS rn FROM keyed) k USING (put_id, partition_key, rn)),
written AS (
  SELECT *, '1a' || {_varint_hex(f"(d + 5 + {_varint_len('d')})")} || '080010' || place || '1a' || {_varint_hex('d')} || lower(hex(encode(data_text))) AS entry FROM entries),
framed AS (
  SELECT put_id, partition_key, pack_no, max(size) AS size, min(data_text) AS alone, arg_max(hs, rn) AS hs, string_agg(entry, '' ORDER BY rn) AS listed
  FROM written GROUP BY ALL),
bodies AS (SELECT *, {_field_hex('0a', 'partition_key')} || array_to_string(list_transform(hs, lambda x: {_field_hex('12', 'x')}), '') || listed AS body FROM framed)
SELECT put_id, partition_key, CAST(pack_no AS BIGINT) AS pack_no,
       CASE WHEN size > 8192 THEN md5(alone) ELSE md5(unhex('{MAGIC.hex()}' || body || md5(unhex(body)))) END AS digest FROM bodies"""


@query("pack_wire_digest", WIRE)
def pack_wire_digest(spark, sf_dir):
    packed = pack_records(documents_to_pack(spark, sf_dir), DOCUMENT_LIMITS)
    return packed.select("put_id", "partition_key", "pack_no", F.md5("data").alias("digest"))


def as_consumed(packed):
    """Packed records as a consumer would read them."""
    return packed.select(
        "stream_name",
        "shard_id",
        F.concat(F.lpad(F.col("put_id").cast("string"), 40, "0"), F.lpad(F.col("pack_no").cast("string"), 16, "0")).alias("sequence_number"),
        F.lit(None).cast("bigint").alias("sub_sequence_number"),
        "data",
        "partition_key",
        "explicit_hash_key",
    )


@query(
    "unpack_roundtrip",
    # a record too large for a frame of its own travels unpacked and gets no hash key
    f"""WITH {DOCUMENTS}, keyed AS (
          SELECT *, strlen(data_text) AS d, CASE WHEN doc_id % 3 = 0 THEN doc_id::VARCHAR || '7777777777' END AS e,
                 {HEX_VALUE.format('hash_key')}::VARCHAR AS h FROM valid)
        SELECT partition_key, md5(data_text) AS digest,
               CASE WHEN 22 + strlen(partition_key) + 2 + strlen(coalesce(e, h)) + {_ADDED.replace('n.d', 'd')} > 8192 THEN e
                    ELSE coalesce(e, h) END AS explicit_hash_key
        FROM keyed""",
)
def unpack_roundtrip(spark, sf_dir):
    packed = as_consumed(pack_records(documents_to_pack(spark, sf_dir), DOCUMENT_LIMITS))
    opened = unpack_records(packed, verify_digest=True)
    return opened.select("partition_key", F.md5("data").alias("digest"), "explicit_hash_key")


@query(
    "unpack_subsequence",
    # a record too large for a frame of its own travels unpacked and keeps no number
    f"""WITH p AS ({PACKED}) SELECT put_id, partition_key, pack_no, unnest(range(n_records)) AS sub_sequence_number
        FROM p WHERE size_bytes <= 8192
        UNION ALL SELECT put_id, partition_key, pack_no, NULL FROM p WHERE size_bytes > 8192""",
)
def unpack_subsequence(spark, sf_dir):
    opened = unpack_records(as_consumed(pack_records(documents_to_pack(spark, sf_dir), DOCUMENT_LIMITS)))
    return opened.select(
        F.substring("sequence_number", 1, 40).cast("decimal(38,0)").cast("bigint").alias("put_id"),
        "partition_key",
        F.substring("sequence_number", 41, 16).cast("bigint").alias("pack_no"),
        "sub_sequence_number",
    )


@query(
    "unpack_passthrough",
    """SELECT 'stream-' || event_type AS stream_name, lpad(event_id::VARCHAR, 56, '0') AS sequence_number,
         event_id::VARCHAR || '|' || event_type || '|' || props AS data, NULL::BIGINT AS sub_sequence_number FROM events""",
)
def unpack_passthrough(spark, sf_dir):
    opened = unpack_records(consumer_log(spark, sf_dir))
    return opened.select("stream_name", "sequence_number", R.data_text().alias("data"), "sub_sequence_number")


@query(
    "unpack_quarantine",
    f"""WITH {DOCUMENTS} SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'digest does not match' END AS unpack_error FROM rec""",
)
def unpack_quarantine(spark, sf_dir):
    """Every fifth document is given the magic bytes of a pack that it is not."""
    magic, tail = F.unhex(F.lit(R.MAGIC.hex())), F.unhex(F.lit("00" * R.DIGEST_BYTES))
    data = F.when(F.col("doc_id") % 5 == 0, F.concat(magic, F.col("data"), tail)).otherwise(F.col("data"))
    log = document_records(spark, sf_dir).select(
        "doc_id", "partition_key", "explicit_hash_key", F.lit(None).cast("bigint").alias("sub_sequence_number"), data.alias("data")
    )
    opened = unpack_records(log, on_error="quarantine", verify_digest=True)
    return opened.select("doc_id", "unpack_error")


@query(
    "packed_flag",
    "SELECT doc_id, doc_id % 5 = 0 AS packed FROM documents",
)
def packed_flag(spark, sf_dir):
    magic, tail = F.unhex(F.lit(R.MAGIC.hex())), F.unhex(F.lit("00" * R.DIGEST_BYTES))
    marked = F.when(F.col("doc_id") % 5 == 0, F.concat(magic, F.col("data"), tail)).otherwise(F.col("data"))
    return document_records(spark, sf_dir).withColumn("data", marked).select("doc_id", R.is_aggregated().alias("packed"))


@query(
    "pack_reconcile",
    f"""WITH {DOCUMENTS} SELECT 'ok' AS status, count(*) AS n_keys, CAST(sum(copies) AS BIGINT) AS n_produced, CAST(sum(copies) AS BIGINT) AS n_consumed
        FROM (SELECT md5(data_text), partition_key, count(*) AS copies FROM valid GROUP BY ALL)""",
)
def pack_reconcile(spark, sf_dir):
    """Nothing is lost, doubled or changed between packing and unpacking: documents, also copies, by their content."""
    produced = documents_to_pack(spark, sf_dir).select("partition_key", "data")
    opened = unpack_records(as_consumed(pack_records(documents_to_pack(spark, sf_dir), DOCUMENT_LIMITS)))
    consumed = opened.select("partition_key", "data")
    name = F.md5("data").alias("content")
    compared = reconcile(produced.select("*", name), consumed.select("*", name), ["partition_key", "content"])
    return reconcile_summary(compared)


@query(
    "put_and_unpack_totals",
    f"""WITH {RECORDS}, {ranges_sql(FOUR)}, {LOOKUP}
        SELECT stream_name, shard_id, count(*) AS n_records, CAST(sum(n_bytes) AS BIGINT) AS n_bytes
        FROM routed WHERE invalid_reason IS NULL GROUP BY ALL""".replace("FROM sized z", "FROM checked z"),
)
def put_and_unpack_totals(spark, sf_dir):
    """Events validated, routed, packed, batched, and unpacked again: records and bytes per shard."""
    shards = routing.shard_map(listing(spark, sf_dir, FOUR))
    entries, _ = prepare(records(spark, sf_dir).drop("event_id"), shards)
    opened = unpack_records(as_consumed(entries))
    sized = R.with_payload_size(opened)
    return sized.groupBy("stream_name", "shard_id").agg(F.count("*").alias("n_records"), F.sum("n_bytes").alias("n_bytes"))
