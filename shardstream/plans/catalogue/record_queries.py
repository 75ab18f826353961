"""Queries over records: sizes, validity, hash keys, views of the payload."""

from pyspark.sql import functions as F

from ...functions import records as R
from ..testtables import DOCUMENT_LIMITS, document_records, records
from .registry import DOCUMENTS, HEX_VALUE, RECORDS, query


@query("payload_sizes", f"WITH {RECORDS} SELECT event_id, n_bytes FROM sized")
def payload_sizes(spark, sf_dir):
    return R.with_payload_size(records(spark, sf_dir)).select("event_id", "n_bytes")


@query("payload_sizes_documents", f"WITH {DOCUMENTS} SELECT doc_id, n_bytes FROM rec")
def payload_sizes_documents(spark, sf_dir):
    return R.with_payload_size(document_records(spark, sf_dir)).select("doc_id", "n_bytes")


@query("validate_reasons", f"WITH {RECORDS} SELECT event_id, invalid_reason FROM checked")
def validate_reasons(spark, sf_dir):
    return R.validate(records(spark, sf_dir)).select("event_id", "invalid_reason")


@query(
    "validate_reasons_documents",
    f"WITH {DOCUMENTS} SELECT doc_id, CASE WHEN n_bytes > 8192 THEN 'RecordTooLarge' END AS invalid_reason FROM rec",
)
def validate_reasons_documents(spark, sf_dir):
    return R.validate(document_records(spark, sf_dir), DOCUMENT_LIMITS).select("doc_id", "invalid_reason")


@query(
    "validity_checks",
    f"""WITH {RECORDS} SELECT event_id, n_bytes <= 30 AS valid_size, strlen(partition_key) BETWEEN 2 AND 3 AS valid_key,
        explicit_hash_key IS NULL OR TRY_CAST(explicit_hash_key AS UHUGEINT) IS NOT NULL AS valid_hash FROM sized""",
)
def validity_checks(spark, sf_dir):
    tight = R.Limits(max_record_bytes=30, min_key_bytes=2, max_key_bytes=3)
    return records(spark, sf_dir).select(
        "event_id",
        R.is_valid_size(tight).alias("valid_size"),
        R.is_valid_partition_key(tight).alias("valid_key"),
        R.is_valid_explicit_hash_key().alias("valid_hash"),
    )


@query(
    "hash_keys",
    f"""WITH {RECORDS} SELECT event_id, hash_key, CAST(strlen({HEX_VALUE.format('hash_key')}::VARCHAR) AS INTEGER) AS n_digits
        FROM sized""",
)
def hash_keys(spark, sf_dir):
    keyed = R.with_hash_key(records(spark, sf_dir))
    return keyed.select("event_id", "hash_key", R.decimal_digits(F.col("hash_key")).alias("n_digits"))


@query(
    "packed_size_alone",
    f"""WITH {RECORDS}, lens AS (
          SELECT event_id, strlen(partition_key) AS k, strlen(data_text) AS d,
                 strlen(coalesce(explicit_hash_key, {HEX_VALUE.format('hash_key')}::VARCHAR)) AS h FROM sized)
        SELECT event_id, CAST((2 + k) + (2 + h) + CASE WHEN d < 122 THEN 2 ELSE 3 END + 4 + CASE WHEN d < 128 THEN 2 ELSE 3 END + d
          AS BIGINT) AS packed_size FROM lens""",
)
def packed_size_alone(spark, sf_dir):
    return records(spark, sf_dir).select("event_id", R.packed_size_alone().alias("packed_size"))


@query(
    "data_views",
    f"WITH {RECORDS} SELECT event_id, data_text, base64(encode(data_text)) AS data_base64 FROM rec",
)
def data_views(spark, sf_dir):
    return records(spark, sf_dir).select(
        "event_id", R.data_text().alias("data_text"), R.data_base64().alias("data_base64")
    )


@query(
    "records_equal",
    f"""WITH {RECORDS} SELECT event_id, explicit_hash_key IS NULL OR explicit_hash_key = '-1' AS same FROM rec""",
)
def records_equal(spark, sf_dir):
    fields = ["data", "partition_key", "explicit_hash_key", "sequence_number_for_ordering"]
    changed = F.when(F.col("explicit_hash_key") == "-1", F.col("explicit_hash_key")).alias("explicit_hash_key")
    other = [changed if f == "explicit_hash_key" else F.col(f) for f in fields]
    pairs = records(spark, sf_dir).select("event_id", F.struct(*fields).alias("a"), F.struct(*other).alias("b"))
    return pairs.select("event_id", R.records_equal("a", "b").alias("same"))


@query(
    "put_entries",
    f"WITH {RECORDS} SELECT stream_name, put_id, data_text AS data, partition_key, explicit_hash_key FROM rec",
)
def put_entries(spark, sf_dir):
    return R.to_put_entries(records(spark, sf_dir)).withColumn("data", R.data_text())


@query(
    "stream_labels",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'stream-' || event_type WHEN event_id % 3 = 1
       THEN 'arn:aws:kinesis:us-east-1:123456789012:stream/' || event_type ELSE '' END AS label FROM events""",
)
def stream_labels(spark, sf_dir):
    event = records(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, F.col("stream_name")).alias("stream_name"),
        F.when(
            F.col("event_id") % 3 == 1,
            F.concat(F.lit("arn:aws:kinesis:us-east-1:123456789012:stream/"), F.substring("stream_name", 8, 100)),
        ).alias("stream_arn"),
    )
    return event.select("event_id", R.stream_label().alias("label"))


@query(
    "audit_json",
    f"""WITH {RECORDS} SELECT '{{"data":"' || base64(encode(data_text)) || '"'
          || CASE WHEN explicit_hash_key IS NULL THEN '' ELSE ',"explicitHashKey":"' || explicit_hash_key || '"' END
          || ',"partitionKey":"' || partition_key || '"}}' AS audit FROM rec""",
)
def audit_json(spark, sf_dir):
    named = records(spark, sf_dir).select(
        "data", F.col("partition_key").alias("partitionKey"), F.col("explicit_hash_key").alias("explicitHashKey")
    )
    return R.to_audit_json(named)
