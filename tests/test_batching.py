import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from shardstream import Limits
from shardstream.operators.batching import OpenBatch, assign_batches, batch_summary, chunk_puts, group_within, with_request_index
from shardstream.operators.ordering import with_ordinal
from shardstream.operators.scan import next_starts

MIB = 1024 * 1024


def sizes(spark, rows, limits=Limits(), **options):
    df = spark.createDataFrame([("s", 0, i, *row) for i, row in enumerate(rows)], "stream_name string, put_id long, seq_in_put int, shard_id string, n_bytes long")
    batched = assign_batches(df, limits, **options)
    return [r["n"] for r in batched.groupBy("batch_no").agg(F.count("*").alias("n")).orderBy("batch_no").collect()]


def test_shard_bytes_limit(spark):
    assert sizes(spark, [("0", MIB // 3)] * 7) == [3, 3, 1]


def test_request_bytes_limit(spark):
    assert sizes(spark, [(str(i), 5 * MIB // 6) for i in range(14)]) == [6, 6, 2]


@pytest.mark.parametrize("one_shard", [True, False])
def test_request_count_limit(spark, one_shard):
    assert sizes(spark, [("0" if one_shard else str(i), 2) for i in range(1005)]) == [500, 500, 5]


def test_shard_count_limit(spark):
    assert sizes(spark, [("0", 1)] * 25, Limits(max_shard_records=10)) == [10, 10, 5]


def walk(rows, limits):
    """Batches by the definition, one record after another."""
    batches, count, total, shards = [], 0, 0, {}
    for shard, size in rows:
        c, b = shards.get(shard, (0, 0))
        fits = count + 1 <= limits.max_request_records and total + size <= limits.max_request_bytes
        fits = fits and (c == 0 or (c + 1 <= limits.max_shard_records and b + size <= limits.max_shard_bytes))
        if not count or not fits:
            batches.append(0)
            count, total, shards, c, b = 0, 0, {}, 0, 0
        batches[-1] += 1
        count, total = count + 1, total + size
        shards[shard] = (c + 1, b + size)
    return batches


LIMITS = Limits(max_request_records=7, max_request_bytes=60, max_shard_bytes=25, max_shard_records=4)
many = st.lists(st.tuples(st.sampled_from("abc"), st.integers(1, 30)), min_size=1, max_size=80)


@given(many)
@settings(max_examples=80, deadline=None)
def test_next_batch_start_from_every_row(rows):
    starts = next_starts(rows, len(rows), OpenBatch(LIMITS))
    assert [s - i for i, s in enumerate(starts)] == [walk(rows[i:], LIMITS)[0] for i in range(len(rows))]


@pytest.mark.parametrize("group_rows", [None, 7, 10, 64])
@pytest.mark.parametrize("partitions", [1, 16])
def test_blocks_give_the_same_batches(spark, group_rows, partitions):
    rows = [("abc"[i * i % 3], i * 7 % 29 + 1) for i in range(333)]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert sizes(spark, rows, LIMITS, group_rows=group_rows) == walk(rows, LIMITS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


@pytest.mark.parametrize("group_rows", [None, 20])
def test_request_index_counts_per_shard(spark, group_rows):
    rows = [("s", p, i, "ab"[i % 2], 1) for p in range(2) for i in range(50)]
    df = spark.createDataFrame(rows, "stream_name string, put_id long, seq_in_put int, shard_id string, n_bytes long")
    batched = assign_batches(df, Limits(max_request_records=15), group_rows=group_rows)
    again = with_request_index(batched.withColumnRenamed("request_index", "kept"))
    assert again.filter("kept = request_index").count() == 100
    assert batch_summary(batched).agg(F.sum("n_records")).first()[0] == 100


def test_arrow_batch_borders_do_not_show(spark):
    rows = [("abc"[i % 3], 3) for i in range(200)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert sizes(spark, rows, LIMITS) == walk(rows, LIMITS)
        assert sizes(spark, rows, LIMITS, group_rows=20) == walk(rows, LIMITS)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10000)


def chunks(spark, times, n, wait, **options):
    df = spark.createDataFrame([("s", i, t) for i, t in enumerate(times)], "k string, i long, t long")
    grouped = group_within(df, n, wait, ["k"], ["t", "i"], "t", **options)
    return [r["n"] for r in grouped.groupBy("chunk_no").agg(F.count("*").alias("n")).orderBy("chunk_no").collect()]


@pytest.mark.parametrize("options", [{}, {"group_rows": 5}])
def test_group_within(spark, options):
    assert chunks(spark, [0, 1, 2, 10, 11, 20, 21, 22, 23, 24, 25], 5, 10, **options) == [3, 2, 5, 1]
    assert chunks(spark, [0, 9, 10], 5, 10, **options) == [2, 1]


@pytest.mark.parametrize("group_rows", [1000, 10])
def test_ordinals_of_a_hot_group(spark, group_rows):
    df = spark.range(600).select(F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"), "id")
    numbered = with_ordinal(df.repartition(5), ["k"], ["id"], group_rows=group_rows)
    expected = F.row_number().over(Window.partitionBy("k").orderBy("id")) - 1
    assert numbered.withColumn("e", expected).filter("e <> ordinal").count() == 0
    assert numbered.count() == 600


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, i) for i in range(10)] + [("a", i) for i in range(3)], "k string, i long")
    for limit in (100, 2):
        top = with_ordinal(df, ["k"], ["i"], group_rows=limit).groupBy("k").agg(F.max("ordinal").alias("m")).collect()
        assert {r.k: r.m for r in top} == {None: 9, "a": 2}


def test_chunk_puts(spark):
    df = spark.createDataFrame([("s", i) for i in range(7)], "stream_name string, i long")
    puts = chunk_puts(df, 3, ["stream_name"], ["i"]).orderBy("i").collect()
    assert [(r.put_id, r.seq_in_put) for r in puts] == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2), (2, 0)]
