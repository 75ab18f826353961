import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shardstream.session import ship_code  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ship_code()
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def records(spark):
    """Make a table of records from (put, seq, key, data[, hash key]) rows of stream 's'."""

    def make(rows):
        full = [("s", *row, *[None] * (5 - len(row))) for row in rows]
        return spark.createDataFrame(
            full,
            "stream_name string, put_id long, seq_in_put int, partition_key string, data binary, explicit_hash_key string",
        )

    return make
