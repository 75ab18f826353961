"""The registered queries against their SQL, and the pipeline stage by stage."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import check  # noqa: E402
import corpus_pipeline  # noqa: E402
from shardstream.llm import secrets  # noqa: E402
from shardstream.llm.queries import ORACLES, QUERIES  # noqa: E402
from tables import documents  # noqa: E402
from test_models import brute_groups  # noqa: E402
from test_scans import brute_overlap  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    connection = duckdb.connect()
    for table in check.TABLES.split():
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    assert check.compare(spark, connection, name, SF_DIR).startswith("ok" if name in ORACLES else "rows")


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.materialize(stage(spark, before, SF_DIR))
        assert after.columns == docs.columns
        texts, kept = ({r["doc_id"]: r["text"] for r in frame.collect()} for frame in (before, after))
        if name == "near_copies":
            assert set(kept) == {root for _, root in brute_groups(texts, 5, 80).values()}
        elif name == "benchmark":
            want = {d for d, t in texts.items() if not (lambda n, hit, _: hit and 20 * hit >= n)(*brute_overlap(t, items))}
            assert set(kept) == want and len(want) < len(texts)
        elif name == "secrets":
            assert kept == {d: secrets.masked(t) for d, t in texts.items()}
        if name != "secrets":
            assert all(texts[d] == t for d, t in kept.items()) and len(kept) < len(texts)
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, SF_DIR)
    assert pieces.select("doc_id").distinct().count() == before.count()


def test_stages_take_odd_rows(spark):
    for empty in (False, True):
        docs = documents(spark)
        docs = docs.limit(0) if empty else docs
        for _, stage in corpus_pipeline.STAGES:
            out = corpus_pipeline.materialize(stage(spark, docs, SF_DIR))
            assert empty == (out.count() == 0)
