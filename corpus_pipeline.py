"""From documents to training sequences: reject bad text, keep one of near copies, drop contaminated documents, mask secrets, pack."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shardstream.llm import decontaminate, jaccard, packing, quality, secrets
from shardstream.session import materialize

# Near copies in the pipeline: shingles of five words, similarity of 0.8 or more.
NEAR = jaccard.Rule(k=5, percent=80)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (score of 0.3 or more), with their columns as they were.

    Each row is judged by its text, also rows that repeat or have no id; a null text is scored as an empty one.
    """
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least doc_id, one row of it.

    Texts are grouped, not ids: unrelated texts under one id all stay, as do rows without words (equal ones of one id as one row).
    """
    return jaccard.one_of_each(docs, NEAR)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a benchmark window; null and empty texts stay, repeated rows are judged alike."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, row by row, with secrets masked and n_chars following the text; null texts stay null."""
    return secrets.mask_secrets(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens, each filled to the sources' shares; with the token ids (16-bit).

    Each row is packed, also rows that repeat or have no id; null and empty texts are one closing token; a null source is one of its own.
    """
    return packing.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_copies", near_copy_stage),
    ("benchmark", benchmark_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

# A classifier and a tokenizer can't be said in SQL; tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; what a stage keeps is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
