"""Export of metric datums: numbered requests of JSON datums, written per namespace."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import DATUM_NAMESPACE, DATUMS_PER_REQUEST, number_requests


def datum_requests(datums: DataFrame, namespace: str = DATUM_NAMESPACE, per_request: int = DATUMS_PER_REQUEST) -> DataFrame:
    """Each datum as JSON with the namespace, export time and number of the request it belongs to."""
    placed = datums.withColumn("namespace", F.lit(namespace)).withColumn("__dims", F.to_json("dimensions"))
    numbered = number_requests(placed, ["namespace", "timestamp_ms"], ["metric_name", "__dims"], per_request)
    return numbered.select(
        "namespace", "timestamp_ms", "request_no", F.to_json(F.struct(*[F.col(c) for c in datums.columns])).alias("datum")
    )


def write_datums(
    datums: DataFrame, path: str, namespace: str = DATUM_NAMESPACE, mode: str = "append", per_request: int = DATUMS_PER_REQUEST
) -> None:
    datum_requests(datums, namespace, per_request).write.mode(mode).partitionBy("namespace").json(path)
