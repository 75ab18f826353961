"""Stream and consumer ARNs: parsed into columns with a parse error, and formatted again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The known regions by the partition their ARNs name.
REGIONS = {
    "aws": [
        "us-east-1", "us-east-2", "us-west-1", "us-west-2",
        "eu-west-1", "eu-west-2", "eu-west-3", "eu-central-1", "eu-north-1", "eu-south-1",
        "ap-east-1", "ap-south-1", "ap-southeast-1", "ap-southeast-2",
        "ap-northeast-1", "ap-northeast-2", "ap-northeast-3",
        "sa-east-1", "ca-central-1", "me-south-1", "af-south-1",
    ],
    "aws-us-gov": ["us-gov-east-1", "us-gov-west-1"],
    "aws-cn": ["cn-north-1", "cn-northwest-1"],
    "aws-iso": ["us-iso-east-1", "us-iso-west-1"],
    "aws-iso-b": ["us-isob-east-1"],
}


def arn_partition(region: Column) -> Column:
    """The ARN partition of a known region, else null."""
    known = F.lit(None).cast("string")
    for partition, regions in REGIONS.items():
        known = F.when(region.isin(regions), partition).otherwise(known)
    return known


def _piece(text: Column, separator: str, at: int) -> Column:
    return F.nullif(F.get(F.split(text, separator), F.lit(at)), F.lit(""))


def _stream_fields(arn: Column) -> tuple[Column, Column, Column, Column]:
    name, region, account = _piece(arn, "/", 1), _piece(arn, ":", 3), _piece(arn, ":", 4)
    unknown = F.concat(F.lit("unknown region: "), F.coalesce(region, F.lit("")))
    error = (
        F.when(name.isNull(), "no stream name")
        .when(region.isNull() | arn_partition(region).isNull(), unknown)
        .when(account.isNull(), "no account id")
    )
    return name, region, account, error


def parse_stream_arns(df: DataFrame, arn: str = "stream_arn") -> DataFrame:
    """Add stream_name, aws_region, account_id and arn_error; the three are null where the ARN is malformed."""
    name, region, account, error = _stream_fields(F.col(arn))
    return df.withColumn("arn_error", error).withColumns(
        {
            "stream_name": F.when(F.col("arn_error").isNull(), name),
            "aws_region": F.when(F.col("arn_error").isNull(), region),
            "account_id": F.when(F.col("arn_error").isNull(), account),
        }
    )


def parse_consumer_arns(df: DataFrame, arn: str = "consumer_arn") -> DataFrame:
    """Like :func:`parse_stream_arns` for consumer ARNs, with consumer_name and created_s (epoch seconds)."""
    text = F.col(arn)
    stream = F.get(F.split(text, "/consumer"), F.lit(0))
    name, region, account, stream_error = _stream_fields(stream)
    consumer = _piece(F.get(F.split(text, "/"), F.lit(3)), ":", 0)
    created = F.element_at(F.split(text, ":"), -1).try_cast("bigint")
    error = (
        F.when(stream_error.isNotNull(), stream_error)
        .when(consumer.isNull(), "no consumer name")
        .when(created.isNull(), "creation time is no number")
    )
    fields = {
        "stream_name": name, "aws_region": region, "account_id": account, "consumer_name": consumer, "created_s": created,
    }
    return df.withColumn("arn_error", error).withColumns(
        {k: F.when(F.col("arn_error").isNull(), v) for k, v in fields.items()}
    )


def stream_arn(region: str = "aws_region", account: str = "account_id", name: str = "stream_name") -> Column:
    where = arn_partition(F.col(region))
    return F.concat(F.lit("arn:"), where, F.lit(":kinesis:"), F.col(region), F.lit(":"), F.col(account), F.lit(":stream/"), F.col(name))


def format_stream_arns(df: DataFrame, into: str = "stream_arn") -> DataFrame:
    return df.withColumn(into, stream_arn())


def format_consumer_arns(df: DataFrame, into: str = "consumer_arn") -> DataFrame:
    created = F.col("created_s").cast("string")
    return df.withColumn(into, F.concat(stream_arn(), F.lit("/consumer/"), "consumer_name", F.lit(":"), created))
