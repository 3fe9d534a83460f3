"""Remote-write requests and read requests as nested rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CORRUPT = "_corrupt_record"

SERIES_ARRAY = (
    "array<struct<"
    "labels:array<struct<name:string,value:string>>,"
    "samples:array<struct<value:double,timestamp:bigint>>>>"
)
REQUEST_SCHEMA = f"timeseries {SERIES_ARRAY}"
QUERY_SCHEMA = (
    "query_id int, start_ms bigint, end_ms bigint, "
    "matchers array<struct<type:string,name:string,value:string>>"
)


def read_write_requests(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    streaming: bool = False,
    **options: str,
) -> DataFrame:
    """Requests under ``path``, one row each; set ``streaming`` to follow it.

    JSON rows that do not parse keep their text in ``_corrupt_record``.
    """
    schema = REQUEST_SCHEMA + (f", {CORRUPT} string" if fmt == "json" else "")
    reader = spark.readStream if streaming else spark.read
    return reader.format(fmt).schema(schema).options(**options).load(path)


def parse_write_requests(df: DataFrame, payload: str) -> DataFrame:
    """Requests held as JSON text in column ``payload``, as a message bus has them."""
    return _parsed(df, payload, "timeseries", SERIES_ARRAY)


def read_requests(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Read requests: one row per query with its matchers and time range."""
    return spark.read.format(fmt).schema(QUERY_SCHEMA).load(path)


def _parsed(df: DataFrame, payload: str, root: str, root_type: str) -> DataFrame:
    schema = f"{root} {root_type}, {CORRUPT} string"
    record: Column = F.from_json(
        payload, schema, {"columnNameOfCorruptRecord": CORRUPT}
    )
    return df.withColumn("_record", record).select(
        *[c for c in df.columns if c != payload],
        F.col(f"_record.{root}").alias(root),
        F.col(f"_record.{CORRUPT}").alias(CORRUPT),
    )
