"""Collector-agent batches as nested rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from metricloom import fixed
from metricloom.sources.remote import CORRUPT, _parsed

METRIC_ARRAY = (
    "array<struct<name:string,tags:map<string,string>,"
    "fields:map<string,variant>,timestamp:bigint>>"
)


def read_agent_batches(
    spark: SparkSession,
    path: str,
    srcip: Column | None = None,
    streaming: bool = False,
    **options: str,
) -> DataFrame:
    """JSON batches under ``path``, one row each, with the sender's address.

    The address is ``srcip`` when given, else the ``srcip`` key of the batch.
    Keys outside the schema are ignored, so a bare metric object is a batch
    of no metrics.
    """
    schema = f"metrics {METRIC_ARRAY}, {fixed.SOURCE_TAG} string, {CORRUPT} string"
    reader = spark.readStream if streaming else spark.read
    batches = reader.format("json").schema(schema).options(**options).load(path)
    return batches if srcip is None else batches.withColumn(fixed.SOURCE_TAG, srcip)


def parse_agent_batches(df: DataFrame, payload: str) -> DataFrame:
    """Batches held as JSON text in ``payload``; ``srcip`` is a column of ``df``."""
    return _parsed(df, payload, "metrics", METRIC_ARRAY)
