"""Replay of a metric log.

A log is a run of line pairs: a value line, then the label line of the same
sample::

    <p0> <p1> <date> <time> MARK1  Ts: 1576466279341, value: 37.000000,
    <p0> <p1> <date> <time> MARK2 metric_name{a="b", c="d"}

The value marker is used as the record separator of the text source. Each
record then holds a value line's tail and the label lines after it, so lines
are paired by the reader itself: files stay splittable at any size and no
shuffle, window or whole-file row is needed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from metricloom import fixed
from metricloom.sources.remote import SERIES_ARRAY

# The parts of a record.
SAMPLE = r"^\s*Ts: (-?\d+), value: ([^,\s]+),"
LABEL_LINE = r"(\S+) {marker} ([^\r\n]*)"
METRIC = r"^([^{]*)"
LABEL = r'([^\s,{}="]+)="((?:[^"\\]|\\.)*)"'


def read_metric_log(
    spark: SparkSession,
    path: str,
    value_marker: str = fixed.LOG_VALUE_MARKER,
    label_marker: str = fixed.LOG_LABEL_MARKER,
) -> DataFrame:
    """One write request per logged sample, with the label line's ``log_time``.

    A value line that no label line follows gives a series without a name,
    which normalisation rejects with a reason.
    """
    label_line = LABEL_LINE.replace("{marker}", re.escape(label_marker))
    lines = (
        spark.read.option("lineSep", value_marker)
        .text(path)
        .select(
            F.regexp_extract("value", SAMPLE, 1).try_cast("bigint").alias("ms"),
            F.regexp_extract("value", SAMPLE, 2).try_cast("double").alias("number"),
            F.regexp_extract_all("value", F.lit(label_line), F.lit(0)).alias("lines"),
        )
        .where("ms is not null")
        .select("ms", "number", F.explode_outer("lines").alias("line"))
        .select(
            "ms",
            "number",
            F.regexp_extract("line", label_line, 1).alias("log_time"),
            F.regexp_extract("line", label_line, 2).alias("series"),
        )
    )
    name = F.trim(F.regexp_extract("series", METRIC, 1))
    tags = F.arrays_zip(
        F.regexp_extract_all("series", F.lit(LABEL), F.lit(1)).alias("name"),
        F.regexp_extract_all("series", F.lit(LABEL), F.lit(2)).alias("value"),
    )
    named = F.array(
        F.struct(F.lit(fixed.NAME_LABEL).alias("name"), name.alias("value"))
    )
    entry = F.struct(
        F.when(F.col("line_found"), F.concat(named, tags)).alias("labels"),
        F.array(
            F.struct(F.col("number").alias("value"), F.col("ms").alias("timestamp"))
        ).alias("samples"),
    )
    return lines.withColumn("line_found", F.col("series").isNotNull()).select(
        "log_time", F.array(entry).cast(SERIES_ARRAY).alias("timeseries")
    )
