"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from metricloom.session import work_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str, *partition_by: str) -> DataFrame:
    """``df`` written as Parquet in the shared working folder and read back.

    Cuts lineage: a lost executor costs a re-read, not a recomputation.
    """
    path = work_dir(df.sparkSession, f"llm-{purpose}")
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    Catalyst may inline a projected column into each use, also into a lambda
    that runs per element; a lambda's own argument is never recomputed.
    """
    return F.transform(F.array(value), lambda x: body(x))[0]


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z, and no other letter, in lower case."""
    return F.translate(
        text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
