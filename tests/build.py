"""Small inputs for tests."""

from pyspark.sql import functions as F

from metricloom.sources.agent import parse_agent_batches
from metricloom.sources.remote import REQUEST_SCHEMA


def series(name, labels, samples):
    """A remote series; ``labels`` is a list of pairs, ``samples`` of (ms, value)."""
    head = [] if name is None else [("__name__", name)]
    return ([*head, *labels], [(value, ms) for ms, value in samples])


def requests(spark, *all_series):
    return spark.createDataFrame([([s],) for s in all_series], REQUEST_SCHEMA)


def batches(spark, *payloads, srcip="10.0.0.1"):
    rows = spark.createDataFrame([(p,) for p in payloads], "payload string")
    return parse_agent_batches(rows.withColumn("srcip", F.lit(srcip)), "payload")


def one(spark, value, kind, expression):
    """Evaluate ``expression(column)`` on one value."""
    row = spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v")))
    return row.first()[0]


def many(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", expression(F.col("v"))).orderBy("i").collect()]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
