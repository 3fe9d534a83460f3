"""Hot keys under the plans a cluster would run, with small thresholds."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from metricloom.functions import labels as L
from metricloom.operators import reads
from metricloom.operators.batch import distinct_series


def final_plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue().split("Initial Plan")[0]


def test_tags_join_splits_a_hot_series_when_both_sides_shuffle(spark, root):
    points = spark.range(0, 400_000, 1, 8).select(
        F.lit("s").alias("stream"),
        F.lit("m").alias("metric"),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000).cast("string").alias("series_key"),
        F.timestamp_millis("id").alias("ts"),
        F.col("id").cast("double").alias("value"),
    )
    series = points.select("stream", "metric", "series_key").distinct().withColumn(
        "labels", F.create_map(F.lit("k"), "series_key")
    )
    points.write.parquet(root + "/points")
    series.write.parquet(root + "/series")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = reads.with_tags(
            spark.read.parquet(root + "/points"), spark.read.parquet(root + "/series")
        ).select("value", F.col("labels")["k"].alias("k"))
        rows = joined.collect()
        assert "skew=true" in final_plan(joined)
        assert len(rows) == 400_000
        assert sum(r.k == "-1" for r in rows) == 133_334
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_series_folds_before_the_shuffle(spark):
    rows = spark.range(0, 300_000, 1, 8).select(
        F.lit("remote").alias("source"),
        F.lit("double").alias("kind"),
        F.lit("m").alias("metric"),
        F.lit("m").alias("metric_raw"),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1000).cast("string").alias("series_key"),
        F.lit(None).cast("string").alias("taghash"),
        F.array(L.pair(F.lit("k"), F.lit("v"))).alias("entries"),
    )
    series = distinct_series(rows)
    assert series.count() == 1001
    plan = final_plan(series)
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan
    assert plan.index("Exchange") < plan.rindex("HashAggregate")
