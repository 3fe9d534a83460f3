"""Points sent again, merged catalogues and chunked series."""

import random

import pytest
from pyspark.sql import functions as F

from build import requests, rows, series
from metricloom.functions import values
from metricloom.operators import catalog, reads
from metricloom.operators.matchers import Query
from metricloom.session import work_dir
from metricloom.sources.lake import Lake, compact, latest
from metricloom.streaming.ingest import ingest_batch

EVERY = Query.of(0, 4_000_000_000_000, ("RE", "__name__", "."))
NAN = float("nan")


def ingest(lake, batch_id, *all_series, stream=None):
    ingest_batch(lake, requests(lake.spark, *all_series), batch_id=batch_id, stream=stream)


def flat(points):
    return rows(points.select("metric", values.to_ms(F.col("ts")), "value"))


def test_latest_batch_wins(spark, root):
    lake = Lake(spark, root)
    ingest(lake, 0, series("m", [("h", "1")], [(1, 5.0), (2, 6.0), (3, 7.0)]), series("n", [], [(1, 1.0)]))
    ingest(lake, 1, series("m", [("h", "1")], [(1, 1.0), (1, 2.0), (2, NAN)]), series("m", [("h", "2")], [(1, 9.0)]))
    want = [("m", 1, 2.0), ("m", 1, 9.0), ("m", 2, None), ("m", 3, 7.0), ("n", 1, 1.0)]
    assert flat(reads.read_latest(lake, EVERY)) == sorted(want, key=repr)
    one = Query.of(2, 3, ("EQ", "__name__", "m"), ("EQ", "h", "1"))
    assert flat(reads.read_latest(lake, one)) == [("m", 2, None), ("m", 3, 7.0)]
    ingest(lake, 0, series("m", [("h", "1")], [(1, 8.0), (2, 6.0), (3, 7.0)]), series("n", [], [(1, 1.0)]))
    assert flat(reads.read_latest(lake, EVERY)) == sorted(want, key=repr)
    target = Lake(spark, f"{root}-new")
    compact(lake, target, latest_only=True)
    assert flat(reads.read_points(target, EVERY)) == sorted(want, key=repr)
    ingest(target, 0, series("m", [("h", "1")], [(3, 0.0)]))
    assert ("m", 3, 0.0) in flat(reads.read_latest(target, EVERY))
    assert latest(lake.points().limit(0)).count() == 0


def test_streams_keep_their_own_latest(spark, root):
    lake = Lake(spark, root)
    ingest(lake, 3, series("m", [], [(1, 1.0)]), stream="a")
    ingest(lake, 0, series("m", [], [(1, 2.0)]), stream="b")
    assert flat(reads.read_latest(lake, EVERY)) == [("m", 1, 1.0), ("m", 1, 2.0)]


def merged_is_full(lake):
    assert rows(catalog.merged_metrics(lake)) == rows(catalog.list_metrics(lake.series()))
    assert rows(catalog.merged_tag_schema(lake)) == rows(catalog.infer_tag_schema(lake.series()))


def test_catalogue_merges_to_a_full_count(spark, root):
    lake = Lake(spark, root)
    assert catalog.merged_metrics(lake).count() == 0
    ingest(lake, 0, series("a", [("h", "1")], [(1, 1.0)]), series("b", [], [(1, 1.0)]))
    second = [series("a", [("h", "1")], [(2, 1.0)]), series("a", [("h", "2"), ("z", "1")], [(2, 1.0)])]
    ingest(lake, 1, *second)
    ingest(lake, 2, series("b", [("h", "1")], [(3, 1.0)]), series("c", [("x", "")], [(3, 1.0)]))
    merged_is_full(lake)
    ingest(lake, 1, *second)
    merged_is_full(lake)
    ingest(lake, 0, series("a", [("h", "1")], [(1, 1.0)]), series("a", [("h", "9")], [(1, 1.0)]), stream="other")
    merged_is_full(lake)
    ingest_batch(lake, requests(spark, *second).limit(0), batch_id=3)
    merged_is_full(lake)
    fresh = lake.series().limit(1).withColumn("labels", F.create_map(F.lit("new"), F.lit("1")))
    assert [r["tag"] for r in catalog.unknown_tags(fresh, lake).collect()] == ["new"]
    assert catalog.unknown_tags(lake.series(), lake).count() == 0
    target = Lake(spark, f"{root}-new")
    compact(lake, target)
    merged_is_full(target)
    lake.abandon("remote", 2)
    merged_is_full(lake)


def test_width_of_wide_tables_is_the_callers(spark, root):
    lake = Lake(spark, root)
    ingest(lake, 0, series("m", [("a", "1"), ("b", "2")], [(1, 1.0)]))
    with pytest.raises(ValueError, match="more than 4 columns"):
        catalog.wide_view(lake, "m", max_columns=4)
    for most in (5, None):
        assert len(catalog.wide_view(lake, "m", max_columns=most).columns) == 5


@pytest.mark.parametrize("partitions", ["1", "3", "11"])
def test_chunks_are_cut_alike_under_every_partitioning(spark, partitions):
    rng = random.Random(3)
    names = ["hot"] * 12 + ["cold", "few"]
    data = [
        (rng.choice(names), {"h": "1"} if i % 9 else {}, rng.randrange(60), rng.choice([None, 1.0, 2.0]))
        for i in range(700)
    ]
    points = spark.createDataFrame(data, "metric string, labels map<string,string>, ms long, value double")
    points = points.withColumn("ts", F.timestamp_millis("ms")).drop("ms").repartition(7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.enabled", str(partitions != "11").lower())
        got = reads.series_chunks(points, chunk_rows=16, work=work_dir(spark, "chunks")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    found = {}
    for r in got:
        key = tuple((p["name"], p["value"]) for p in r["labels"])
        samples = [(round(s["ts"].timestamp() * 1000), s["value"]) for s in r["samples"]]
        assert (r["first_ts"], r["last_ts"]) == (r["samples"][0]["ts"], r["samples"][-1]["ts"])
        found[key, r["chunk"]] = samples
    want = {}
    for metric, labels, ms, value in data:
        want.setdefault((("__name__", metric), *labels.items()), []).append((ms, value))
    cut = {}
    for key, samples in want.items():
        samples.sort(key=lambda s: (s[0], s[1] is not None, s[1] or 0))
        for i in range(0, len(samples), 16):
            cut[key, i // 16] = samples[i:i + 16]
    assert found == cut and len(got) == len(cut)


def test_chunks_of_nothing_and_of_no_size(spark):
    points = spark.createDataFrame([], "metric string, labels map<string,string>, ts timestamp, value double")
    assert reads.series_chunks(points).count() == 0
    with pytest.raises(ValueError):
        reads.series_chunks(points, chunk_rows=0)
