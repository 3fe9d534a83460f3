import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from build import batches, requests, rows, series
from metricloom.config import IngestOptions
from metricloom.functions import values
from metricloom.operators import catalog, reads
from metricloom.operators.matchers import Query
from metricloom.sources import lake as lake_module
from metricloom.sources.lake import Lake, compact, ensure_namespace
from metricloom.sources.remote import read_requests, read_write_requests
from metricloom.session import work_dir
from metricloom.streaming.ingest import follow, ingest_batch, start_ingest

DAY = 86_400_000
EVERY = Query.of(0, 4_000_000_000_000, ("RE", "__name__", "."))


def flat(points):
    return rows(points.select("metric", "labels", values.to_ms(F.col("ts")), "value"))


def sample_requests(spark, n=60, metrics=("a", "b", "123")):
    rng = random.Random(7)
    return [
        series(rng.choice(metrics), [("host", f"h{rng.randrange(5)}")],
               [(rng.randrange(400) * DAY + rng.randrange(DAY), float(i))])
        for i in range(n)
    ]


def expected(all_series):
    return sorted(
        ((labels[0][1], dict(labels[1:]), ms, value) for labels, samples in all_series for value, ms in samples),
        key=repr,
    )


@pytest.mark.parametrize("grain", ["day", "month"])
def test_round_trip_and_ranges(spark, root, grain):
    lake = Lake(spark, root, grain)
    source = sample_requests(spark)
    assert ingest_batch(lake, requests(spark, *source)) == {"points": 60, "rejected": 0}
    every = expected(source)
    assert flat(reads.read_points(lake, EVERY)) == every
    for lo, hi in [(0, DAY), (31 * DAY, 32 * DAY), (59 * DAY - 1, 200 * DAY), (399 * DAY, 900 * DAY)]:
        got = flat(reads.read_points(lake, Query.of(lo, hi, ("RE", "__name__", "."))))
        assert got == [p for p in every if lo <= p[2] <= hi]
    assert flat(catalog.scan_metric(lake, "123")) == [p for p in every if p[0] == "123"]


def test_lake_does_not_depend_on_the_session_time_zone(spark, root):
    source = sample_requests(spark)
    zones = ["Asia/Tokyo", "America/Los_Angeles", "UTC"]
    try:
        for i, zone in enumerate(zones):
            spark.conf.set("spark.sql.session.timeZone", zone)
            ingest_batch(Lake(spark, root, "month"), requests(spark, *source[i * 20:(i + 1) * 20]), batch_id=i)
        every = expected(source)
        for zone in zones:
            spark.conf.set("spark.sql.session.timeZone", zone)
            for lo, hi in [(31 * DAY, 59 * DAY - 1), (90 * DAY, 120 * DAY)]:
                got = flat(reads.read_points(Lake(spark, root), Query.of(lo, hi, ("RE", "__name__", "."))))
                assert got == [p for p in every if lo <= p[2] <= hi]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_empty_lake(spark, root):
    lake = Lake(spark, root)
    assert reads.read_points(lake, EVERY).count() == 0
    assert catalog.list_metrics(lake.series()).count() == 0
    with pytest.raises(ValueError):
        catalog.wide_view(lake, "m")


def test_replay_replaces_its_own_batch_only(spark, root):
    lake = Lake(spark, root)
    first = [series("a", [("h", "1")], [(1, 1.0)]), series("b", [("h", "1")], [(2, 2.0)])]
    later = [series("a", [("h", "1")], [(3, 3.0)]), series("c", [], [(4, 4.0)]), series(None, [], [(1, 1.0)])]
    ingest_batch(lake, requests(spark, *first), batch_id=0)
    ingest_batch(lake, requests(spark, *later), batch_id=1)
    before = flat(reads.read_points(lake, EVERY))
    for batch_id, part in ((0, first), (1, later), (1, later)):
        ingest_batch(lake, requests(spark, *part), batch_id=batch_id)
        assert flat(reads.read_points(lake, EVERY)) == before
    assert lake.series().count() == 3
    assert lake.rejected().count() == 1
    ingest_batch(lake, requests(spark, *first[:1]), batch_id=0)
    assert flat(reads.read_points(lake, EVERY)) == [p for p in before if p[0] != "b"]
    ingest_batch(lake, requests(spark, first[0]).limit(0), batch_id=0)
    assert [p[0] for p in flat(lake.points().join(lake.series().select("series_key", "labels"), "series_key"))] == ["c"]


@pytest.mark.parametrize("limit", [0, 200_000])
def test_series_are_registered_once(spark, root, limit, monkeypatch):
    monkeypatch.setattr(lake_module, "BROADCAST_SERIES", limit)
    lake = Lake(spark, root)
    for batch_id, hosts in enumerate((["1", "2"], ["2", "3"], ["1", "3", "4"])):
        source = [series("m", [("h", h)], [(batch_id, 1.0)]) for h in hosts]
        ingest_batch(lake, requests(spark, *source), batch_id=batch_id)
    got = rows(lake.series().select("batch_id", F.col("labels")["h"]))
    assert got == [(0, "1"), (0, "2"), (1, "3"), (2, "4")]


def test_streams_share_a_lake(spark, root):
    lake = Lake(spark, root)
    source = requests(spark, series("m", [("h", "1")], [(1, 1.0)]))
    ingest_batch(lake, source, stream="east")
    ingest_batch(lake, source, stream="west")
    assert flat(reads.read_points(lake, EVERY)) == [("m", {"h": "1"}, 1, 1.0)] * 2
    assert reads.series_count(reads.read_points(lake, EVERY)).first().series == 1
    assert rows(catalog.list_metrics(lake.series()).select("name", "tables")) == [("m", 1)]


def test_hot_metric_is_written_by_many_tasks(spark, root):
    lake = Lake(spark, root)
    hot = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("m"), (F.col("id") % 5).cast("string"))).otherwise("hot").alias("metric"),
        F.md5(F.col("id").cast("string")).alias("series_key"),
        F.timestamp_millis(F.col("id")).alias("ts"),
        F.col("id").cast("double").alias("value"),
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        lake._write_points(hot, "samples/stream=s/batch_id=0")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = list(Path(root).glob("samples/stream=s/batch_id=0/period=*/metric=hot/*.parquet"))
    assert len(files) > 4
    assert lake.points().count() == 200_000
    assert lake.points().select("series_key").distinct().count() == 200_000


@pytest.mark.parametrize("tasks", [1, 4, 64])
def test_frames_of_a_hot_series_do_not_depend_on_partitions(spark, tasks):
    hot = spark.range(0, 30_000, 1, 8).select(
        F.lit("m").alias("metric"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 10).otherwise(-1).cast("string").alias("series_key"),
        F.timestamp_millis((F.col("id") * 7919) % 5000 - 700).alias("ts"),
        F.col("id").cast("double").alias("value"),
    ).withColumn("labels", F.create_map(F.lit("k"), "series_key"))
    frames = reads.series_frames(hot.repartition(tasks), frame_ms=1000).collect()
    expected = {}
    for p in hot.select("series_key", F.unix_millis("ts").alias("ms"), "value").collect():
        expected.setdefault((p.series_key, p.ms // 1000 * 1000), []).append((p.ms, p.value))
    got = {}
    for frame in frames:
        assert frame.labels[0] == ("__name__", "m")
        samples = [(round(s["ts"].timestamp() * 1000), s["value"]) for s in frame.samples]
        assert (frame.first_ts, frame.last_ts) == (frame.samples[0]["ts"], frame.samples[-1]["ts"])
        got[frame.labels[1]["value"], round(frame.frame_start.timestamp() * 1000)] = samples
    assert len(got) == len(frames)
    assert got == {k: sorted(v) for k, v in expected.items()}


def test_equal_stored_label_sets_are_one_series(spark, root):
    lake = Lake(spark, root)
    ingest_batch(lake, requests(
        spark,
        series("a:b", [("k", 'x"y')], [(1, 1.0)]),
        series("a_b", [("k", "x'y")], [(2, 2.0)]),
    ))
    assert lake.series().count() == 2
    points = reads.read_points(lake, EVERY)
    assert reads.series_count(points).first().series == 1
    (row,) = reads.read_series(lake, EVERY).collect()
    assert [s["value"] for s in row.samples] == [1.0, 2.0]


def test_many_requests_are_planned(spark, root):
    lake = Lake(spark, root)
    ingest_batch(lake, requests(spark, series("m", [("h", "1")], [(1, 1.0)])))
    queries = [Query.of(0, 10, ("EQ", "__name__", "m"), ("EQ", "h", str(i % 2))) for i in range(400)]
    assert reads.read_many(lake, queries).count() == 200


def test_small_read_gives_one_row_per_series(spark, root):
    lake = Lake(spark, root)
    ingest_batch(lake, requests(spark, series("m", [("h", "1")], [(3, 3.0), (1, 1.0), (2, None)])))
    (row,) = reads.read_series(lake, EVERY).collect()
    assert [s["value"] for s in row.samples] == [1.0, None, 3.0]


def test_many_queries_and_their_merge(spark, root):
    lake = Lake(spark, root)
    source = sample_requests(spark)
    ingest_batch(lake, requests(spark, *source))
    queries = [
        Query.of(0, 200 * DAY, ("EQ", "__name__", "a"), ("EQ", "host", "h1")),
        Query.of(100 * DAY, 400 * DAY, ("RE", "__name__", "a|b")),
        Query.of(0, 1, ("EQ", "__name__", "absent")),
        Query.of(0, 400 * DAY, ("NEQ", "__name__", "a")),
    ]
    one_by_one = [flat(reads.read_points(lake, q)) for q in queries]
    many = reads.read_many(lake, queries)
    for i, alone in enumerate(one_by_one):
        assert flat(many.where(F.col("query_id") == i)) == alone
    merged = flat(reads.read_many(lake, queries, merge_queries=True))
    assert merged == sorted((p for part in one_by_one for p in part), key=repr)
    by_query = reads.series_frames(many, ["query_id"])
    assert by_query.agg(F.sum(F.size("samples"))).first()[0] == len(merged)
    with pytest.raises(ValueError):
        reads.read_many(lake, [])


def test_read_requests_and_written_answer(spark, root, tmp_path):
    lake = Lake(spark, root)
    ingest_batch(lake, requests(spark, series("go_goroutines", [("job", "prometheus")], [(1618085130781, 1.0), (1619863860781, 2.0), (1619863860782, 3.0)])))
    request = {"query_id": 4, "start_ms": 1618085130781, "end_ms": 1619863860781,
               "matchers": [{"type": "EQ", "name": "job", "value": "prometheus"},
                            {"type": "EQ", "name": "__name__", "value": "go_goroutines"}]}
    (tmp_path / "q.json").write_text(json.dumps(request))
    queries = reads.queries_of(read_requests(spark, str(tmp_path)))
    frames = reads.series_frames(reads.read_many(lake, queries), ["query_id"])
    reads.write_series(frames, root + "/answer")
    answer = [json.loads(line) for line in spark.read.text(root + "/answer").toPandas()["value"]]
    answer.sort(key=lambda row: row["frame_start"])
    assert answer == [{
        "query_id": 4,
        "labels": [{"name": "__name__", "value": "go_goroutines"}, {"name": "job", "value": "prometheus"}],
        "frame_start": day * DAY,
        "samples": [{"value": value, "timestamp": ms}],
    } for ms, value in ((1618085130781, 1.0), (1619863860781, 2.0)) for day in [ms // DAY]]


def agent_payload(i, **fields):
    return json.dumps({"metrics": [{"name": "cpu", "tags": {"host": f"h{i}"}, "fields": fields, "timestamp": i}]})


def test_catalogue_views_and_twins(spark, root):
    lake = Lake(spark, root)
    ingest_batch(lake, requests(spark, series("up", [("job", "j"), ("A", "b")], [(1, 1.0)]), series("up", [("z", "1")], [(2, 2.0)]), series("bare", [], [(3, 3.0)])))
    ingest_batch(lake, batches(spark, agent_payload(1, x=1, s="t"), agent_payload(2, x=2)), "agent", options=IngestOptions.for_agent())
    assert rows(catalog.list_metrics(lake.series()).select("name", "columns", "tags", "tables")) == [
        ("bare", 2, 1, 1), ("cpu", 2, 3, 2), ("cpu_str", 2, 3, 1), ("up", 2, 4, 2),
    ]
    assert rows(catalog.infer_tag_schema(lake.series()).where("metric = 'cpu_str'").select("position", "tag", "kind")) == [
        (1, "host", "string"), (2, "srcip", "string"), (3, "field", "string"),
    ]
    up = catalog.wide_view(lake, "up")
    assert up.columns == ["ts", "value", "taghash", "t_a", "t_job", "t_z"]
    assert rows(up.drop("ts", "taghash")) == [(1.0, "b", "j", None), (2.0, None, None, "1")]
    assert catalog.wide_view(lake, "up", tags=["z"]).columns == ["ts", "value", "taghash", "t_z"]
    assert catalog.wide_view(lake, "bare").columns == ["ts", "value", "taghash"]
    assert rows(catalog.wide_view(lake, "cpu_str").drop("ts")) == [("t", "h1", "10.0.0.1", "s")]
    catalog.publish_view(lake, "cpu")
    assert rows(spark.sql("SELECT host, sum(value) FROM cpu GROUP BY host")) == [("h1", 1.0), ("h2", 2.0)]
    with pytest.raises(ValueError):
        catalog.wide_view(lake, "absent")
    described = rows(catalog.describe_metric(lake.series(), "up", tag_bytes=64).select("position", "field", "length"))
    assert described == [(1, "ts", 8), (2, "value", 8), (3, "taghash", 34), (4, "t_a", 64), (5, "t_job", 64), (6, "t_z", 64)]


def test_new_tags_are_found_per_metric(spark, root):
    lake = Lake(spark, root)
    ingest_batch(lake, requests(spark, series("a", [("x", "1")], [(1, 1.0)]), series("b", [("y", "1")], [(1, 1.0)])))
    ingest_batch(lake, requests(spark, series("a", [("X", "2"), ("y", "1")], [(1, 1.0)])), batch_id=1)
    old, new = lake.series().where("batch_id = 0"), lake.series().where("batch_id = 1")
    assert rows(catalog.detect_new_tags(new, old)) == [("remote", "a", "y")]


def test_compaction_keeps_every_row(spark, root):
    lake, target = Lake(spark, root + "/old"), Lake(spark, root + "/new", "month")
    source = sample_requests(spark)
    for i in range(3):
        ingest_batch(lake, requests(spark, *source[i * 20:(i + 1) * 20], series(None, [], [])), batch_id=i)
    ingest_batch(lake, batches(spark, agent_payload(1, x=1, s="t")), "agent")
    compact(lake, target)
    assert flat(reads.read_points(target, EVERY)) == flat(reads.read_points(lake, EVERY))
    assert rows(catalog.list_metrics(target.series())) == rows(catalog.list_metrics(lake.series()))
    assert rows(catalog.wide_view(target, "cpu_str")) == rows(catalog.wide_view(lake, "cpu_str"))
    assert target.rejected().count() == 3
    with pytest.raises(ValueError):
        compact(lake, lake)


def request_json(spark, *all_series):
    return "\n".join(requests(spark, *all_series).toJSON().collect()) + "\n"


def test_stream_equals_batch_and_resumes(spark, root, tmp_path):
    source = sample_requests(spark, 90)
    lake, checkpoint = Lake(spark, root + "/lake"), root + "/checkpoint"
    reports = []

    def run():
        stream = follow(spark, str(tmp_path), options=IngestOptions(batch_size=1))
        start_ingest(lake, stream, checkpoint, trigger={"availableNow": True},
                     report=lambda batch_id, counts: reports.append((batch_id, counts["points"]))).awaitTermination()

    for i in range(2):
        (tmp_path / f"{i}.json").write_text(request_json(spark, *source[i * 30:(i + 1) * 30]))
    run()
    assert reports == [(0, 30), (1, 30)]
    (tmp_path / "2.json").write_text(request_json(spark, *source[60:], series("late", [], [(5, 1.0)])) + "{bad\n")
    run()
    assert reports[2:] == [(2, 31)]
    whole = Lake(spark, root + "/whole")
    ingest_batch(whole, read_write_requests(spark, str(tmp_path)))
    assert flat(reads.read_points(lake, EVERY)) == flat(reads.read_points(whole, EVERY))
    columns = ["metric", "series_key", "labels", "taghash"]
    assert rows(lake.series().select(*columns)) == rows(whole.series().select(*columns))
    assert rows(lake.rejected().select("reason", "payload")) == [("malformed_request", "{bad")]


def test_agent_stream(spark, root, tmp_path):
    lake = Lake(spark, root + "/lake")
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(agent_payload(i, x=i, s=f"t{i}", bad=True) + "\n")
    options = IngestOptions.for_agent(batch_size=2)
    start_ingest(lake, follow(spark, str(tmp_path), "agent", options), root + "/checkpoint", "agent",
                 options, trigger={"availableNow": True}).awaitTermination()
    assert rows(catalog.wide_view(lake, "cpu").select("host", "field", "value")) == [
        ("h0", "x", 0.0), ("h1", "x", 1.0), ("h2", "x", 2.0)]
    assert rows(catalog.wide_view(lake, "cpu_str").select("value")) == [("t0",), ("t1",), ("t2",)]
    assert rows(lake.rejected().select("reason").distinct()) == [("field_type",)]
    assert rows(lake.series().select("batch_id").distinct()) == [(0,), (1,)]


def test_unknown_source_and_grain(spark, root):
    with pytest.raises(ValueError):
        follow(spark, root, "other")
    with pytest.raises(ValueError):
        ingest_batch(Lake(spark, root), requests(spark, series("m", [], [])), "other")
    with pytest.raises(ValueError):
        Lake(spark, root, "year")
    with pytest.raises(ValueError):
        Lake(spark, root).points("bool")


def test_namespace(spark):
    before = spark.catalog.currentDatabase()
    try:
        ensure_namespace(spark, "prometheus")
        ensure_namespace(spark, "prometheus")
        assert spark.catalog.currentDatabase() == "prometheus"
    finally:
        spark.catalog.setCurrentDatabase(before)


def test_input_is_dealt_out_on_request(spark, root):
    source = requests(spark, series("m", [("h", "1")], [(1, 1.0)])).coalesce(1)
    plans = []
    for tasks in (None, 3):
        lake = Lake(spark, f"{root}/{tasks}")
        ingest_batch(lake, source, options=IngestOptions(input_tasks=tasks))
        plans.append(flat(reads.read_points(lake, EVERY)))
    assert plans == [[("m", {"h": "1"}, 1, 1.0)]] * 2


def test_work_dir_uses_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = work_dir(spark, "x")
    assert path != work_dir(spark, "x")
    assert base is None or path.startswith(base)


def test_registering_opens_only_the_buckets_of_a_batch(spark, root):
    lake = Lake(spark, root)
    for batch_id in range(3):
        hosts = [f"h{batch_id}-{i}" for i in range(120)]
        ingest_batch(lake, requests(spark, *[series("m", [("h", h)], [(1, 1.0)]) for h in hosts]), batch_id=batch_id, stream="s")
    every = lake.series().inputFiles()
    few = lake.series().where("labels['h'] in ('h0-1', 'h1-7')").select("metric", "series_key")
    known = lake.known_series("s", 3, few)
    read = {r[0] for r in known.select(F.input_file_name()).distinct().collect()}
    buckets = {r[0] for r in few.select(lake_module.series_bucket()).collect()}
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in read} == buckets
    assert known.join(few, ["metric", "series_key"]).count() == 2
    assert len(every) > 100 and len(read) <= 6
    before = rows(lake.series().select("series_key", "batch_id"))
    ingest_batch(lake, requests(spark, *[series("m", [("h", h)], [(2, 2.0)]) for h in ("h0-1", "new", "h2-119")]), batch_id=3, stream="s")
    assert len(rows(lake.series().select("series_key", "batch_id"))) == len(before) + 1
    assert rows(lake.series().where("batch_id = 3").select("labels")) == [({"h": "new"},)]
