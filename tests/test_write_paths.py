import hashlib
import json

from build import batches, requests, rows, series
from metricloom.functions import values
from metricloom.operators import agent, remote
from metricloom.sources.agent import read_agent_batches
from metricloom.sources.logreplay import read_metric_log
from metricloom.sources.remote import parse_write_requests, read_write_requests
from pyspark.sql import functions as F


def points(batch):
    return rows(batch.points.select("metric", values.to_ms(F.col("ts")), "value"))


def test_remote_points_and_series(spark):
    batch = remote.normalise_requests(
        requests(
            spark,
            series("node:cpu", [("Job", "a"), ("job", 'b"')], [(1, 1.5), (2, float("nan"))]),
            series("lonely", [], [(3, 2.0)]),
            series("none", [("a", "b")], []),
            series(None, [("a", "b")], [(4, 1.0)]),
            series("", [("a", "b")], [(5, 1.0)]),
        )
    )
    assert points(batch) == [("lonely", 3, 2.0), ("node_cpu", 1, 1.5), ("node_cpu", 2, None)]
    assert rows(batch.series.select("metric", "metric_raw", "labels")) == [
        ("lonely", "lonely", {}), ("node_cpu", "node:cpu", {"job": "b'"}), ("none", "none", {"a": "b"}),
    ]
    assert [r[:2] for r in rows(batch.rejected)] == [("remote", "empty_name"), ("remote", "missing_name")]
    payload = json.loads(batch.rejected.where("reason = 'missing_name'").first()["payload"])
    assert payload == {"labels": [{"name": "a", "value": "b"}], "samples": [{"value": 1.0, "timestamp": 4}]}


def test_first_only(spark):
    source = requests(spark, series("m", [], [(1, 1.0), (2, 2.0), (3, 3.0)]), series("m", [], []))
    assert points(remote.normalise_requests(source, first_only=True)) == [("m", 1, 1.0)]


def test_every_sample_of_every_order_is_kept_once(spark):
    source = requests(spark, *[series("m", [], [(t, float(t))]) for t in (1000, 2000, 1000)])
    assert [p[1] for p in points(remote.normalise_requests(source))] == [1000, 1000, 2000]


def test_compat_collision_keeps_one_series_per_key(spark):
    batch = remote.normalise_requests(
        requests(spark, series("m", [("x", "ab"), ("y", "c")], [(1, 1.0)]),
                 series("m", [("x", "a"), ("y", "bc")], [(2, 2.0)])),
        key_mode="compat",
    )
    assert batch.series.count() == 1
    assert batch.points.select("series_key").distinct().count() == 1


def test_malformed_json_is_rejected(spark, tmp_path):
    good = {"timeseries": [{"labels": [{"name": "__name__", "value": "m"}],
                            "samples": [{"value": "NaN", "timestamp": 7}]}]}
    (tmp_path / "r.json").write_text(json.dumps(good) + '\n{"timeseries": []}\n{bad\n')
    batch = remote.normalise_requests(read_write_requests(spark, str(tmp_path)))
    assert points(batch) == [("m", 7, None)]
    assert rows(batch.rejected) == [("remote", "malformed_request", "{bad")]
    text = spark.createDataFrame([(json.dumps(good),), ("{bad",)], "body string")
    batch = remote.normalise_requests(parse_write_requests(text, "body"))
    assert points(batch) == [("m", 7, None)]
    assert batch.rejected.count() == 1


def test_parquet_requests(spark, root):
    requests(spark, series("m", [("a", "b")], [(1, 2.0)])).write.parquet(root)
    assert points(remote.normalise_requests(read_write_requests(spark, root, "parquet"))) == [("m", 1, 2.0)]


AGENT = {
    "metrics": [
        {"name": "Net-IO", "tags": {"Select": "v" * 60, "host": "h" * 59},
         "fields": {"n": 1, "f": 2.5, "e": 1e3, "s": "7", "t": True, "z": None, "o": {}},
         "timestamp": 1576464360000},
        {"name": "", "tags": {}, "fields": {"n": 1}, "timestamp": 5},
        {"name": "bare", "timestamp": 6},
    ]
}


def test_agent_fields_by_type(spark):
    batch = agent.normalise_batches(batches(spark, json.dumps(AGENT)))
    assert points(batch) == [
        ("__", 5, 1.0), ("net_io", 1576464360000, 1.0), ("net_io", 1576464360000, 1000.0),
        ("net_io", 1576464360000, 2.5),
    ]
    assert [r.value for r in batch.text_points.collect()] == ["7"]
    rejected = [json.loads(r.payload) for r in batch.rejected.collect()]
    assert sorted(r["field"] for r in rejected) == ["o", "t", "z"]
    labels = {r.labels["field"]: r.labels for r in batch.series.where("metric = 'net_io'").collect()}
    assert labels["n"] == {"_select": "v" * 59, "host": "h" * 59, "srcip": "10.0.0.1", "field": "n"}
    assert sorted(labels) == ["e", "f", "n", "s"]
    assert batch.series.where("kind = 'string'").first().labels["field"] == "s"


def test_agent_origin_tags_win(spark):
    metric = {"name": "m", "tags": {"field": "x", "SRCIP": "y", "a": "b"}, "fields": {"f": 1}, "timestamp": 1}
    batch = agent.normalise_batches(batches(spark, json.dumps({"metrics": [metric]})))
    assert batch.series.first().labels == {"a": "b", "srcip": "10.0.0.1", "field": "f"}


def test_absent_agent_tags_and_null_values(spark):
    make = lambda tags: json.dumps({"metrics": [{"name": "m", "tags": tags, "fields": {"f": 1}, "timestamp": 1}]})
    source = batches(spark, make({"a": None}), make({"a": ""}), make(None))
    series = agent.normalise_batches(source).series
    assert rows(series.select("labels")) == [
        ({"a": "", "srcip": "10.0.0.1", "field": "f"},), ({"srcip": "10.0.0.1", "field": "f"},)]


def test_agent_compat_key(spark):
    metric = {"name": "cpu", "tags": {"z": "b", "y": "a"}, "fields": {"idle": 1}, "timestamp": 1}
    batch = agent.normalise_batches(batches(spark, json.dumps({"metrics": [metric]})), key_mode="compat")
    expected = "MD5_" + hashlib.md5(b"cpuab10.0.0.1idle").hexdigest()
    assert batch.points.first().series_key == expected


def test_agent_exact_key_tells_swapped_values_apart(spark):
    make = lambda tags: json.dumps({"metrics": [{"name": "m", "tags": tags, "fields": {"f": 1}, "timestamp": 1}]})
    source = batches(spark, make({"a": "x", "b": "y"}), make({"a": "y", "b": "x"}))
    assert agent.normalise_batches(source).series.count() == 2
    assert agent.normalise_batches(source, "compat").series.count() == 1


def test_agent_files(spark, tmp_path):
    lines = [json.dumps({**AGENT, "srcip": "1.1.1.1"}), json.dumps({"fields": {"x": 1}, "name": "bare"}), "{bad"]
    (tmp_path / "a.json").write_text("\n".join(lines))
    batch = agent.normalise_batches(read_agent_batches(spark, str(tmp_path)))
    assert batch.points.count() == 4
    assert {r.labels["srcip"] for r in batch.series.collect()} == {"1.1.1.1"}
    assert batch.rejected.where("reason = 'malformed_batch'").count() == 1
    given = read_agent_batches(spark, str(tmp_path), srcip=F.lit("2.2.2.2"))
    assert {r.labels["srcip"] for r in agent.normalise_batches(given).series.collect()} == {"2.2.2.2"}


def test_agent_batch_groups(spark):
    metric = lambda name, t: {"name": name, "fields": {"a": 1, "b": 2}, "timestamp": t}
    payload = json.dumps({"metrics": [metric("m", 1000), metric("m", 2000), metric("m", 1000), metric("n", 0)]})
    groups = agent.batch_groups(agent.explode_metrics(batches(spark, payload, "{bad")))
    got = rows(groups.select(values.to_ms(F.col("ts")), "name", "metrics", "fields"))
    assert got == [(0, "n", 1, 2), (1000, "m", 2, 4), (2000, "m", 1, 2)]


PREFIX = "p0 p1 2021/01/01 20:40:2{} "


def pair(i, ms, value, series):
    return (
        PREFIX.format(i % 10) + f"server.go:201:  Ts: {ms}, value: {value},\n"
        + PREFIX.format(i % 10) + f"server.go:202: {series}\n"
    )


def test_log_pairs(spark, tmp_path):
    log = (
        "some header\n" + pair(0, 10, "37.000000", 'up{a="b", c="d,e"}') + pair(1, 11, "NaN", "down")
        + pair(2, 12, "1.000000", 'esc{q="x\\"y", e=""}')
        + PREFIX.format(3) + "server.go:201:  Ts: 13, value: 1.000000,\n"
    )
    (tmp_path / "metric.log").write_text(log)
    source = read_metric_log(spark, str(tmp_path))
    assert [r.log_time for r in source.collect()] == ["20:40:20", "20:40:21", "20:40:22", None]
    batch = remote.normalise_requests(source)
    assert points(batch) == [("down", 11, None), ("esc", 12, 1.0), ("up", 10, 37.0)]
    labels = {r.metric: r.labels for r in batch.series.collect()}
    assert labels["up"] == {"a": "b", "c": "d,e"}
    assert labels["esc"] == {"q": "x\\'y", "e": ""}
    assert rows(batch.rejected.select("reason")) == [("missing_name",)]


def test_log_pairs_survive_any_split(spark, tmp_path):
    (tmp_path / "metric.log").write_text("".join(pair(i, i, f"{i}.5", f'm{{i="{i}"}}') for i in range(300)))
    changed = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        source = read_metric_log(spark, str(tmp_path))
        assert source.rdd.getNumPartitions() > 100
        assert sorted(points(remote.normalise_requests(source))) == sorted(
            ("m", i, i + 0.5) for i in range(300)
        )
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
