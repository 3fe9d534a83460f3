import json

import pytest

from metricloom.__main__ import main


def read(spark, path):
    return [json.loads(r.value) for r in spark.read.text(path).collect()]


def test_jobs(spark, root, tmp_path):
    before = spark.catalog.currentDatabase()
    (tmp_path / "in").mkdir()
    (tmp_path / "log").mkdir()
    sample = {"timeseries": [{"labels": [{"name": "__name__", "value": "up"}, {"name": "Job", "value": "abcdef"}],
                              "samples": [{"value": 1.0, "timestamp": 10}, {"value": 2.0, "timestamp": 20}]}]}
    (tmp_path / "in" / "a.json").write_text(json.dumps(sample))
    (tmp_path / "log" / "a.log").write_text(
        "p0 p1 d 20:40:20 server.go:201:  Ts: 30, value: 3.000000,\np0 p1 d 20:40:20 server.go:202: up{job=\"x\"}\n")
    query = {"query_id": 4, "start_ms": 0, "end_ms": 40,
             "matchers": [{"type": "EQ", "name": "__name__", "value": "up"}]}
    (tmp_path / "q.json").write_text(json.dumps(query))
    lake = f"{root}/lake"
    try:
        main(["ingest", "remote", str(tmp_path / "in"), lake, f"{root}/cp", "--once", "--tag-length", "3", "--first-only"])
        assert spark.catalog.currentDatabase() == "prometheus"
    finally:
        spark.catalog.setCurrentDatabase(before)
    main(["replay", str(tmp_path / "log"), lake])
    main(["read", str(tmp_path / "q.json"), lake, f"{root}/answer", "--merge"])
    answer = sorted(read(spark, f"{root}/answer"), key=lambda s: s["samples"][0]["timestamp"])
    assert [(s["labels"][1]["value"], s["samples"]) for s in answer] == [
        ("abc", [{"value": 1.0, "timestamp": 10}]), ("x", [{"value": 3.0, "timestamp": 30}])]
    main(["compact", lake, f"{root}/new"])
    main(["list", f"{root}/new", f"{root}/list"])
    assert [(m["name"], m["tables"], m["tags"]) for m in read(spark, f"{root}/list")] == [("up", 2, 2)]
    main(["describe", f"{root}/new", f"{root}/up", "up"])
    assert sorted(f["field"] for f in read(spark, f"{root}/up")) == ["t_job", "taghash", "ts", "value"]


def test_bad_arguments():
    with pytest.raises(SystemExit):
        main(["ingest", "carbon", "a", "b", "c"])
