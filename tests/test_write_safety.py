"""Writes that must not lose, double or misplace points."""

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from metricloom.config import IngestOptions
from metricloom.operators import reads
from metricloom.operators.matchers import Query
from metricloom.sources.agent import read_agent_batches
from metricloom.sources.lake import Lake, compact
from metricloom.sources.remote import read_write_requests
from metricloom.streaming.ingest import follow, ingest_batch, start_ingest
from build import requests, series

EVERY = Query.of(-(2**63), 2**63 - 1, ("RE", "__name__", ".*"))


def points(lake):
    return sorted((r["metric"], r["value"]) for r in reads.read_points(lake, EVERY).collect())


def test_jobs_that_run_once_append(spark, root):
    lake = Lake(spark, root)
    for value in (1.0, 2.0):
        ingest_batch(lake, requests(spark, series("up", [("job", "a")], [(1, value)])), stream="replay")
    assert points(lake) == [("up", 1.0), ("up", 2.0)]
    assert lake.series().count() == 1


def test_compaction_neither_doubles_points_nor_forgets_series(spark, root):
    lake, target = Lake(spark, root + "/old"), Lake(spark, root + "/new")
    long = series("up", [("job", "abcdef")], [(1, 1.0)])
    ingest_batch(lake, requests(spark, long), stream="a", options=IngestOptions(tag_bytes=3))
    ingest_batch(lake, requests(spark, long), stream="b")
    compat = IngestOptions(key_mode="compat")
    ingest_batch(lake, requests(spark, series("m", [("x", "ab"), ("y", "c")], [(1, 2.0)])), stream="c", options=compat)
    ingest_batch(lake, requests(spark, series("m", [("x", "a"), ("y", "bc")], [(1, 3.0)])), stream="d", options=compat)
    before = points(lake)
    compact(lake, target)
    assert points(target) == before and len(before) == 4
    ingest_batch(target, requests(spark, long), stream="b")
    assert target.series().count() == 4
    assert len(points(target)) == 5


def test_times_that_cannot_be_stored_are_rejected(spark, root):
    lake = Lake(spark, root)
    far = series("up", [("job", "a")], [(1, 1.0), (9223372036854775807, 2.0), (253402300800000, 3.0)])
    report = ingest_batch(lake, requests(spark, far))
    assert points(lake) == [("up", 1.0)]
    assert report["points"] == 1 and report["rejected"] == 1
    assert [r["reason"] for r in lake.rejected().collect()] == ["timestamp_range"]


def test_records_of_a_wrong_type_are_rejected_whole(spark, root, tmp_path):
    lake = Lake(spark, root)
    remote, agent = tmp_path / "remote", tmp_path / "agent"
    remote.mkdir()
    agent.mkdir()
    label = '{"name":"__name__","value":"up"}'
    (remote / "a.json").write_text(
        '{"timeseries":[{"labels":[%s],"samples":[{"value":1,"timestamp":"x"}]}]}\n' % label
        + '{"timeseries":[{"labels":[%s],"samples":[{"value":2,"timestamp":1}]}]}\n' % label
    )
    body = '{"metrics":[{"name":"cpu","tags":{},"fields":{"f":1},"timestamp":%s}]}\n'
    (agent / "a.json").write_text(body % '"abc"' + body % "5.5" + body % "7")
    ingest_batch(lake, read_write_requests(spark, str(remote)))
    ingest_batch(lake, read_agent_batches(spark, str(agent)), "agent", options=IngestOptions.for_agent())
    assert lake.points().where(F.col("ts") < F.lit("1970-01-01 00:00:00.001").cast("timestamp")).count() == 0
    assert lake.points().count() == 2
    assert sorted(r["reason"] for r in lake.rejected().collect()) == ["malformed_batch", "malformed_batch", "malformed_request"]


def test_two_jobs_at_once_keep_both_batches_and_register_once(spark, root):
    lake = Lake(spark, root)
    sources = [requests(spark, series("up", [("job", "a")], [(1 + i, float(i))])) for i in range(3)]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda rows: ingest_batch(lake, rows, stream="s"), sources))
    assert points(lake) == [("up", 0.0), ("up", 1.0), ("up", 2.0)]
    assert lake.series().count() == 1
    assert {r["batch_id"] for r in lake.points().select("batch_id").collect()} == {0, 1, 2}


def test_a_claimed_batch_is_its_owners(spark, root):
    lake = Lake(spark, root)
    lake.claim("s", 0, "me")
    lake.claim("s", 0, "me")
    with pytest.raises(ValueError, match="belongs"):
        lake.claim("s", 0, "you")
    lake.claim("s", 0)  # the caller answers for it
    assert lake.next_batch("s") == 1
    assert lake.next_batch("s") == 2


def test_a_dead_job_in_front_is_named_and_can_be_given_up(spark, root):
    lake = Lake(spark, root)
    dead = lake.next_batch("s")
    with pytest.raises(TimeoutError, match="batch 0"):
        lake.await_turn("s", dead + 1, patience=0)
    lake.abandon("s", dead)
    lake.await_turn("s", dead + 1, patience=0)
    ingest_batch(lake, requests(spark, series("up", [], [(1, 1.0)])), stream="s")
    assert points(lake) == [("up", 1.0)]


def test_nothing_staged_is_left_even_by_a_batch_that_fails(spark, root):
    lake = Lake(spark, root)
    good = requests(spark, series("up", [], [(1, 1.0)]))
    for _ in range(2):
        ingest_batch(lake, good, stream="s")
    broken = good.withColumn("timeseries", F.expr("if(size(timeseries) > 0, raise_error('no'), timeseries)"))
    with pytest.raises(Exception, match="no"):
        ingest_batch(lake, broken, stream="s")
    assert not list(Path(root).glob("_staging/stream=s/*"))


@pytest.mark.parametrize("stream", [None, "mine"])
def test_a_checkpoint_made_anew_at_the_same_path_overwrites_nothing(spark, root, tmp_path, stream):
    lake, inbox = Lake(spark, root), tmp_path / "in"
    inbox.mkdir()
    body = '{"timeseries":[{"labels":[{"name":"__name__","value":"up"}],"samples":[{"value":%d,"timestamp":1}]}]}\n'

    def run(checkpoint):
        start_ingest(lake, follow(spark, str(inbox)), str(checkpoint), stream=stream, trigger={"availableNow": True}).awaitTermination()

    (inbox / "a.json").write_text(body % 1)
    run(tmp_path / "cp")
    (tmp_path / "cp").rename(tmp_path / "old")
    (inbox / "a.json").rename(tmp_path / "a.json")
    (inbox / "b.json").write_text(body % 2)
    if stream:
        with pytest.raises(Exception, match="belongs"):
            run(tmp_path / "cp")
        assert points(lake) == [("up", 1.0)]
    else:
        run(tmp_path / "cp")
        assert points(lake) == [("up", 1.0), ("up", 2.0)]
    # The first checkpoint goes on where it was.
    (inbox / "c.json").write_text(body % 3)
    run(tmp_path / "old")
    assert ("up", 3.0) in points(lake) and ("up", 1.0) in points(lake)
