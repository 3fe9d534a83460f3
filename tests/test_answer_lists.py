"""Answers meet the lists of their queries, not one query after another."""

import build
from metricloom.operators import bulk
from metricloom.sources.lake import Lake
from metricloom.sources.remote import QUERY_SCHEMA
from metricloom.streaming.ingest import ingest_batch
from pyspark.sql import functions as F

FIRST = 1_704_067_200_000


def test_a_point_meets_few_lists_and_every_query_gets_it_once(spark, root, monkeypatch):
    monkeypatch.setattr(bulk, "LIST_IDS", 8)
    lake = Lake(spark, root)
    ingest_batch(lake, build.requests(spark, build.series("up", [("zone", "z1")], [(FIRST + i, float(i)) for i in range(3)])))
    # A popular read, a rare one and one that finds nothing.
    asked = [(i, FIRST, FIRST + 1, [("EQ", "__name__", "up")]) for i in range(200)]
    asked += [(900, FIRST, FIRST + 2, [("EQ", "__name__", "up")]), (901, FIRST, FIRST, [("EQ", "__name__", "down")])]
    answers = bulk.read_requests_answers(lake, spark.createDataFrame(asked, QUERY_SCHEMA))
    lists = [(r["answer"], r["query_ids"]) for r in answers.lists().collect()]
    assert sorted(q for _, ids in lists for q in ids) == [*range(200), 900, 901]
    assert {a for a, ids in lists if set(ids) <= set(range(200))} == {0}
    assert 10 < sum(a == 0 for a, _ in lists) <= 25 and max(len(ids) for _, ids in lists) < 30
    got = build.rows(answers.to_each(answers.points).select("query_id", F.unix_millis("ts"), "value"))
    want = [(i, FIRST + j, float(j)) for i in range(200) for j in range(2)] + [(900, FIRST + j, float(j)) for j in range(3)]
    assert got == sorted(want, key=repr)
