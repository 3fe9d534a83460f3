import io
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as entry
from metricloom.plans import normalising, reading, requests, revisions, upkeep
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
NAMES = sorted({**normalising.QUERIES, **reading.QUERIES, **requests.QUERIES, **revisions.QUERIES, **upkeep.QUERIES})


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_agrees_with_its_sql(spark, con, name):
    ours, theirs, columns, sql_columns = compare(
        spark, con, entry.queries()[name], entry.oracle_sql()[name], SF
    )
    assert columns == sql_columns
    assert not ours and not theirs


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("extended")
    return out.getvalue()


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join(spark, name):
    if any(word in name for word in ("stream", "log", "compact")):
        pytest.skip("the returned plan only reads what the job wrote")
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["metric", "user", "zone", "tier", "ms", "value"]
    assert df.count() > 0


def scan_of_points(df):
    text = plan(df).split("== Physical Plan ==")[1]
    return next(line for line in text.split("\n") if "FileScan" in line and "period" in line)


def test_reads_prune_partitions_and_push_the_range(spark):
    scan = scan_of_points(entry.queries()["read_select"](spark, SF))
    filters = scan.split("PartitionFilters: ")[1]
    assert "RLIKE(metric" in scan and "isnotnull(period" in filters
    assert "GreaterThanOrEqual(ts" in scan
    assert "series_key:string,ts:timestamp,value:double>" in scan.split("ReadSchema")[1]


def test_label_matchers_never_touch_the_points_scan(spark):
    scan = scan_of_points(entry.queries()["read_label_re"](spark, SF))
    assert "labels" not in scan
