import re

import pytest

from build import requests, rows, series
from metricloom.functions.dialect import checked_regex
from metricloom.operators import reads
from metricloom.operators.matchers import Options, Query, matcher_predicate
from metricloom.sources.lake import Lake
from metricloom.streaming.ingest import ingest_batch


@pytest.fixture(scope="module")
def lake(spark):
    from metricloom.session import work_dir

    lake = Lake(spark, work_dir(spark, "matchers"))
    ingest_batch(
        lake,
        requests(
            spark,
            series("m", [("k", "x"), ("id", "value")], [(1000, 1.0), (2000, 2.0)]),
            series("m", [("k", ""), ("id", "empty")], [(1000, 1.0)]),
            series("m", [("id", "missing")], [(1000, 1.0)]),
            series("a:b", [("id", "abc")], [(1000, 1.0)]),
        ),
    )
    return lake


def ids(lake, *matchers, span=(0, 10_000), **options):
    found = reads.read_points(lake, Query.of(*span, *matchers), Options(**options))
    return sorted({r.labels["id"] for r in found.collect()})


NAME = ("EQ", "__name__", "m")


@pytest.mark.parametrize(
    "matcher, promql, kept",
    [
        (("EQ", "k", "x"), False, ["value"]),
        (("EQ", "k", ""), False, ["empty", "missing"]),
        (("NEQ", "k", "x"), False, ["empty"]),
        (("NEQ", "k", "x"), True, ["empty", "missing"]),
        (("NEQ", "k", ""), False, ["value"]),
        (("NEQ", "k", ""), True, ["value"]),
        (("RE", "k", "x"), False, ["value"]),
        (("RE", "k", ".*"), False, ["empty", "missing", "value"]),
        (("NRE", "k", "x"), False, ["empty", "missing"]),
        (("EQ", "K", "x"), False, ["value"]),
    ],
)
def test_grid(lake, matcher, promql, kept):
    assert ids(lake, NAME, matcher, promql=promql) == kept


def test_all_matchers_of_a_label_apply(lake):
    assert ids(lake, NAME, ("RE", "id", "e"), ("NRE", "id", "^m"), ("NEQ", "id", "value")) == ["empty"]


def test_names(lake):
    assert ids(lake, ("EQ", "__name__", "a:b")) == ["abc"]
    assert ids(lake, ("EQ", "__name__", "a_b")) == ["abc"]
    assert ids(lake, ("NEQ", "__name__", "a:b")) == ["empty", "missing", "value"]
    assert ids(lake, ("RE", "__name__", "_")) == ["abc"]
    assert ids(lake, ("NRE", "__name__", "_")) == ["empty", "missing", "value"]
    assert ids(lake, NAME, ("EQ", "__name__", "a_b")) == ["abc"], "the last name matcher counts"


def test_regex_is_unanchored_unless_asked(lake):
    assert ids(lake, ("RE", "__name__", "."), ("RE", "id", "b")) == ["abc"]
    assert ids(lake, ("RE", "__name__", ".*"), ("RE", "id", "b"), anchored=True) == []
    assert ids(lake, ("RE", "__name__", ".*"), ("RE", "id", "b|abc"), anchored=True) == ["abc"]


def test_range_ends_are_inclusive(lake):
    at = lambda lo, hi: rows(reads.read_points(lake, Query.of(lo, hi, NAME, ("EQ", "k", "x"))).select("value"))
    assert at(1000, 2000) == [(1.0,), (2.0,)]
    assert at(1001, 2000) == [(2.0,)]
    assert at(1000, 1999) == [(1.0,)]
    assert at(2001, 3000) == []
    assert at(-(2**62), 2**62) == [(1.0,), (2.0,)]


@pytest.mark.parametrize(
    "matchers",
    [
        [("EQ", "k", "x")], [("EQ", "__name__", "")], [("RE", "__name__", "")],
        [("RE", "__name__", "(")], [NAME, ("RE", "k", "(")], [NAME, ("LIKE", "k", "x")],
        [NAME, ("RE", "k", "(?=x)")], [NAME, ("NRE", "k", "a++")],
    ],
)
def test_unfit_matchers(spark, matchers):
    with pytest.raises(ValueError):
        matcher_predicate(spark, Query.of(0, 1, *matchers).matchers)


@pytest.mark.parametrize(
    "pattern", ["(?=a)", "(?!a)", "(?<=a)", "(?<!a)", "(?>a)", r"(a)\1", r"\k<n>", "a*+", "a?+", "a{2}+",
                "(", "[", "*", "[[:nope:]]"],
)
def test_dialect_refuses(spark, pattern):
    with pytest.raises(ValueError):
        checked_regex(spark, pattern)


def test_dialect_agrees_with_a_plain_engine(spark):
    from pyspark.sql import functions as F

    texts = ["abc", "a\n", "a", "b.c", "a{,3}", "x-1", "", "A", "ab\n", "[b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for pattern in ["a$", "^a", "b.c", "[a-c]{2}", "^$", "a\\z", "(?i)a$", "x-\\d", "[[]b", "^.$"]:
        java = checked_regex(spark, pattern)
        got = {r.t for r in df.where(F.col("t").rlike(java)).collect()}
        as_python = re.sub(r"(?<!\\)\$", r"\\Z", pattern).replace("\\z", "\\Z")
        assert got == {t for t in texts if re.search(as_python, t)}, pattern
