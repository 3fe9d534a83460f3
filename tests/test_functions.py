import hashlib
import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from build import many, one
from metricloom import fixed
from metricloom.functions import identity, labels as L, names, values

SETTINGS = settings(
    max_examples=4, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
TEXTS = st.lists(st.text(st.characters(codec="utf-8"), max_size=60), min_size=1, max_size=60)
PAIRS = L.PAIRS


def entries_of(spark, pairs):
    return one(spark, pairs, PAIRS, lambda c: L.entries(L.renamed(c)))


@pytest.mark.parametrize(
    "text, limit, cut",
    [
        ("aé漢x", 4, "aé"), ("aé漢x", 5, "aé"), ("aé漢x", 6, "aé漢"), ("aé漢x", 7, "aé漢x"),
        ("aé漢x", 2, "a"), ("😀😀", 7, "😀"), ("😀😀", 3, ""), ("abc", 3, "abc"), ("abc", 2, "ab"),
        ("a�b", 4, "a�"), ("", 5, ""),
    ],
)
def test_truncate_bytes(spark, text, limit, cut):
    assert one(spark, text, "string", lambda c: names.truncate_bytes(c, limit)) == cut


@SETTINGS
@given(TEXTS, st.integers(1, 40))
def test_truncate_is_longest_whole_prefix(spark, texts, limit):
    expected = [
        next(t[:n] for n in range(len(t), -1, -1) if len(t[:n].encode()) <= limit) for t in texts
    ]
    assert many(spark, texts, "string", lambda c: names.truncate_bytes(c, limit)) == expected


@pytest.mark.parametrize(
    "name, stored",
    [
        ("node:cpu.load-1m", "node_cpu_load_1m"), ("Up", "Up"), ("x" * 190, "x" * 190),
        ("x" * 191, "x" * 190), ("", ""),
    ],
)
def test_escape_metric(spark, name, stored):
    assert one(spark, name, "string", names.escape_metric) == stored


@pytest.mark.parametrize(
    "name, stored",
    [
        ("", "__"), ("9p", "_9p"), ("Select", "_select"), ("Net-IO", "net_io"), ("a.b:c", "a_b_c"),
        ("٣x", "_٣x"), ("selected", "selected"), ("WHERE", "_where"), ("_where", "_where"),
        ("y" * 200, "y" * 160), ("9" * 200, "_" + "9" * 159),
    ],
)
def test_escape_agent_table(spark, name, stored):
    assert one(spark, name, "string", names.escape_agent_table) == stored


def test_escape_agent_tags(spark):
    keys = ["", "9p", "Select", "Net-IO", "z" * 70, "host"]
    got = one(spark, keys, "array<string>", names.escape_agent_tags)
    assert got == ["__", "_9p", "_select", "net_io", "z" * 64, "host"]


def test_every_reserved_word_is_marked(spark):
    assert len(set(fixed.RESERVED_WORDS)) == 183
    words = list(fixed.RESERVED_WORDS)
    assert many(spark, words, "string", names.escape_agent_table) == ["_" + w for w in words]


def test_tag_columns():
    assert names.tag_column("job") == "t_job"
    assert names.tag_label("t_t_job") == "t_job"
    assert names.tag_label("job") == "job"


def test_labels_fold_and_last_value_wins(spark):
    got = entries_of(spark, [("Job", "a"), ("x", "1"), ("job", "b"), (None, None)])
    assert [tuple(p) for p in got] == [("", ""), ("job", "b"), ("x", "1")]


def test_names_sort_by_bytes_shorter_first(spark):
    got = entries_of(spark, [("ab", "1"), ("a", "2"), ("b", "3"), ("a_", "4"), ("a1", "5")])
    assert [p["name"] for p in got] == ["a", "a1", "a_", "ab", "b"]


def test_metric_name(spark):
    name = lambda pairs: one(spark, pairs, PAIRS, L.metric_name)
    assert name([("a", "b"), ("__name__", "up")]) == "up"
    assert name([("a", "b")]) is None
    assert name([]) is None
    assert name(None) is None


def test_quotes_and_length_of_stored_values(spark):
    stored = lambda pairs, **k: one(
        spark, pairs, PAIRS,
        lambda c: L.stored_entries(L.renamed(c), L.entries(L.renamed(c)), **k),
    )
    assert stored([("a", 'x"y')])[0]["value"] == "x'y"
    assert stored([("a", "v" * 128)])[0]["value"] == "v" * 128
    assert stored([("a", "v" * 129)])[0]["value"] == "v" * 128
    assert stored([("a", 'ab"')], tag_bytes=2)[0]["value"] == "ab"


def test_cap_keeps_first_labels_in_arrival_order(spark):
    pairs = [("z", "1"), ("A", "2"), ("m", "3"), ("a", "4")]
    got = one(
        spark, pairs, PAIRS,
        lambda c: L.stored_entries(L.renamed(c), L.entries(L.renamed(c)), tag_limit=2),
    )
    assert [tuple(p) for p in got] == [("a", "4"), ("z", "1")]


@pytest.mark.parametrize(
    "value, stored",
    [(1.5, 1.5), (math.nan, None), (math.inf, None), (-math.inf, None), (-0.5, -0.5), (None, None),
     (1.7976931348623157e308, 1.7976931348623157e308)],
)
def test_finite_or_null(spark, value, stored):
    assert one(spark, value, "double", values.finite_or_null) == stored


def test_timestamps(spark):
    text = lambda c: F.date_format(values.to_ts(c), "yyyy-MM-dd'T'HH:mm:ss.SSS")
    assert one(spark, 1619870400000, "bigint", text) == "2021-05-01T12:00:00.000"
    assert one(spark, None, "bigint", text) == "1970-01-01T00:00:00.000"
    back = lambda c: values.to_ms(values.to_ts(c))
    assert many(spark, [-1, 0, 1576466279341], "bigint", back) == [-1, 0, 1576466279341]
    cut = lambda c: values.to_ms(F.timestamp_micros(c))
    assert one(spark, 1500, "bigint", cut) == 1


@pytest.mark.parametrize(
    "json, kind",
    [("1", "double"), ("2.5", "double"), ("1e3", "double"), ('"7"', "string"), ("true", None),
     ("null", None), ("{}", None), ("[1]", None), ("123456789012345678901234567890", "double")],
)
def test_field_kind(spark, json, kind):
    assert one(spark, json, "string", lambda c: values.field_kind(F.parse_json(c))) == kind


def keys(spark, pairs, mode, metric="m"):
    def key(c):
        renamed = L.renamed(L.tag_pairs(c))
        return identity.series_key(F.lit(metric), c, L.entries(renamed), mode)

    return one(spark, pairs, PAIRS, key)


def test_compat_key_is_the_hash_of_bare_values(spark):
    expected = "MD5_" + hashlib.md5(b"mabc").hexdigest()
    name = ("__name__", "m")
    assert keys(spark, [name, ("x", "ab"), ("y", "c")], "compat") == expected
    assert keys(spark, [name, ("x", "a"), ("y", "bc")], "compat") == expected


def test_compat_key_takes_the_name_where_it_stands(spark):
    expected = "MD5_" + hashlib.md5(b"xup").hexdigest()
    assert keys(spark, [("App", "x"), ("__name__", "up")], "compat", metric="up") == expected


def test_exact_key_tells_sets_apart_and_ignores_order(spark):
    a = keys(spark, [("x", "ab"), ("y", "c")], "exact")
    assert a != keys(spark, [("x", "a"), ("y", "bc")], "exact")
    assert a != keys(spark, [("x", "c"), ("y", "ab")], "exact")
    assert a != keys(spark, [("x", "ab"), ("y", "c")], "exact", metric="n")
    assert a == keys(spark, [("y", "c"), ("X", "ab")], "exact")
    long = "v" * 200
    assert keys(spark, [("x", long + "1")], "exact") != keys(spark, [("x", long + "2")], "exact")


@SETTINGS
@given(st.lists(st.dictionaries(st.sampled_from(["a", "b", 'c"', "d,"]),
                                st.text(st.sampled_from('ab",:{}\\'), max_size=4), max_size=3),
                min_size=2, max_size=60))
def test_exact_key_is_injective(spark, sets):
    def key(c):
        renamed = L.renamed(c)
        return identity.series_key(F.lit("m"), c, L.entries(renamed))

    got = many(spark, [list(s.items()) for s in sets], PAIRS, key)
    distinct = {tuple(sorted(s.items())) for s in sets}
    assert len(set(got)) == len(distinct)


def test_tag_hash(spark):
    def hashed(pairs, **k):
        return one(spark, pairs, PAIRS,
                   lambda c: identity.tag_hash(L.renamed(c), L.entries(L.renamed(c)), **k))

    assert hashed([("b", 'x"'), ("A", "1")]) == hashlib.md5(b'1x"').hexdigest()
    assert hashed([]) == hashlib.md5(b"").hexdigest()
    assert hashed([("a", "xyz")], tag_bytes=2) == hashlib.md5(b"xy").hexdigest()
    over = [("a", "xyz"), ("b", "xyz")]
    assert hashed(over, tag_bytes=2, tag_limit=1) == hashlib.md5(b"xyxyz").hexdigest()


def test_unknown_modes_are_refused():
    with pytest.raises(ValueError):
        identity.series_key(F.lit(""), F.lit(""), F.lit(""), "other")
