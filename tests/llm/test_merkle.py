"""Trees, proofs and tampering against a plain recursion."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from metricloom.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, add=0):
    doc_id, text, lang, source, n_chars = row
    values = (doc_id, source, lang, None if n_chars is None else n_chars + add, text)
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def brute(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))):
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([leaf(r) for r in groups[g]]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for at, group in enumerate(order):
        for i, row in enumerate(groups[group]):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node, siblings = leaf(row, 1 if hit else 0), []
            for tree, j in ((trees[group], i), (top, at)):
                for level in tree[:-1]:
                    k = j ^ 1
                    if k < len(level):
                        siblings.append(level[k])
                        node = H(level[k], node) if k < j else H(node, level[k])
                    else:
                        node = H(node)
                    j //= 2
            out.append((row[0], leaf(row), trees[group][-1][0], top[-1][0], H(*siblings), node, node == top[-1][0]))
    return sorted(out, key=repr)


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, grp string, rank long, path string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], COLUMNS)


def made(n, lang, start=0):
    return [(start + i, f"text {i} é", lang, f"s{i % 3}", 9 + i) for i in range(n)]


CASES = {
    "one": made(1, "en"),
    "sizes": [r for k, n in enumerate((1, 2, 3, 5, 8, 64, 65, 129, 200)) for r in made(n, f"l{k}", 1000 * k)],
    "edges": [
        (None, None, None, None, None), (None, "", "en", "s", 0), (3, "x" * 300_000, "en", "s", 300_000), (3, "other", "en", "s", 5),
        (4, "same", "en", "s", 4), (4, "same", "en", "s", 4), (-7, "a:b", "é", "-", 2**63 - 1), (26, "t", "z", None, None), *made(40, None, 50),
    ],
}


@pytest.mark.parametrize("case", CASES)
def test_same_as_a_plain_recursion(spark, case):
    got = merkle.audited(table(spark, CASES[case])).collect()
    assert sorted(map(tuple, got), key=repr) == brute(CASES[case])


def test_a_hot_group_and_many_bands(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BAND", 2)
    rows = made(150, "en") + made(3, "de", 500)
    assert sorted(map(tuple, merkle.audited(table(spark, rows)).collect()), key=repr) == brute(rows)


def test_nodes_are_nested_intervals(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BAND", 2)
    leaves = spark.range(23).select(F.lit("g").alias("grp"), F.col("id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    nodes = merkle.grown(leaves).nodes.collect()
    by_level = {}
    for n in nodes:
        by_level.setdefault(n.level, []).append((n.lo, n.hi, n.digest))
    want = levels([H(str(i)) for i in range(23)])
    assert len(by_level) == len(want) and len(nodes) == sum(map(len, want))
    for level, found in by_level.items():
        assert [d for _, _, d in sorted(found)] == want[level]
        assert [(lo, hi) for lo, hi, _ in sorted(found)] == [(i << level, min((i + 1) << level, 23)) for i in range(len(found))]


def test_an_empty_table_has_no_rows(spark):
    assert merkle.audited(table(spark, made(1, "en")).limit(0)).collect() == []
