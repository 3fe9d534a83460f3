"""Compare a registered query with its SQL, as sets of rows with multiplicity."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value.replace(tzinfo=None) if hasattr(value, "tzinfo") else value


def counted(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, query, sql: str, sf_dir: str) -> tuple[Counter, Counter, list, list]:
    df = query(spark, sf_dir)
    ours = counted(df.columns, df.collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = counted(columns, result.fetchall())
    return ours - theirs, theirs - ours, sorted(df.columns), sorted(columns)
