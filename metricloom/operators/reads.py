"""Reads: select points by matchers and time range, and group them to series."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame, Window, functions as F

from metricloom import fixed
from metricloom.functions import labels as L, values
from metricloom.operators.matchers import (
    Matcher,
    Options,
    Query,
    matcher_predicate,
)
from metricloom.session import work_dir
from metricloom.sources.lake import Lake, in_period, latest

# Time a row of a series covers; callers with denser series give less.
FRAME_MS = 86_400_000

# Samples in a chunk of a series.
CHUNK_ROWS = 10_000

SERIES_KEYS = ["stream", "metric", "series_key"]


def with_tags(points: DataFrame, series: DataFrame) -> DataFrame:
    """Each point with the columns of its series.

    A series is registered once in the stream that carries its points, so the
    stream is part of the join key. No side is forced: Spark broadcasts the
    series when they are small, else shuffles both and splits hot keys.
    """
    return points.join(series, SERIES_KEYS)


def numeric_series(lake: Lake) -> DataFrame:
    return lake.series().where(F.col("kind") == values.NUMBER)


def _instant(ms: int) -> Column:
    # An open end comes as the smallest or largest integer; no timestamp does.
    return F.timestamp_millis(F.lit(min(max(ms, values.MIN_MS), values.MAX_MS)))


def _any(conditions: Sequence[Column]) -> Column:
    """Their disjunction as a balanced tree: its depth is a logarithm of their number."""
    if len(conditions) == 1:
        return conditions[0]
    half = len(conditions) // 2
    return _any(conditions[:half]) | _any(conditions[half:])


def _range(start_ms: int, end_ms: int) -> Column:
    lo, hi = _instant(start_ms), _instant(end_ms)
    return F.col("ts").between(lo, hi) & in_period(lo, hi)


def read_points(lake: Lake, query: Query, options: Options = Options()) -> DataFrame:
    """Points that a query selects: ``metric, series_key, labels, ts, value``."""
    wanted = matcher_predicate(lake.spark, query.matchers, options)
    series = numeric_series(lake).where(wanted.metric & wanted.labels)
    points = lake.points().where(wanted.metric & _range(query.start_ms, query.end_ms))
    return with_tags(
        points.select(*SERIES_KEYS, "ts", "value"),
        series.select(*SERIES_KEYS, "labels"),
    ).drop("stream")


def read_latest(lake: Lake, query: Query, options: Options = Options()) -> DataFrame:
    """``read_points``, but a series has one point for each time: the latest batch's.

    Points whose series no label matcher selects are dropped before they are
    compared.
    """
    wanted = matcher_predicate(lake.spark, query.matchers, options)
    series = numeric_series(lake).where(wanted.metric & wanted.labels).select(*SERIES_KEYS, "labels")
    points = lake.points().where(wanted.metric & _range(query.start_ms, query.end_ms))
    if any(m.name != fixed.NAME_LABEL for m in query.matchers):
        points = points.join(series.select(*SERIES_KEYS), SERIES_KEYS, "left_semi")
    return with_tags(latest(points).drop("batch_id"), series).drop("stream")


def read_many(
    lake: Lake,
    queries: Sequence[Query],
    options: Options = Options(),
    merge_queries: bool = False,
) -> DataFrame:
    """Points of several queries in one scan, with the ``query_id`` of each.

    Every query's matchers are tried on the series, which are few; each series
    carries the list of queries it answers. Points then need one equi-join, and
    a point is repeated only for the queries whose range holds it. With
    ``merge_queries`` the id is dropped and repeats stay.
    """
    if not queries:
        raise ValueError("no queries")
    wanted = [matcher_predicate(lake.spark, q.matchers, options) for q in queries]
    hits = F.array_compact(
        F.array(
            *[
                F.when(
                    w.metric & w.labels,
                    F.struct(
                        F.lit(i if q.query_id is None else q.query_id).alias("query_id"),
                        _instant(q.start_ms).alias("lo"),
                        _instant(q.end_ms).alias("hi"),
                    ),
                )
                for i, (w, q) in enumerate(zip(wanted, queries))
            ]
        )
    )
    any_metric = _any([w.metric for w in wanted])
    series = (
        numeric_series(lake)
        .where(any_metric)
        .select(*SERIES_KEYS, "labels", hits.alias("hits"))
        .where(F.size("hits") > 0)
    )
    span = _range(min(q.start_ms for q in queries), max(q.end_ms for q in queries))
    points = lake.points().where(any_metric & span)
    found = (
        with_tags(points.select(*SERIES_KEYS, "ts", "value"), series)
        .select("metric", "series_key", "labels", "ts", "value", F.explode("hits").alias("hit"))
        .where("ts between hit.lo and hit.hi")
    )
    columns = ["metric", "series_key", "labels", "ts", "value"]
    if merge_queries:
        return found.select(*columns)
    return found.select(F.col("hit.query_id").alias("query_id"), *columns)


def queries_of(requests: DataFrame) -> list[Query]:
    """Queries of ``sources.remote.read_requests`` rows, in ``query_id`` order.

    A read request is the text of a read, so its queries become part of the
    plan, which grows with their number.
    """
    rows = requests.orderBy("query_id").collect()
    return [
        Query(
            row["start_ms"],
            row["end_ms"],
            tuple(Matcher(m["type"], m["name"], m["value"]) for m in row["matchers"]),
            row["query_id"],
        )
        for row in rows
    ]


def label_set(points: DataFrame) -> DataFrame:
    """``points`` with ``labels`` as the pairs a read answers, the name first."""
    return points.withColumn("labels", L.to_label_pairs(F.col("metric"), F.col("labels")))


def series_frames(
    points: DataFrame, by: Sequence[str] = (), frame_ms: int = FRAME_MS
) -> DataFrame:
    """Points grouped to series rows, samples in time order.

    A series is a stored label set: keys that differ before labels are cut or
    cleaned, and not after, are one series. Each row is a *frame*, the samples
    of one series from ``frame_start`` for ``frame_ms``; frames start at
    multiples of ``frame_ms`` since 1970. So rows are the same at any size and
    under any partitioning, and frames in order of ``frame_start`` are the
    series in time order. Samples of equal time are ordered by value, nulls
    first. ``by`` adds grouping columns such as ``query_id``.
    """
    if frame_ms < 1:
        raise ValueError("a frame covers one millisecond or more")
    ms = F.unix_millis("ts")
    keys = [*by, "labels", "frame_start"]
    framed = label_set(points).withColumn("frame_start", F.timestamp_millis(ms - F.pmod(ms, F.lit(frame_ms))))
    return (
        framed.groupBy(*keys)
        .agg(
            F.min("metric").alias("metric"),
            F.array_sort(F.collect_list(F.struct("ts", "value"))).alias("samples"),
        )
        .select(
            *by,
            "metric",
            "labels",
            "frame_start",
            F.element_at("samples", 1)["ts"].alias("first_ts"),
            F.element_at("samples", -1)["ts"].alias("last_ts"),
            "samples",
        )
    )


def series_chunks(
    points: DataFrame, by: Sequence[str] = (), chunk_rows: int = CHUNK_ROWS, work: str | None = None
) -> DataFrame:
    """Points grouped to series rows of ``chunk_rows`` samples each, in time order.

    For series so dense that a frame of any length may be too much for a row.
    Samples of a series are ordered by time, then value, nulls first, and cut
    every ``chunk_rows``; ``chunk`` counts from 0, and a series' last chunk may
    be shorter. Rows are the same under every partitioning.

    The sorted points are dealt out by ranges of series, time and value, so a
    series of any length lies in many tasks, and written under ``work`` (a new
    folder by default, the caller's to remove). Only counts, a row for each
    series in each task, are added up to give the samples their places.
    """
    if chunk_rows < 1:
        raise ValueError("a chunk holds one sample or more")
    keys = [*by, "labels"]
    order = [*keys, "ts", "value"]
    path = work or work_dir(points.sparkSession, "chunks")
    (
        label_set(points).select(*order, "metric").repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)
    )
    # The upper bits of a place are its task, whose order is the ranges'.
    placed = points.sparkSession.read.parquet(path).withColumn("task", F.shiftright("place", 33))
    before = Window.partitionBy(*keys).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        placed.groupBy(*keys, "task").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
        .withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first"))
    )
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (*keys, "task")]
    numbered = placed.alias("p").join(runs.alias("r"), same).select(
        "p.*", F.floor((F.col("place") + F.col("shift")) / chunk_rows).alias("chunk")
    )
    return (
        numbered.groupBy(*keys, "chunk")
        .agg(F.min("metric").alias("metric"), F.array_sort(F.collect_list(F.struct("ts", "value"))).alias("samples"))
        .select(
            *by, "metric", "labels", "chunk", F.element_at("samples", 1)["ts"].alias("first_ts"),
            F.element_at("samples", -1)["ts"].alias("last_ts"), "samples",
        )
    )


def read_series(
    lake: Lake, query: Query, options: Options = Options(), frame_ms: int = FRAME_MS
) -> DataFrame:
    """Series rows that a query selects, one for each frame."""
    return series_frames(read_points(lake, query, options), frame_ms=frame_ms)


def series_count(points: DataFrame) -> DataFrame:
    """Number of series, that is of stored label sets, among ``points``."""
    return label_set(points).select("labels").distinct().agg(F.count(F.lit(1)).alias("series"))


def write_series(frames: DataFrame, path: str, fmt: str = "json") -> None:
    """Write series rows as a read answers them: labels, frame start and samples in ms."""
    sample = F.transform(
        "samples",
        lambda s: F.struct(
            s["value"].alias("value"), values.to_ms(s["ts"]).alias("timestamp")
        ),
    )
    by = [c for c in ("query_id", "answer") if c in frames.columns]
    start = values.to_ms(F.col("frame_start")).alias("frame_start")
    frames.select(*by, "labels", start, sample.alias("samples")).write.mode(
        "overwrite"
    ).format(fmt).save(path)
