"""Registered queries of points sent again, merged catalogues and chunked series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from metricloom.functions import values
from metricloom.operators import catalog, reads
from metricloom.operators.matchers import Query
from metricloom.plans import tables as T
from metricloom.plans.reading import ALL, ANY_NAME, RANGE
from metricloom.session import work_dir
from metricloom.sources.lake import Lake, compact
from metricloom.streaming.ingest import ingest_batch

CHUNK_ROWS = 5
SELECT = (("RE", "__name__", "click|view"), ("NRE", "zone", "[45]"))

_lakes: dict[tuple[str, str, str], Lake] = {}


def _batches(events: DataFrame) -> list[tuple[str, int, DataFrame, Column]]:
    """Stream, batch, events and values: every event again in batch 1, some in others too."""
    value = F.col("value")
    return [
        ("main", 0, events.where("event_id % 3 = 0"), value),
        ("main", 1, events, value * 2),
        ("main", 2, events.where("event_id % 2 = 0"), value + 1),
        ("main", 1, events, value * 2),
        ("other", 0, events.where("user_id % 2 = 0"), value),
    ]


def revised(spark: SparkSession, sf_dir: str) -> Lake:
    """Lake of events that later batches send again with other values, one batch replayed."""
    key = (spark.sparkContext.applicationId, sf_dir, "revised")
    if key not in _lakes:
        lake = Lake(spark, work_dir(spark, "revised-lake"), grain="month")
        created = F.lit(T.CREATED_AT).cast("timestamp")
        for stream, batch_id, rows, value in _batches(T.with_labels(T.table(spark, sf_dir, "events"))):
            sent = T.as_requests(rows, T.sample(value, F.col("ms")))
            ingest_batch(lake, sent, batch_id=batch_id, stream=stream, created_at=created)
        _lakes[key] = lake
    return _lakes[key]


def _flat(points: DataFrame) -> DataFrame:
    return points.select(
        "metric", T.tag("user"), T.tag("zone"), T.tag("tier"), values.to_ms(F.col("ts")).alias("ms"), "value")


def read_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest value of each series and time of a selection."""
    return _flat(reads.read_latest(revised(spark, sf_dir), Query.of(*RANGE, *SELECT)))


def compact_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All points of the lake compacted to the latest of each series and time."""
    key = (spark.sparkContext.applicationId, sf_dir, "compacted")
    if key not in _lakes:
        target = Lake(spark, work_dir(spark, "latest-lake"), grain="month")
        compact(revised(spark, sf_dir), target, latest_only=True)
        _lakes[key] = target
    return _flat(reads.read_points(_lakes[key], Query.of(*ALL, ANY_NAME)))


def list_metrics_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric list merged from what each batch added."""
    return catalog.merged_metrics(revised(spark, sf_dir))


def tag_schema_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tag lists merged from what each batch added."""
    return catalog.merged_tag_schema(revised(spark, sf_dir))


def read_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every series in chunks, with the samples' places in them."""
    points = reads.read_points(T.lake_of(spark, sf_dir), Query.of(*ALL, ANY_NAME))
    chunks = reads.series_chunks(points, chunk_rows=CHUNK_ROWS)
    return chunks.select(
        T.entry_text(F.col("labels")).alias("labels"), "chunk", F.posexplode("samples").alias("position", "s"),
    ).select(
        "labels", "chunk", F.col("position").cast("long").alias("position"),
        values.to_ms(F.col("s.ts")).alias("ms"), F.col("s.value").alias("value"),
    )


QUERIES = {
    "read_latest": read_latest,
    "compact_latest": compact_latest,
    "list_metrics_incremental": list_metrics_incremental,
    "tag_schema_incremental": tag_schema_incremental,
    "read_chunks": read_chunks,
}

_E = "WITH " + T.EVENTS_SQL
_LATEST = f"""{_E},
    u AS (SELECT event_id, user_id FROM events),
    b AS (SELECT 'main' AS stream, 0 AS batch, * FROM e WHERE event_id % 3 = 0
          UNION ALL SELECT 'main', 1, * REPLACE (value * 2 AS value) FROM e
          UNION ALL SELECT 'main', 2, * REPLACE (value + 1 AS value) FROM e WHERE event_id % 2 = 0
          UNION ALL SELECT 'other', 0, * FROM e WHERE event_id IN (SELECT event_id FROM u WHERE user_id % 2 = 0)),
    p AS (SELECT * FROM b QUALIFY row_number() OVER (
              PARTITION BY stream, metric, "user", zone, tier, ms ORDER BY batch DESC, value DESC NULLS LAST) = 1)
    SELECT metric, "user", zone, tier, ms, value FROM p"""
_LABELS = "'__name__=' || metric || coalesce(',tier=' || tier, '') || ',user=' || \"user\" || ',zone=' || zone"

ORACLES = {
    "read_latest": f"""{_LATEST}
        WHERE regexp_matches(metric, 'click|view') AND NOT regexp_matches(zone, '[45]')
          AND ms BETWEEN {RANGE[0]} AND {RANGE[1]}""",
    "compact_latest": _LATEST,
    "list_metrics_incremental": f"""{_E}
        SELECT metric AS name, TIMESTAMP '{T.CREATED_AT}' AS created_time, 2 AS columns,
               CAST(1 + max(CASE WHEN tier IS NULL THEN 2 ELSE 3 END) AS BIGINT) AS tags,
               count(DISTINCT {_LABELS}) AS tables
        FROM e GROUP BY metric""",
    "tag_schema_incremental": f"""{_E},
        t AS (SELECT DISTINCT metric, 'tier' AS tag FROM e WHERE tier IS NOT NULL
              UNION ALL SELECT DISTINCT metric, 'user' FROM e UNION ALL SELECT DISTINCT metric, 'zone' FROM e)
        SELECT 'remote' AS source, metric, 'double' AS kind, tag,
               CAST(row_number() OVER (PARTITION BY metric ORDER BY tag) AS INTEGER) AS position
        FROM t""",
    "read_chunks": f"""{_E},
        r AS (SELECT {_LABELS} AS labels, ms, value,
                     row_number() OVER (PARTITION BY {_LABELS} ORDER BY ms, value NULLS FIRST) - 1 AS n FROM e)
        SELECT labels, n // {CHUNK_ROWS} AS chunk, n % {CHUNK_ROWS} AS position, ms, value FROM r""",
}
