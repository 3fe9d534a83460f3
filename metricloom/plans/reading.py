"""Registered queries of the stored lake: scans, catalogue and reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from metricloom.functions import values
from metricloom.operators import catalog, reads, remote
from metricloom.operators.matchers import Options, Query
from metricloom.plans import tables as T
from metricloom.session import work_dir
from metricloom.sources.lake import Lake
from metricloom.sources.logreplay import read_metric_log
from metricloom.streaming.ingest import start_ingest
from metricloom.config import IngestOptions

ALL = (0, 4102444800000)
RANGE = (1704412800000, 1706054400000)
ANY_NAME = ("RE", "__name__", "^app_")


def _flat(points: DataFrame, *extra: str) -> DataFrame:
    return points.select(
        *extra,
        "metric",
        T.tag("user"),
        T.tag("zone"),
        T.tag("tier"),
        values.to_ms(F.col("ts")).alias("ms"),
        "value",
    )


def _read(*matchers, span=ALL, options=Options()):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = T.lake_of(spark, sf_dir)
        return _flat(reads.read_points(lake, Query.of(*span, *matchers), options))

    return query


SELECT = (
    ("RE", "__name__", "click|view|purchase"),
    ("NEQ", "User", "u7"),
    ("RE", "zone", "zone-[0-3]$"),
    ("NRE", "zone", "2"),
    ("NRE", "tier", "^y"),
)
SELECT_QUERY = Query.of(*RANGE, *SELECT)
MANY = (
    Query.of(*RANGE, ("EQ", "__name__", "app:click"), ("EQ", "tier", "x")),
    Query.of(*ALL, ("RE", "__name__", "^app_(click|view)$"), ("RE", "zone", "[12]")),
    Query.of(*RANGE, ("NEQ", "__name__", "app_click"), ("EQ", "tier", ""), ("EQ", "zone", "zone-5")),
)


def scan_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(catalog.scan_metric(T.lake_of(spark, sf_dir), "app_view"))


def wide_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = catalog.wide_view(T.lake_of(spark, sf_dir), "app_view")
    return wide.withColumn("ts", values.to_ms(F.col("ts"))).withColumnRenamed("ts", "ms")


def agent_wide_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = catalog.wide_view(T.lake_of(spark, sf_dir), "_order_str")
    return wide.withColumn("ts", values.to_ms(F.col("ts"))).withColumnRenamed("ts", "ms")


def list_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.list_metrics(T.lake_of(spark, sf_dir).series())


def describe_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.describe_metric(T.lake_of(spark, sf_dir).series(), "app_click")


def describe_agent_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.describe_metric(T.lake_of(spark, sf_dir).series(), "_order_str")


def read_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_select(spark, sf_dir).orderBy("metric", "ms")


def read_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(reads.read_points(T.lake_of(spark, sf_dir), SELECT_QUERY))


def read_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series rows of the selection as the operator gives them, one a day."""
    frames = reads.read_series(T.lake_of(spark, sf_dir), SELECT_QUERY)
    value = F.transform("samples", lambda s: s["value"])
    return frames.select(
        T.entry_text(F.col("labels")).alias("labels"),
        values.to_ms(F.col("frame_start")).alias("frame_ms"),
        F.size("samples").cast("long").alias("samples"),
        values.to_ms(F.col("first_ts")).alias("first_ms"),
        values.to_ms(F.col("last_ts")).alias("last_ms"),
        F.array_min(value).alias("low"),
        F.array_max(value).alias("high"),
    )


def series_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answer of a read written as nested JSON and read back, with samples' places."""
    path = work_dir(spark, "response")
    reads.write_series(reads.read_series(T.lake_of(spark, sf_dir), SELECT_QUERY), path)
    schema = (
        "labels array<struct<name:string,value:string>>, frame_start bigint, "
        "samples array<struct<value:double,timestamp:bigint>>"
    )
    return (
        spark.read.schema(schema)
        .json(path)
        .select(
            T.entry_text(F.col("labels")).alias("labels"),
            F.col("frame_start").alias("frame_ms"),
            F.posexplode("samples").alias("position", "s"),
        )
        .select(
            "labels", "frame_ms", F.col("position").cast("long").alias("position"),
            F.col("s.timestamp").alias("ms"), F.col("s.value").alias("value"),
        )
    )


def read_series_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.series_count(reads.read_points(T.lake_of(spark, sf_dir), SELECT_QUERY))


def read_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(reads.read_many(T.lake_of(spark, sf_dir), MANY), "query_id")


def read_multi_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(reads.read_many(T.lake_of(spark, sf_dir), MANY, merge_queries=True))


def log_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as log line pairs, then replayed."""
    path = work_dir(spark, "log")
    prefix = F.lit("p0 p1 2024/01/01 20:40:20 server.go:")
    labels = F.array_join(
        F.transform(
            F.slice("labels", 2, 3),
            lambda p: F.concat(p["name"], F.lit('="'), F.replace(p["value"], F.lit('"'), F.lit('\\"')), F.lit('"')),
        ),
        ", ",
    )
    lines = F.concat(
        prefix, F.lit("201:  Ts: "), F.col("ms").cast("string"), F.lit(", value: "),
        F.format_string("%f", "value"), F.lit(",\n"),
        prefix, F.lit("202: "), F.col("labels")[0]["value"], F.lit("{"), labels, F.lit("}"),
    )
    T.with_labels(T.table(spark, sf_dir, "events")).select(lines).write.text(path)
    points = remote.normalise_requests(read_metric_log(spark, path))
    return points.points.select("metric", values.to_ms(F.col("ts")).alias("ms"), "value")


def log_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct label sets a replayed log holds."""
    path = work_dir(spark, "log")
    prefix = F.lit("p0 p1 2024/01/01 20:40:20 server.go:")
    lines = F.concat(
        prefix, F.lit("201:  Ts: 1704412800000, value: 1.000000,\n"),
        prefix, F.lit("202: app_"), F.col("event_type"),
        F.lit('{User="u'), (F.col("user_id") % 100).cast("string"), F.lit(", a=b"),
        F.lit('", Zone="zone-'), (F.col("user_id") % 8).cast("string"), F.lit('"}'),
    )
    T.table(spark, sf_dir, "events").select(lines).write.text(path)
    series = remote.normalise_requests(read_metric_log(spark, path)).series
    return series.select("metric", T.tag("user"), T.tag("zone"))


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events followed as a file stream into a new lake, then read whole."""
    lake = Lake(spark, work_dir(spark, "stream-lake"))
    events = (
        spark.readStream.schema(T.EVENT_SCHEMA)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    start_ingest(
        lake,
        T.as_requests(T.with_labels(events)),
        work_dir(spark, "checkpoint"),
        options=IngestOptions(input_tasks=spark.sparkContext.defaultParallelism),
        trigger={"availableNow": True},
    ).awaitTermination()
    return _flat(reads.read_points(lake, Query.of(*ALL, ANY_NAME)))


def agent_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders followed as a stream of agent batches, then the text table."""
    lake = Lake(spark, work_dir(spark, "agent-lake"), grain="month")
    orders = (
        spark.readStream.schema(T.table(spark, sf_dir, "orders").schema)
        .option("pathGlobFilter", "orders.parquet")
        .parquet(sf_dir)
    )
    start_ingest(
        lake,
        T.order_batches(orders),
        work_dir(spark, "checkpoint"),
        source="agent",
        options=IngestOptions.for_agent(input_tasks=spark.sparkContext.defaultParallelism),
        trigger={"availableNow": True},
    ).awaitTermination()
    wide = catalog.wide_view(lake, "_order_str")
    return wide.withColumn("ts", values.to_ms(F.col("ts"))).withColumnRenamed("ts", "ms")


QUERIES = {
    "scan_metric": scan_metric,
    "wide_view": wide_view,
    "agent_wide_view": agent_wide_view,
    "list_metrics": list_metrics,
    "describe_metric": describe_metric,
    "describe_agent_metric": describe_agent_metric,
    "read_name_eq": _read(("EQ", "__name__", "app:click")),
    "read_name_neq": _read(("NEQ", "__name__", "app_click")),
    "read_name_re": _read(("RE", "__name__", "cli|ew$")),
    "read_name_nre": _read(("NRE", "__name__", "cli|ew$")),
    "read_label_eq": _read(ANY_NAME, ("EQ", "tier", "x")),
    "read_label_eq_empty": _read(ANY_NAME, ("EQ", "tier", "")),
    "read_label_neq": _read(ANY_NAME, ("NEQ", "tier", "x")),
    "read_label_neq_promql": _read(ANY_NAME, ("NEQ", "tier", "x"), options=Options(promql=True)),
    "read_label_re": _read(ANY_NAME, ("RE", "tier", "x|q")),
    "read_label_re_anchored": _read(("RE", "__name__", "app_.*"), ("RE", "zone", "one-1|zone-[23]"), options=Options(anchored=True)),
    "read_label_nre": _read(ANY_NAME, ("NRE", "tier", "x|q")),
    "read_range": _read(ANY_NAME, span=RANGE),
    "read_select": read_select,
    "read_ordered": read_ordered,
    "read_series": read_series,
    "series_response": series_response,
    "read_series_count": read_series_count,
    "read_multi": read_multi,
    "read_multi_merged": read_multi_merged,
    "log_replay": log_replay,
    "log_series": log_series,
    "stream_ingest": stream_ingest,
    "agent_stream_ingest": agent_stream_ingest,
}

_E = "WITH " + T.EVENTS_SQL
_A = "WITH " + T.AGENT_SQL
_POINTS = f'{_E} SELECT metric, "user", zone, tier, ms, value FROM e'
_EVERY_POINT = f'''{_E}, {T.AGENT_SQL},
    p AS (SELECT metric, "user", zone, tier, ms, value FROM e
          UNION ALL SELECT metric, NULL, NULL, NULL, ms, num FROM f WHERE kind = 'double')
    SELECT * FROM p'''
_IN_RANGE = f"ms BETWEEN {RANGE[0]} AND {RANGE[1]}"
_SELECTED = f"""regexp_matches(metric, 'click|view|purchase') AND "user" <> 'u7'
    AND regexp_matches(zone, 'zone-[0-3]$') AND NOT regexp_matches(zone, '2')
    AND NOT regexp_matches(coalesce(tier, ''), '^y') AND {_IN_RANGE}"""
_LABELS = (
    "'__name__=' || metric || coalesce(',tier=' || tier, '') "
    "|| ',user=' || \"user\" || ',zone=' || zone"
)
_MULTI = f"""{_E},
    m AS (SELECT 0 AS query_id, * FROM e WHERE metric = 'app_click' AND tier = 'x' AND {_IN_RANGE}
          UNION ALL
          SELECT 1, * FROM e WHERE metric IN ('app_click', 'app_view') AND regexp_matches(zone, '[12]')
          UNION ALL
          SELECT 2, * FROM e WHERE metric <> 'app_click' AND coalesce(tier, '') = '' AND zone = 'zone-5'
                                   AND {_IN_RANGE})"""
_ORDER_TEXT = f"""{_A}
    SELECT ms, o_orderstatus AS value, usr AS _user, priority, srcip, 'orderstatus' AS field FROM o"""

ORACLES = {
    "scan_metric": f"{_POINTS} WHERE metric = 'app_view'",
    "wide_view": f"""{_E}
        SELECT ms, value, md5(coalesce(raw_tier, '') || "user" || zone) AS taghash,
               tier AS t_tier, "user" AS t_user, zone AS t_zone FROM e WHERE metric = 'app_view'""",
    "agent_wide_view": _ORDER_TEXT,
    "list_metrics": f"""{_E}, {T.AGENT_SQL},
        c AS (SELECT metric AS name, 1 + max(CASE WHEN tier IS NULL THEN 2 ELSE 3 END) AS tags,
                     count(DISTINCT {_LABELS}) AS tables FROM e GROUP BY metric
              UNION ALL
              SELECT metric, 4, count(DISTINCT CASE WHEN kind = 'double' THEN vals || '|' || srcip || '|' || field END)
              FROM f GROUP BY metric
              UNION ALL
              SELECT metric || '_str', 4, count(DISTINCT CASE WHEN kind = 'string' THEN vals || '|' || srcip END)
              FROM f GROUP BY metric)
        SELECT name, TIMESTAMP '{T.CREATED_AT}' AS created_time, 2 AS columns, CAST(tags AS BIGINT) AS tags, tables FROM c""",
    "describe_metric": f"""{_E},
        t AS (SELECT 'user' AS tag UNION SELECT 'zone'
              UNION SELECT 'tier' FROM e WHERE metric = 'app_click' AND tier IS NOT NULL)
        SELECT * FROM (VALUES (1, 'ts', 'TIMESTAMP', 8, ''), (2, 'value', 'DOUBLE', 8, ''),
            (3, 'taghash', 'BINARY', 34, 'TAG')) AS v(position, field, type, length, note)
        UNION ALL
        SELECT CAST(3 + row_number() OVER (ORDER BY tag) AS INTEGER), 't_' || tag, 'BINARY', 128, 'TAG' FROM t""",
    "describe_agent_metric": """
        SELECT * FROM (VALUES (1, 'ts', 'TIMESTAMP', 8, ''), (2, 'value', 'BINARY', 256, ''),
            (3, '_user', 'BINARY', 30, 'TAG'), (4, 'priority', 'BINARY', 30, 'TAG'),
            (5, 'srcip', 'BINARY', 20, 'TAG'), (6, 'field', 'BINARY', 40, 'TAG'))
            AS v(position, field, type, length, note)
        WHERE EXISTS (SELECT 1 FROM orders)""",
    "read_name_eq": f"{_POINTS} WHERE metric = 'app_click'",
    "read_name_neq": f"{_EVERY_POINT} WHERE metric <> 'app_click'",
    "read_name_re": f"{_POINTS} WHERE regexp_matches(metric, 'cli|ew$')",
    "read_name_nre": f"{_EVERY_POINT} WHERE NOT regexp_matches(metric, 'cli|ew$')",
    "read_label_eq": f"{_POINTS} WHERE tier = 'x'",
    "read_label_eq_empty": f"{_POINTS} WHERE coalesce(tier, '') = ''",
    "read_label_neq": f"{_POINTS} WHERE tier <> 'x'",
    "read_label_neq_promql": f"{_POINTS} WHERE coalesce(tier, '') <> 'x'",
    "read_label_re": f"{_POINTS} WHERE regexp_matches(coalesce(tier, ''), 'x|q')",
    "read_label_re_anchored": f"{_POINTS} WHERE regexp_full_match(zone, 'one-1|zone-[23]')",
    "read_label_nre": f"{_POINTS} WHERE NOT regexp_matches(coalesce(tier, ''), 'x|q')",
    "read_range": f"{_POINTS} WHERE {_IN_RANGE}",
    "read_select": f"{_POINTS} WHERE {_SELECTED}",
    "read_ordered": f"{_POINTS} WHERE {_SELECTED}",
    "read_series": f"""{_E}
        SELECT {_LABELS} AS labels, ms - ms % {reads.FRAME_MS} AS frame_ms, count(*) AS samples, min(ms) AS first_ms, max(ms) AS last_ms,
               min(value) AS low, max(value) AS high
        FROM e WHERE {_SELECTED} GROUP BY ALL""",
    "series_response": f"""{_E},
        s AS (SELECT {_LABELS} AS labels, ms - ms % {reads.FRAME_MS} AS frame_ms, ms, value FROM e WHERE {_SELECTED})
        SELECT labels, frame_ms, ms, value,
               row_number() OVER (PARTITION BY labels, frame_ms ORDER BY ms, value NULLS FIRST) - 1 AS position
        FROM s""",
    "read_series_count": f"""{_E}
        SELECT count(DISTINCT {_LABELS}) AS series FROM e WHERE {_SELECTED}""",
    "read_multi": f'{_MULTI} SELECT query_id, metric, "user", zone, tier, ms, value FROM m',
    "read_multi_merged": f'{_MULTI} SELECT metric, "user", zone, tier, ms, value FROM m',
    "log_replay": f"{_E} SELECT metric, ms, value FROM e",
    "log_series": f"""{_E} SELECT DISTINCT metric, "user" || ', a=b' AS "user", zone FROM e""",
    "stream_ingest": _POINTS,
    "agent_stream_ingest": _ORDER_TEXT,
}
