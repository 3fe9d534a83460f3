"""Registered queries of file streams, rejects, compaction and namespaces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from metricloom.config import IngestOptions
from metricloom.functions import labels as L, values
from metricloom.operators import reads
from metricloom.operators.matchers import Query
from metricloom.plans import tables as T
from metricloom.plans.reading import ALL, ANY_NAME
from metricloom.session import work_dir
from metricloom.sources.lake import Lake, compact, ensure_namespace
from metricloom.streaming.ingest import follow, start_ingest

FILES, FILES_A_BATCH = 6, 2
FAR_MS = 9_223_372_036_854_775_807

_lakes: dict[tuple[str, str, str], Lake] = {}


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request lines: events, and some that cannot be stored: broken text of nations, far times of regions."""
    line = lambda rows: rows.select(F.to_json(F.struct("timeseries")).alias("value"))
    events = T.as_requests(T.with_labels(T.table(spark, sf_dir, "events")))
    broken = T.table(spark, sf_dir, "nation").select(F.concat(F.lit('{"timeseries": '), "n_name").alias("value"))
    far = T.table(spark, sf_dir, "region").select(F.array(L.pair(F.lit("__name__"), F.col("r_name"))).alias("labels"))
    far = T.as_requests(far, T.sample(F.lit(1.0), F.lit(FAR_MS)))
    return line(events).unionByName(broken).unionByName(line(far))


def streamed(spark: SparkSession, sf_dir: str) -> Lake:
    """Lake of those lines as JSON files, followed over several micro-batches.

    The stream is stopped, its last files are announced, and it is started
    again from its checkpoint.
    """
    key = (spark.sparkContext.applicationId, sf_dir, "streamed")
    if key not in _lakes:
        lake, inbox, checkpoint = (work_dir(spark, name) for name in ("files-lake", "inbox", "checkpoint"))
        made = Lake(spark, lake, grain="month")
        options = IngestOptions(batch_size=FILES_A_BATCH)
        lines = _lines(spark, sf_dir)
        late = F.xxhash64("value") % 2 == 0
        for part in (~late, late):
            lines.where(part).repartition(FILES // 2).write.mode("append").text(inbox)
            start_ingest(
                made, follow(spark, inbox, options=options), checkpoint, options=options,
                trigger={"availableNow": True}, created_at=F.lit(T.CREATED_AT).cast("timestamp"),
            ).awaitTermination()
        _lakes[key] = made
    return _lakes[key]


def compacted(spark: SparkSession, sf_dir: str) -> Lake:
    """The streamed lake rewritten into a new root."""
    key = (spark.sparkContext.applicationId, sf_dir, "compacted")
    if key not in _lakes:
        target = Lake(spark, work_dir(spark, "compact-lake"), grain="month")
        compact(streamed(spark, sf_dir), target)
        _lakes[key] = target
    return _lakes[key]


def _points(lake: Lake) -> DataFrame:
    points = reads.read_points(lake, Query.of(*ALL, ANY_NAME))
    return points.select("metric", T.tag("user"), T.tag("zone"), T.tag("tier"), values.to_ms(F.col("ts")).alias("ms"), "value")


def stream_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points that came as files over several micro-batches and a restart."""
    return _points(streamed(spark, sf_dir))


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the files could not be stored, and why."""
    return streamed(spark, sf_dir).rejected().select("source", "reason", "payload")


def compact_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points after compaction."""
    return _points(compacted(spark, sf_dir))


def compact_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered series after compaction."""
    return compacted(spark, sf_dir).series().select(
        "metric", "metric_raw", T.tag("user"), T.tag("zone"), T.tag("tier"))


def namespaces_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A namespace for each region, created twice over, and what the catalogue then has."""
    regions = [r[0] for r in T.table(spark, sf_dir, "region").select("r_name").orderBy("r_name").collect()]
    current = spark.catalog.currentDatabase()
    names = [f"metricloom_{name.lower().replace(' ', '_')}" for name in regions]
    try:
        for name in names + names:
            ensure_namespace(spark, name)
        found = spark.sql("SHOW DATABASES LIKE 'metricloom_*'").collect()
    finally:
        spark.catalog.setCurrentDatabase(current)
        for name in names:
            spark.sql(f"DROP DATABASE IF EXISTS `{name}`")
    return spark.createDataFrame([r[0] for r in found], "string").select(F.col("value").alias("name"))


QUERIES = {
    "stream_files": stream_files,
    "stream_rejects": stream_rejects,
    "compact_points": compact_points,
    "compact_series": compact_series,
    "namespaces_created": namespaces_created,
}

_E = "WITH " + T.EVENTS_SQL
_POINTS = f'{_E} SELECT metric, "user", zone, tier, ms, value FROM e'
_FAR = (
    """'{"labels":[{"name":"__name__","value":"' || r_name || '"}],"samples":[{"value":1.0,"timestamp":"""
    + str(FAR_MS) + """}]}'"""
)

ORACLES = {
    "stream_files": _POINTS,
    "stream_rejects": f"""
        SELECT 'remote' AS source, 'malformed_request' AS reason, '{{"timeseries": ' || n_name AS payload FROM nation
        UNION ALL SELECT 'remote', 'timestamp_range', {_FAR} FROM region""",
    "compact_points": _POINTS,
    "compact_series": f"""{_E}
        SELECT DISTINCT metric, metric_raw, "user", zone, tier FROM e
        UNION ALL SELECT r_name, r_name, NULL, NULL, NULL FROM region""",
    "namespaces_created": "SELECT 'metricloom_' || replace(lower(r_name), ' ', '_') AS name FROM region",
}
