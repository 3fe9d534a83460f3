"""Metric catalogue and tag schemas, all derived from the series table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from metricloom import fixed
from metricloom.functions import values
from metricloom.functions.names import tag_column, tag_label
from metricloom.operators import agent, remote
from metricloom.operators.reads import SERIES_KEYS, with_tags
from metricloom.sources.lake import Lake

# Columns of a wide table that callers get without asking for more.
MAX_WIDE_TAGS = 10_000


def _twins() -> Column:
    """Name suffixes of the tables a metric has: agent metrics have a text twin."""
    return F.when(
        F.col("source") == agent.SOURCE,
        F.array(F.lit(""), F.lit(fixed.TEXT_SUFFIX)),
    ).otherwise(F.array(F.lit("")))


def metric_tags(series: DataFrame) -> DataFrame:
    """Distinct ``(source, metric, tag)``."""
    return series.select(
        "source", "metric", F.explode(F.map_keys("labels")).alias("tag")
    ).distinct()


def infer_tag_schema(series: DataFrame) -> DataFrame:
    """Tag list of every metric table: ``source, metric, kind, position, tag``.

    Tags are in byte order. Remote metrics have one numeric table; agent
    metrics have a numeric one and a text twin with the same tags, where the
    origin tags come last. Tag names are made distinct before they are ranked,
    so a task ranks a metric's tag names and never its series.
    """
    return _ranked(metric_tags(series))


def _ranked(tags: DataFrame) -> DataFrame:
    origin = [fixed.SOURCE_TAG, fixed.FIELD_TAG]
    is_origin = (F.col("source") == agent.SOURCE) & F.col("tag").isin(*origin)
    order = Window.partitionBy("source", "metric").orderBy(
        F.when(~is_origin, 0).when(F.col("tag") == fixed.SOURCE_TAG, 1).otherwise(2),
        "tag",
    )
    ranked = tags.withColumn("position", F.row_number().over(order))
    return ranked.select(
        "source", "position", "tag", F.col("metric").alias("base"),
        F.explode(_twins()).alias("suffix"),
    ).select(
        "source",
        F.concat("base", "suffix").alias("metric"),
        F.when(F.col("suffix") == "", values.NUMBER).otherwise(values.TEXT).alias("kind"),
        "position",
        "tag",
    )


def detect_new_tags(series: DataFrame, known: DataFrame) -> DataFrame:
    """Tags of ``series`` that their metric does not have yet in ``known``."""
    return metric_tags(series).join(
        metric_tags(known), ["source", "metric", "tag"], "left_anti"
    )


def known_tags(lake: Lake) -> DataFrame:
    """``metric_tags`` of all registered series, from the batches' partial catalogues."""
    return lake.catalogue().where(F.col("what") == "tag").select("source", "metric", F.col("item").alias("tag")).distinct()


def merged_tag_schema(lake: Lake) -> DataFrame:
    """``infer_tag_schema`` of all registered series, from the partial catalogues."""
    return _ranked(known_tags(lake))


def unknown_tags(series: DataFrame, lake: Lake) -> DataFrame:
    """Tags of ``series`` that no batch of the lake has brought yet; its series are not read."""
    return metric_tags(series).join(known_tags(lake), ["source", "metric", "tag"], "left_anti")


def list_metrics(series: DataFrame) -> DataFrame:
    """Catalogue: ``name, created_time, columns, tags, tables`` of each table.

    Series keys and tag names are folded as ``(metric, kind, item)`` in one
    distributed aggregation and only counted per metric, so a metric that has
    most of the series is no hot group.
    """
    return _listed(_counted(series))


def merged_metrics(lake: Lake) -> DataFrame:
    """``list_metrics`` of all registered series, merged from the batches' partial catalogues.

    What is read grows with batches, metrics and tags. A stream registers a
    series once, so its counts add up; series of a metric that several streams
    hold may be the same, and of those metrics alone series are counted anew.
    """
    parts = lake.catalogue()
    key = ["source", "metric"]
    number = lambda kind: F.sum(F.when(F.col("what") == f"series_{kind}", F.col("n")).otherwise(0))
    added = (
        parts.groupBy(*key, "what", "item")
        .agg(F.min("created_at").alias("created_at"), F.sum("n").alias("n"))
        .groupBy(*key)
        .agg(
            F.min("created_at").alias("created_time"), F.count_if(F.col("what") == "tag").alias("tags"),
            number(values.NUMBER).alias("numeric"), number(values.TEXT).alias("texts"),
        )
    )
    shared = (
        parts.groupBy(*key).agg((F.min("stream") < F.max("stream")).alias("shared")).where("shared").select(*key)
    )
    if shared.isEmpty():
        return _listed(added)
    again = _counted(lake.series().join(shared, key, "left_semi"))
    return _listed(added.join(shared, key, "left_anti").unionByName(again))


def _counted(series: DataFrame) -> DataFrame:
    item = F.concat(
        F.array(F.struct(F.concat(F.lit("series_"), "kind").alias("what"), F.col("series_key").alias("item"))),
        F.transform(F.map_keys("labels"), lambda k: F.struct(F.lit("tag").alias("what"), k.alias("item"))),
    )
    folded = (
        series.select("source", "metric", "created_at", F.explode(item).alias("i"))
        .groupBy("source", "metric", "i.what", "i.item")
        .agg(F.min("created_at").alias("created_at"))
    )
    return folded.groupBy("source", "metric").agg(
        F.min("created_at").alias("created_time"),
        F.count_if(F.col("what") == "tag").alias("tags"),
        F.count_if(F.col("what") == f"series_{values.NUMBER}").alias("numeric"),
        F.count_if(F.col("what") == f"series_{values.TEXT}").alias("texts"),
    )


def _listed(per_metric: DataFrame) -> DataFrame:
    hash_tag = F.when(F.col("source") == remote.SOURCE, 1).otherwise(0)
    return per_metric.withColumn("suffix", F.explode(_twins())).select(
        F.concat("metric", "suffix").alias("name"),
        "created_time",
        F.lit(2).alias("columns"),
        (F.col("tags") + hash_tag).alias("tags"),
        F.when(F.col("suffix") == "", F.col("numeric")).otherwise(F.col("texts")).alias("tables"),
    )


def _structure(
    series: DataFrame,
    name: str,
    tag_bytes: int = fixed.TAG_VALUE_BYTES,
    agent_tag_bytes: int = fixed.AGENT_TAG_DECLARED_BYTES,
) -> DataFrame:
    own = series.where(F.col("metric").isin(name, name.removesuffix(fixed.TEXT_SUFFIX)))
    is_remote = F.col("source") == remote.SOURCE
    is_text = F.col("suffix") != ""
    tables = (
        own.select("source", "metric")
        .distinct()
        .select("source", F.explode(_twins()).alias("suffix"), "metric")
        .where(F.concat("metric", "suffix") == name)
    )
    columns = F.array_compact(
        F.array(
            _field(1, "ts", "TIMESTAMP", F.lit(8), ""),
            F.when(is_text, _field(2, "value", "BINARY", F.lit(fixed.TEXT_VALUE_BYTES), ""))
            .otherwise(_field(2, "value", "DOUBLE", F.lit(8), "")),
            F.when(is_remote, _field(3, "taghash", "BINARY", F.lit(fixed.TAGHASH_BYTES), "TAG")),
        )
    )
    tag = F.col("tag")
    length = (
        F.when(is_remote, tag_bytes)
        .when(tag == fixed.SOURCE_TAG, fixed.SOURCE_TAG_BYTES)
        .when(tag == fixed.FIELD_TAG, fixed.FIELD_TAG_BYTES)
        .otherwise(agent_tag_bytes)
    )
    tags = infer_tag_schema(own).where(F.col("metric") == name)
    return (
        tables.select("source", F.explode(columns).alias("f"))
        .select("source", "f.*")
        .unionByName(
            tags.select(
                "source",
                (F.col("position") + F.when(is_remote, 3).otherwise(2)).alias("position"),
                F.when(is_remote, F.concat(F.lit(fixed.TAG_PREFIX), tag)).otherwise(tag).alias("field"),
                F.lit("BINARY").alias("type"),
                length.alias("length"),
                F.lit("TAG").alias("note"),
            )
        )
    )


def describe_metric(series: DataFrame, name: str, **lengths: int) -> DataFrame:
    """Structure of one metric table: ``position, field, type, length, note``."""
    return _structure(series, name, **lengths).drop("source")


def _field(position: int, name: str, kind: str, length: Column, note: str) -> Column:
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(name).alias("field"),
        F.lit(kind).alias("type"),
        length.alias("length"),
        F.lit(note).alias("note"),
    )


def scan_metric(lake: Lake, name: str, kind: str = values.NUMBER) -> DataFrame:
    """Every point of one metric with the tags of its series as a map."""
    one = (F.col("metric") == name)
    series = lake.series().where(one & (F.col("kind") == kind))
    return with_tags(
        lake.points(kind).where(one).select(*SERIES_KEYS, "ts", "value"),
        series.select(*SERIES_KEYS, "taghash", "labels"),
    ).drop("stream")


def wide_view(
    lake: Lake, name: str, source: str | None = None, tags: Sequence[str] | None = None,
    max_columns: int | None = MAX_WIDE_TAGS,
) -> DataFrame:
    """One metric table with a column per tag; a missing tag is null.

    The columns of a DataFrame are part of its plan, so tag names are looked
    up first unless given; points are not touched for that. A table of more
    than ``max_columns`` columns is refused, unless that is None.
    """
    found = _structure(lake.series(), name).select("source", "position", "field", "type", "note")
    rows = (found if max_columns is None else found.limit(max_columns + 1)).collect()
    if max_columns is not None and len(rows) > max_columns:
        raise ValueError(f"{name!r} has more than {max_columns} columns, raise max_columns")
    sources = {row["source"] for row in rows} & ({source} if source else {remote.SOURCE, agent.SOURCE})
    if len(sources) != 1:
        raise ValueError(f"no metric {name!r}" if not sources else f"give the source of {name!r}")
    (source,) = sources
    rows = sorted((r for r in rows if r["source"] == source), key=lambda r: r["position"])
    is_text = any(r["field"] == "value" and r["type"] == "BINARY" for r in rows)
    points = scan_metric(
        lake,
        name.removesuffix(fixed.TEXT_SUFFIX) if is_text else name,
        values.TEXT if is_text else values.NUMBER,
    )
    if source == remote.SOURCE:
        found_tags = [tag_label(r["field"]) for r in rows if r["position"] > 3]
        head, column = ["ts", "value", "taghash"], tag_column
    else:
        found_tags = [r["field"] for r in rows if r["position"] > 2]
        head, column = ["ts", "value"], str
    return points.select(
        *head,
        *[
            F.try_element_at("labels", F.lit(tag)).alias(column(tag))
            for tag in (found_tags if tags is None else tags)
        ],
    )


def publish_view(lake: Lake, name: str, source: str | None = None) -> None:
    """Make ``SELECT * FROM <name>`` work in this session's SQL."""
    wide_view(lake, name, source).createOrReplaceTempView(name)
