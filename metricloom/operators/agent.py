"""Agent path: measurement batches to typed points, series and rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from metricloom import fixed
from metricloom.functions import identity, labels as L, names, values
from metricloom.operators.batch import Batch, SERIES_IDENTITY, labelled
from metricloom.sources.remote import CORRUPT

SOURCE = "agent"

# What ``identity.agent_origin`` writes in the exact mode.
HELD = f"name string, tags {L.PAIRS}, source string"


def explode_metrics(batches: DataFrame) -> DataFrame:
    """One row per measurement of each batch, plus one per malformed batch."""
    # "corrupt" is made to depend on the exploded column: a filter on it then
    # stays above the explode and never makes the JSON be parsed twice.
    corrupt = F.col(CORRUPT) if CORRUPT in batches.columns else F.lit(None).cast("string")
    return (
        batches.select(
            F.coalesce(F.col(fixed.SOURCE_TAG), F.lit("")).alias("srcip"),
            corrupt.alias("text"),
            # A batch with any part of a wrong type is refused as a whole.
            F.explode_outer(F.when(corrupt.isNull(), F.col("metrics"))).alias("m"),
        )
        .withColumn("corrupt", F.when(F.col("m").isNull(), F.col("text")))
        .where("m is not null or corrupt is not null")
        .select(
            "srcip",
            "corrupt",
            F.coalesce("m.name", F.lit("")).alias("name"),
            F.col("m.tags").alias("tags"),
            F.col("m.fields").alias("fields"),
            F.col("m.timestamp").alias("timestamp"),
        )
    )


def explode_fields(metrics: DataFrame) -> DataFrame:
    """One row per field of each measurement (wide to long)."""
    return metrics.select(
        *[c for c in metrics.columns if c != "fields"],
        F.explode_outer("fields").alias("field", "v"),
    ).where("field is not null or corrupt is not null")


def route_fields(fields: DataFrame) -> DataFrame:
    """Type each field: ``kind``, and ``value`` or ``text``; else a ``reason``."""
    v, kind = F.col("v"), F.col("kind")
    timed = values.in_range(F.col("timestamp"))
    reason = (
        F.when(F.col("corrupt").isNotNull(), F.lit("malformed_batch"))
        .when(~timed, F.lit("timestamp_range"))
        .when(kind.isNull(), F.lit("field_type"))
    )
    # A step's result is looked at several times by the next one, and made once.
    return (
        fields.withColumn("shape", F.when(timed, F.schema_of_variant(v)))
        .withColumn("kind", values.shape_kind(F.col("shape")))
        .withColumns(
            {
                "reason": reason,
                "value": F.when(kind == values.NUMBER, values.field_number(v)),
                "text": F.when(kind == values.TEXT, values.field_text(v)),
            }
        )
        .withColumn("value", values.finite_or_null(F.col("value")))
        .drop("shape")
    )


def identify_fields(metrics: DataFrame, key_mode: str = "exact") -> DataFrame:
    """Typed field rows of measurements, named and keyed.

    Names, tags and the shared part of the key are made once per measurement,
    before its fields are exploded. A row has its tags as the text ``held``,
    which also is what an exact key hashes: labels are only made of it for the
    distinct series and for rejects, see ``batch_of``. A rejected row has what
    it held as ``text``.
    """
    pairs = F.arrays_zip(
        names.escape_agent_tags(F.map_keys("tags")).alias("name"),
        F.transform(F.map_values("tags"), lambda v: F.coalesce(v, F.lit(""))).alias("value"),
    ).cast(L.PAIRS)
    held = identity.agent_origin(F.col("name"), F.col("tags"), F.col("folded"), F.col("srcip"))
    named = (
        metrics.withColumn("pairs", F.coalesce(pairs, F.array().cast(L.PAIRS)))
        .withColumn("folded", L.entries(F.col("pairs")))
        .withColumns({"metric": names.escape_agent_table(F.col("name")), "held": held})
    )
    if key_mode != "exact":
        named = named.withColumn(
            "origin",
            identity.agent_origin(F.col("name"), F.col("tags"), F.col("folded"), F.col("srcip"), key_mode),
        )
    origin = F.col("held" if key_mode == "exact" else "origin")
    named = named.drop("pairs", "folded", "tags", "srcip")
    return route_fields(explode_fields(named)).select(
        "kind",
        "metric",
        identity.agent_series_key(origin, F.col("field"), key_mode).alias("series_key"),
        "held",
        "field",
        "timestamp",
        "value",
        F.when(F.col("reason").isNull(), F.col("text")).otherwise(F.coalesce("corrupt", F.to_json("v"))).alias("text"),
        "reason",
    )


def _stored(rows: DataFrame) -> DataFrame:
    """``rows`` with the ``name`` they came under and ``stored``, their series' tags but for the field's."""
    reserved = [fixed.SOURCE_TAG, fixed.FIELD_TAG]
    tags = F.transform(
        F.filter("parts.tags", lambda p: ~p["name"].isin(*reserved)),
        lambda p: L.pair(p["name"], names.truncate_bytes(p["value"], fixed.AGENT_TAG_VALUE_BYTES)),
    )
    return rows.withColumn("parts", F.from_json("held", HELD)).withColumns(
        {
            "name": F.col("parts.name"),
            "stored": F.concat(tags, F.array(L.pair(F.lit(fixed.SOURCE_TAG), F.col("parts.source")))),
        }
    )


def _series(rows: DataFrame, keep_first: bool) -> DataFrame:
    """Series of identified fields, see ``batch.distinct_series``; labels are made once for each."""
    found = _stored(rows.select("kind", "metric", "series_key", "held", "field").distinct())
    field_tag = F.array(L.pair(F.lit(fixed.FIELD_TAG), F.col("field")))
    made = {
        "source": F.lit(SOURCE),
        "metric_raw": F.col("name"),
        "taghash": F.lit(None).cast("string"),
        "entries": F.concat("stored", field_tag),
    }
    return labelled(found.withColumns(made).select(*SERIES_IDENTITY, "entries"), keep_first)


def _rejected(rows: DataFrame) -> DataFrame:
    """Rejects of identified fields: a malformed batch with its text, a field with what it held."""
    field = F.to_json(
        F.struct(
            "name",
            F.map_from_entries("stored").alias("tags"),
            "field",
            F.col("text").alias("value"),
            "timestamp",
        )
    )
    return _stored(rows.where(F.col("reason").isNotNull())).select(
        F.lit(SOURCE).alias("source"),
        "reason",
        F.when(F.col("field").isNull(), F.col("text")).otherwise(field).alias("payload"),
    )


def batch_of(rows: DataFrame, key_mode: str = "exact") -> Batch:
    """Numeric and text points, series and rejects of identified fields."""
    kind, ts = F.col("kind"), values.to_ts(F.col("timestamp")).alias("ts")
    return Batch(
        rows=rows,
        points=rows.where(kind == values.NUMBER).select("metric", "series_key", ts, "value"),
        text_points=rows.where(kind == values.TEXT).select(
            "metric", "series_key", ts, F.col("text").alias("value")
        ),
        series=_series(rows.where(kind.isNotNull()), keep_first=key_mode == "compat"),
        rejected=_rejected(rows),
        counts={
            "points": F.count_if(kind == values.NUMBER),
            "text_points": F.count_if(kind == values.TEXT),
            "rejected": F.count("reason"),
        },
    )


def normalise_batches(batches: DataFrame, key_mode: str = "exact") -> Batch:
    """Numeric and text points, series and rejects of agent ``batches``."""
    return batch_of(identify_fields(explode_metrics(batches), key_mode), key_mode)


def batch_groups(metrics: DataFrame) -> DataFrame:
    """Measurements per ``(timestamp, name)`` of the stream of batches.

    The report behind grouping a batch: how many measurements and fields share
    a time and a name. Counts combine map-side, nothing is collected.
    """
    return (
        metrics.where("corrupt is null")
        .select(
            values.to_ts(F.col("timestamp")).alias("ts"),
            "name",
            F.coalesce(F.size("fields"), F.lit(0)).alias("n_fields"),
        )
        .groupBy("ts", "name")
        .agg(
            F.count(F.lit(1)).alias("metrics"), F.sum("n_fields").alias("fields")
        )
    )
