"""Remote-write path: nested requests to points, series and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from metricloom import fixed
from metricloom.functions import identity, labels as L, names, values
from metricloom.operators.batch import Batch, distinct_series, rejects
from metricloom.sources.remote import CORRUPT

SOURCE = "remote"


def identify_series(
    requests: DataFrame,
    key_mode: str = "exact",
    tag_bytes: int = fixed.TAG_VALUE_BYTES,
    tag_limit: int = fixed.TAGS_PER_SERIES,
) -> DataFrame:
    """One row per incoming series, named and keyed, samples still nested.

    Keys, hashes and tags are made here, once per series and before samples
    are exploded, so their cost does not grow with the samples. ``reason`` is
    set on rows that cannot be stored; samples whose time cannot be stored are
    taken out and kept in ``refused``.
    """
    corrupt = F.col(CORRUPT) if CORRUPT in requests.columns else F.lit(None).cast("string")
    # "corrupt" is made to depend on the exploded column: a filter on it then
    # stays above the explode and never makes the JSON be parsed twice.
    series = (
        requests.select(
            corrupt.alias("text"),
            # A record with any part of a wrong type is refused as a whole.
            F.explode_outer(F.when(corrupt.isNull(), F.col("timeseries"))).alias("s"),
        )
        .withColumn("corrupt", F.when(F.col("s").isNull(), F.col("text")))
        .where("s is not null or corrupt is not null")
    )
    reason = (
        F.when(F.col("corrupt").isNotNull(), F.lit("malformed_request"))
        .when(F.col("metric_raw").isNull(), F.lit("missing_name"))
        .when(F.col("metric_raw") == "", F.lit("empty_name"))
    )
    named = (
        series.select(
            "corrupt",
            F.col("s.samples").alias("samples"),
            F.col("s.labels").alias("raw_labels"),
        )
        .withColumns(
            {
                "metric_raw": L.metric_name(F.col("raw_labels")),
                "pairs": L.renamed(L.tag_pairs(F.col("raw_labels"))),
            }
        )
        .withColumn("folded", L.entries(F.col("pairs")))
    )
    payload = F.when(
        reason.isNotNull(),
        F.coalesce(
            F.col("corrupt"),
            F.to_json(F.struct(F.col("raw_labels").alias("labels"), "samples")),
        ),
    )
    far = F.filter("samples", lambda s: ~values.in_range(s["timestamp"]))
    refused = F.when(
        reason.isNull() & (F.size(far) > 0),
        F.to_json(F.struct(F.col("raw_labels").alias("labels"), far.alias("samples"))),
    )
    raw, pairs, folded = F.col("metric_raw"), F.col("pairs"), F.col("folded")
    return named.select(
        F.lit(SOURCE).alias("source"),
        F.lit(values.NUMBER).alias("kind"),
        names.escape_metric(raw).alias("metric"),
        "metric_raw",
        identity.series_key(raw, F.col("raw_labels"), folded, key_mode).alias("series_key"),
        identity.tag_hash(pairs, folded, tag_bytes, tag_limit).alias("taghash"),
        L.stored_entries(pairs, folded, tag_bytes, tag_limit).alias("entries"),
        F.filter("samples", lambda s: values.in_range(s["timestamp"])).alias("samples"),
        reason.alias("reason"),
        payload.alias("payload"),
        refused.alias("refused"),
    )


def _stored_samples(first_only: bool) -> Column:
    size = F.coalesce(F.size("samples"), F.lit(0))
    return F.least(size, F.lit(1)) if first_only else size


def explode_samples(rows: DataFrame, first_only: bool = False) -> DataFrame:
    """Points of identified series: every sample, or the first of each series."""
    samples = F.slice("samples", 1, 1) if first_only else F.col("samples")
    return rows.select(
        "metric", "series_key", F.explode(samples).alias("sample")
    ).select(
        "metric",
        "series_key",
        values.to_ts(F.col("sample.timestamp")).alias("ts"),
        values.finite_or_null(F.col("sample.value")).alias("value"),
    )


def batch_of(
    rows: DataFrame, key_mode: str = "exact", first_only: bool = False
) -> Batch:
    """Points, series and rejects of identified series."""
    good = rows.where(F.col("reason").isNull())
    stored = F.when(F.col("reason").isNull(), _stored_samples(first_only))
    return Batch(
        rows=rows,
        points=explode_samples(good, first_only),
        text_points=None,
        series=distinct_series(good, keep_first=key_mode == "compat"),
        rejected=rejects(rows).unionByName(
            rows.where(F.col("refused").isNotNull()).select(
                "source",
                F.lit("timestamp_range").alias("reason"),
                F.col("refused").alias("payload"),
            )
        ),
        counts={
            "points": F.coalesce(F.sum(stored), F.lit(0)),
            "rejected": F.count("reason") + F.count("refused"),
        },
    )


def normalise_requests(
    requests: DataFrame,
    key_mode: str = "exact",
    tag_bytes: int = fixed.TAG_VALUE_BYTES,
    tag_limit: int = fixed.TAGS_PER_SERIES,
    first_only: bool = False,
) -> Batch:
    """Points, series and rejects of ``requests``."""
    rows = identify_series(requests, key_mode, tag_bytes, tag_limit)
    return batch_of(rows, key_mode, first_only)
