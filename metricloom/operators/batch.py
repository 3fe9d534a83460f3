"""What every write path produces: points, series and rejects of one batch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

SERIES_IDENTITY = ["source", "kind", "metric", "metric_raw", "series_key", "taghash"]


@dataclass(frozen=True)
class Batch:
    """Outputs of one batch, all views of the same ``rows``.

    ``counts`` are aggregates over ``rows`` that report what the batch held.
    """

    rows: DataFrame
    points: DataFrame
    text_points: DataFrame | None
    series: DataFrame
    rejected: DataFrame
    counts: dict[str, Column]


def distinct_series(rows: DataFrame, keep_first: bool = False) -> DataFrame:
    """Each series once, with ``labels`` as a map.

    The whole identity is the grouping key, so map-side hash aggregation folds
    a hot series to one row per task before anything is shuffled. Exact keys
    decide the labels, so that is enough; compat keys can be shared by several
    label sets, and ``keep_first`` then keeps one row per key.
    """
    return labelled(rows.select(*SERIES_IDENTITY, "entries").distinct(), keep_first)


def labelled(found: DataFrame, keep_first: bool = False) -> DataFrame:
    """Distinct identities and their ``entries`` as series, see ``distinct_series``."""
    if keep_first:
        rest = [c for c in found.columns if c not in ("kind", "metric", "series_key")]
        found = (
            found.groupBy("kind", "metric", "series_key")
            .agg(F.min(F.struct(*rest)).alias("first"))
            .select("kind", "metric", "series_key", "first.*")
        )
    return found.select(
        *SERIES_IDENTITY, F.map_from_entries("entries").alias("labels")
    )


def catalogue_items(series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What ``series`` add to the catalogue: ``source, metric, what, item, n, created_at``.

    A row for each tag of a metric, and one, without ``item``, that counts its
    series of a kind. There are as many rows as a metric has tags, however many
    series it has, and rows of several batches merge by sum and minimum.
    ``by`` adds grouping columns.
    """
    item = F.concat(
        F.array(F.struct(F.concat(F.lit("series_"), "kind").alias("what"), F.lit(None).cast("string").alias("item"))),
        F.transform(F.map_keys("labels"), lambda k: F.struct(F.lit("tag").alias("what"), k.alias("item"))),
    )
    return (
        series.select(*by, "source", "metric", "created_at", F.explode(item).alias("i"))
        .groupBy(*by, "source", "metric", "i.what", "i.item")
        .agg(F.count(F.lit(1)).alias("n"), F.min("created_at").alias("created_at"))
    )


def rejects(rows: DataFrame) -> DataFrame:
    """Rows that cannot be stored, as ``(source, reason, payload)``."""
    return rows.where(F.col("reason").isNotNull()).select("source", "reason", "payload")
