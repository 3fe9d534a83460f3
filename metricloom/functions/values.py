"""Sample values and timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NUMBER = "double"
TEXT = "string"


def finite_or_null(value: Column) -> Column:
    """NaN and both infinities are stored as null (NaN sorts above infinity)."""
    return F.when(F.abs(value) < float("inf"), value)


# First and last ms of the years 1 to 9999; readers take no others.
MIN_MS = -62_135_596_800_000
MAX_MS = 253_402_300_799_999


def in_range(millis: Column) -> Column:
    """Whether an epoch in ms can be stored; an absent one is zero and can."""
    return F.coalesce(millis, F.lit(0).cast("bigint")).between(MIN_MS, MAX_MS)


def to_ts(millis: Column) -> Column:
    """Timestamp of an epoch in ms, null out of range; an absent epoch is zero, as on the wire."""
    present = F.coalesce(millis, F.lit(0).cast("bigint"))
    return F.timestamp_millis(F.when(in_range(millis), present))


def to_ms(ts: Column) -> Column:
    """Epoch in ms of a timestamp, cut towards the past."""
    return F.unix_millis(ts)


def field_kind(variant: Column) -> Column:
    """``double`` or ``string`` for a storable field, null for any other type.

    The type is read before any cast, because a cast would also turn true
    into 1.0 and the text "7" into 7.0.
    """
    return shape_kind(F.schema_of_variant(variant))


def shape_kind(shape: Column) -> Column:
    """``field_kind`` of a variant by its schema."""
    number = shape.isin("BIGINT", "DOUBLE", "FLOAT") | shape.startswith("DECIMAL")
    return F.when(number, F.lit(NUMBER)).when(shape == "STRING", F.lit(TEXT))


def field_number(variant: Column) -> Column:
    """Number held by a variant that ``field_kind`` calls ``double``."""
    return F.try_variant_get(variant, "$", "double")


def field_text(variant: Column) -> Column:
    """Text held by a variant that ``field_kind`` calls ``string``."""
    return F.try_variant_get(variant, "$", "string")
