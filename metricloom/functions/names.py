"""Name rules: byte-length cuts and escaping of metric, table and tag names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from metricloom import fixed


def truncate_bytes(value: Column, limit: int) -> Column:
    """Keep at most ``limit`` UTF-8 bytes, never half a character.

    A cut inside a character leaves one broken sequence at the end, which
    reads as a single replacement character and is dropped.
    """
    cut = F.substring(value.cast("binary"), 1, limit).cast("string")
    mended = F.make_valid_utf8(cut)
    whole = F.when(F.is_valid_utf8(cut), cut).otherwise(
        F.left(mended, F.length(mended) - 1)
    )
    return F.when(F.octet_length(value) <= limit, value).otherwise(whole)


def _underscored(name: Column) -> Column:
    return F.translate(name, ":.-", "___")


def escape_metric(name: Column) -> Column:
    """Stored name of a remote metric: separators become ``_``, case is kept."""
    return truncate_bytes(_underscored(name), fixed.METRIC_NAME_BYTES)


def _unreserved(plain: Column) -> Column:
    needs_mark = plain.isin(*fixed.RESERVED_WORDS) | plain.rlike(r"^\p{Nd}")
    return (
        F.when(plain == "", F.lit("__"))
        .when(needs_mark, F.concat(F.lit("_"), plain))
        .otherwise(plain)
    )


def escape_agent_table(name: Column) -> Column:
    """Stored name of an agent measurement."""
    escaped = _unreserved(_underscored(F.lower(name)))
    return truncate_bytes(escaped, fixed.AGENT_TABLE_BYTES)


def escape_agent_tags(names: Column) -> Column:
    """Stored names of an array of agent tag keys.

    Each step is its own ``transform``, so a step's result is made once per
    name however often the next step looks at it.
    """
    plain = F.transform(names, lambda name: _underscored(F.lower(name)))
    escaped = F.transform(plain, _unreserved)
    return F.transform(
        escaped, lambda name: truncate_bytes(name, fixed.AGENT_TAG_NAME_BYTES)
    )


def tag_column(label: str) -> str:
    """Column that holds a remote label in a wide view."""
    return fixed.TAG_PREFIX + label


def tag_label(column: str) -> str:
    """Label that a wide-view column holds."""
    return column.removeprefix(fixed.TAG_PREFIX)
