"""Label sets.

``pairs`` are a series' labels in arrival order, ``entries`` the same labels
renamed, unique and in byte order of the name. Both are arrays of
``struct(name, value)``; a map is only made at rest.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from metricloom import fixed
from metricloom.functions.names import truncate_bytes

PAIRS = "array<struct<name:string,value:string>>"


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def pair(name: Column, value: Column) -> Column:
    """One label."""
    return F.struct(name.alias("name"), value.alias("value"))


def metric_name(labels: Column) -> Column:
    """Value of the name label, null when the series has none."""
    named = F.filter(labels, lambda p: p["name"] == fixed.NAME_LABEL)
    return F.try_element_at(named, F.lit(-1))["value"]


def tag_pairs(labels: Column) -> Column:
    """Every label but the name, in arrival order; absent text reads as empty."""
    tags = F.filter(labels, lambda p: _text(p["name"]) != fixed.NAME_LABEL)
    return F.coalesce(tags, F.array().cast(PAIRS))


def renamed(pairs: Column) -> Column:
    """Remote pairs with stored names; repeated names are still there."""
    return F.transform(
        pairs, lambda p: pair(F.lower(_text(p["name"])), _text(p["value"]))
    )


def entries(pairs: Column) -> Column:
    """Unique pairs in name order; of a repeated name the last value wins."""
    names = pairs["name"]
    unique = F.array_distinct(names)

    def last(name: Column) -> Column:
        same = F.filter(pairs, lambda p: p["name"] == name)
        return pair(name, F.element_at(same, -1)["value"])

    return F.sort_array(
        F.when(F.size(unique) == F.size(names), pairs).otherwise(
            F.transform(unique, last)
        )
    )


def cap_labels(pairs: Column, limit: int = fixed.TAGS_PER_SERIES) -> Column:
    """First ``limit`` labels of a series in arrival order."""
    return F.slice(pairs, 1, limit)


def sanitise_quotes(value: Column) -> Column:
    """Double quotes become single quotes."""
    return F.replace(value, F.lit('"'), F.lit("'"))


def stored_entries(
    pairs: Column,
    folded: Column,
    tag_bytes: int = fixed.TAG_VALUE_BYTES,
    tag_limit: int = fixed.TAGS_PER_SERIES,
) -> Column:
    """Entries as stored for a remote series: capped, cut and unquoted.

    ``pairs`` are the renamed pairs and ``folded`` their entries. The cap picks
    names by arrival order; a picked name keeps its last value.
    """
    first_names = cap_labels(pairs, tag_limit)["name"]
    capped = F.when(F.size(pairs) <= tag_limit, folded).otherwise(
        F.filter(folded, lambda p: F.array_contains(first_names, p["name"]))
    )
    return F.transform(
        capped,
        lambda p: pair(
            p["name"], sanitise_quotes(truncate_bytes(p["value"], tag_bytes))
        ),
    )


def to_label_pairs(metric: Column, tags: Column) -> Column:
    """Label set of a stored series as answered to a read: the name, then tags."""
    name = pair(F.lit(fixed.NAME_LABEL), metric)
    return F.concat(F.array(name), F.sort_array(F.map_entries(tags)).cast(PAIRS))
