"""Series identity.

``exact`` keys hash a JSON text of the sorted label set, so two different
label sets never share a text. ``compat`` keys hash bare values without any
separator; they can collide and exist for lakes that must keep old keys.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from metricloom import fixed
from metricloom.functions import labels as L
from metricloom.functions.names import truncate_bytes

MODES = ("exact", "compat")


def _check(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def _md5(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def _prefixed(text: Column) -> Column:
    return F.concat(F.lit(fixed.KEY_PREFIX), _md5(text))


def series_key(
    metric_raw: Column, raw_labels: Column, entries: Column, mode: str = "exact"
) -> Column:
    """Key of a remote series from its raw name and its labels.

    ``raw_labels`` are all labels as they arrived, the name's among them: a
    ``compat`` key takes its value where it stands, which is not always first.
    ``entries`` are unique and sorted; values are not cut, so long values stay
    apart.
    """
    _check(mode)
    if mode == "compat":
        return _prefixed(F.array_join(raw_labels["value"], ""))
    return _md5(
        F.to_json(F.struct(metric_raw.alias("metric"), entries.alias("labels")))
    )


def agent_origin(
    name: Column, tags: Column, entries: Column, source: Column, mode: str = "exact"
) -> Column:
    """The part of an agent key that all fields of a measurement share.

    ``compat`` takes the raw sorted tag values, ``exact`` the stored names with
    their whole values as a JSON object. An object's text ends where it closes,
    so a field name put after it cannot be taken for a part of it.
    """
    _check(mode)
    if mode == "compat":
        values = F.array_join(F.sort_array(F.map_values(tags)), "")
        return F.concat(name, F.coalesce(values, F.lit("")), source)
    return F.to_json(
        F.struct(name.alias("name"), entries.alias("tags"), source.alias("source"))
    )


def agent_series_key(origin: Column, field: Column, mode: str = "exact") -> Column:
    """Key of an agent series from ``agent_origin`` and the field name."""
    _check(mode)
    text = F.concat(origin, field)
    return _prefixed(text) if mode == "compat" else _md5(text)


def tag_hash(
    pairs: Column,
    entries: Column,
    tag_bytes: int = fixed.TAG_VALUE_BYTES,
    tag_limit: int = fixed.TAGS_PER_SERIES,
) -> Column:
    """md5 of the values in label-name order; only counted labels are cut.

    ``pairs`` are the renamed pairs and ``entries`` the same unique and sorted.
    """

    def cut(value: Column) -> Column:
        return truncate_bytes(value, tag_bytes)

    counted = F.transform(entries, lambda p: cut(p["value"]))
    over = L.entries(
        F.transform(
            pairs,
            lambda p, i: L.pair(
                p["name"],
                F.when(i < tag_limit, cut(p["value"])).otherwise(p["value"]),
            ),
        )
    )["value"]
    values = F.when(F.size(pairs) <= tag_limit, counted).otherwise(over)
    return _md5(F.array_join(values, ""))
