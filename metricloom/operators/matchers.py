"""Label matchers as Column predicates."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, SparkSession, functions as F

from metricloom import fixed
from metricloom.functions.dialect import checked_regex
from metricloom.functions.names import escape_metric

TYPES = ("EQ", "NEQ", "RE", "NRE")


@dataclass(frozen=True)
class Matcher:
    """``type`` is EQ, NEQ, RE or NRE; the name label matches the metric."""

    type: str
    name: str
    value: str


@dataclass(frozen=True)
class Query:
    """One read: matchers and an inclusive time range in ms.

    Without a ``query_id`` a query is known by its place among those read.
    """

    start_ms: int
    end_ms: int
    matchers: tuple[Matcher, ...] = field(default_factory=tuple)
    query_id: int | None = None

    @classmethod
    def of(cls, start_ms: int, end_ms: int, *matchers: tuple[str, str, str]) -> Query:
        """Query from ``(type, name, value)`` triples."""
        return cls(start_ms, end_ms, tuple(Matcher(*m) for m in matchers))


@dataclass(frozen=True)
class Options:
    """Regexes match anywhere unless ``anchored``; ``promql`` lets a not-equal
    matcher keep series that lack the label."""

    anchored: bool = False
    promql: bool = False


@dataclass(frozen=True)
class Predicate:
    """``metric`` needs only the metric column, ``labels`` needs the tags."""

    metric: Column
    labels: Column


def matcher_predicate(
    spark: SparkSession, matchers: Iterable[Matcher], options: Options = Options()
) -> Predicate:
    """Predicates of a conjunction of matchers; raises ``ValueError`` if unfit.

    One matcher on the name is needed and it must not be empty; of several the
    last counts. Matchers on the same label all apply.
    """
    metric: Column | None = None
    labels: list[Column] = []
    for m in matchers:
        if m.type not in TYPES:
            raise ValueError(f"unknown matcher type {m.type!r}")
        if m.name != fixed.NAME_LABEL:
            labels.append(_label(spark, m, options))
        elif not m.value:
            raise ValueError(f"empty metric name in a matcher of type {m.type}")
        else:
            metric = _metric(spark, m, options)
    if metric is None:
        raise ValueError("no matcher on the metric name")
    return Predicate(metric, reduce(and_, labels, F.lit(True)))


def _metric(spark: SparkSession, m: Matcher, options: Options) -> Column:
    metric = F.col("metric")
    if m.type in ("EQ", "NEQ"):
        stored = escape_metric(F.lit(m.value))
        return metric == stored if m.type == "EQ" else metric != stored
    hit = metric.rlike(checked_regex(spark, m.value, options.anchored))
    return hit if m.type == "RE" else ~hit


def _label(spark: SparkSession, m: Matcher, options: Options) -> Column:
    value = F.try_element_at(F.col("labels"), F.lit(m.name.lower()))
    or_empty = F.coalesce(value, F.lit(""))
    if m.type == "EQ":
        return value == m.value if m.value else or_empty == ""
    if m.type == "NEQ":
        return (or_empty if options.promql else value) != m.value
    hit = or_empty.rlike(checked_regex(spark, m.value, options.anchored))
    return hit if m.type == "RE" else ~hit
