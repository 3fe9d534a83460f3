"""The stored lake: points, text points, series and rejects as Parquet.

::

    samples/stream=S/batch_id=N/period=D/metric=M/      series_key, ts, value DOUBLE
    samples_str/stream=S/batch_id=N/period=D/metric=M/  series_key, ts, value STRING
    series/stream=S/batch_id=N/bucket=B/                one row per new series
    catalogue/stream=S/batch_id=N/                      counts of the new series and their tags
    rejected/stream=S/batch_id=N/                       source, reason, payload
    _claims/stream=S/N                                  whose batch it is

A batch owns its directory in each table and always overwrites it whole, so a
replayed batch replaces itself exactly. It is claimed before anything is
written, by a file that only one job can create, so two jobs never write one
batch. Tags are held once per series, in
``series``; a point has only its key. ``period`` is the first day of the day
or month of ``ts`` and ``metric`` the stored name, so both a name matcher and
a time range prune directories before any file is opened. ``bucket`` is a hash
of a series, so a batch looks for its series among the registered ones in the
buckets they fall into, and opens no others.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from metricloom.functions import values
from metricloom.operators.batch import Batch, SERIES_IDENTITY, catalogue_items
from metricloom.sources import files

GRAINS = ("day", "month")
LONGEST_PERIOD_DAYS = 31

# The day of year 1 on which times that can be stored begin, from 1970.
FIRST_DAY = -719_162

# A key row is about 150 bytes, so this is some 30 MB at most.
BROADCAST_SERIES = 200_000

# Buckets of registered series, part of the layout.
SERIES_BUCKETS = 64

NO_STATISTICS = {"parquet.column.statistics.enabled": "false", "parquet.size.statistics.enabled": "false"}

# Batch id of what a compaction wrote; batches written by streams start at 0.
COMPACTED = -1

_BATCH = "stream string, batch_id bigint"
_POINTS = "series_key string, ts timestamp, value {type}, " + _BATCH + ", period date, metric string"
_SERIES = (
    "source string, kind string, metric string, metric_raw string, "
    "series_key string, taghash string, labels map<string,string>, "
    "created_at timestamp, " + _BATCH + ", bucket int"
)
_CATALOGUE = "source string, metric string, what string, item string, n bigint, created_at timestamp, " + _BATCH
_REJECTED = "source string, reason string, payload string, " + _BATCH


@dataclass(frozen=True)
class Lake:
    """A lake rooted at a path; ``grain`` is the period new points go to."""

    spark: SparkSession
    root: str
    grain: str = "day"

    def __post_init__(self) -> None:
        if self.grain not in GRAINS:
            raise ValueError(f"grain must be one of {GRAINS}, not {self.grain!r}")

    def points(self, kind: str = values.NUMBER) -> DataFrame:
        """Numeric points, or text points with ``kind="string"``."""
        if kind not in (values.NUMBER, values.TEXT):
            raise ValueError(f"no points of kind {kind!r}")
        table = "samples" if kind == values.NUMBER else "samples_str"
        return self._read(table, _POINTS.format(type=kind))

    def series(self) -> DataFrame:
        """Every registered series with its tags."""
        return self._read("series", _SERIES).drop("bucket")

    def catalogue(self) -> DataFrame:
        """What each batch added to the catalogue, see ``batch.catalogue_items``."""
        return self._read("catalogue", _CATALOGUE)

    def known_series(self, stream: str, before: int, series: DataFrame) -> DataFrame:
        """Series that batches before ``before`` registered, in the buckets of ``series``.

        All of ``series`` that are registered are among them.
        """
        found = series.select(series_bucket().alias("bucket")).distinct().collect()
        return self._read("series", _SERIES).where(
            (F.col("stream") == stream) & (F.col("batch_id") < before) & F.col("bucket").isin([r[0] for r in found])
        )

    def rejected(self) -> DataFrame:
        """Input that could not be stored, and why."""
        return self._read("rejected", _REJECTED)

    def _read(self, table: str, schema: str) -> DataFrame:
        # The schema is given, so a metric called "123" stays a string.
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def claim(self, stream: str, batch_id: int, owner: str | None = None) -> None:
        """Make a batch ``owner``'s before it is written; ``ValueError`` if it is another's.

        Without an owner the caller answers for the batch and may replace it,
        whoever wrote it.
        """
        path = f"{self.root}/_claims/stream={stream}/{batch_id}"
        if files.create_new(self.spark, path, owner or "") or owner is None:
            return
        found = files.read_text(self.spark, path)
        if found != owner:
            raise ValueError(f"batch {batch_id} of stream {stream!r} belongs to {found or 'another job'}")

    def next_batch(self, stream: str) -> int:
        """Claim the first batch id above all of the stream, for one job alone."""
        taken = [int(n) for n in files.names(self.spark, f"{self.root}/_claims/stream={stream}") if n.lstrip("-").isdigit()]
        for table in ("samples", "samples_str", "series", "rejected"):
            found = files.names(self.spark, f"{self.root}/{table}/stream={stream}")
            taken += [int(n.partition("=")[2]) for n in found if n.startswith("batch_id=")]
        owner, batch_id = uuid.uuid4().hex, max([COMPACTED, *taken]) + 1
        while not files.create_new(self.spark, f"{self.root}/_claims/stream={stream}/{batch_id}", owner):
            batch_id += 1
        return batch_id

    def await_turn(self, stream: str, batch_id: int, patience: float = 3600) -> None:
        """Wait until the batch before this one, if claimed, has registered its series.

        Each batch waits for the one before it, so a series is never registered
        by two jobs that run at once. ``TimeoutError`` after ``patience``
        seconds: the batch in front must be run again, or given up with
        ``abandon``.
        """
        before = f"stream={stream}/batch_id={batch_id - 1}"
        until = time.monotonic() + patience
        while files.exists(self.spark, f"{self.root}/_claims/stream={stream}/{batch_id - 1}") and not files.exists(
            self.spark, f"{self.root}/series/{before}/_SUCCESS"
        ):
            if time.monotonic() > until:
                raise TimeoutError(f"batch {batch_id - 1} of stream {stream!r} is claimed and not written")
            time.sleep(0.5)

    def abandon(self, stream: str, batch_id: int) -> None:
        """Give up a claimed batch whose job is dead, with all it may have written."""
        place = f"stream={stream}/batch_id={batch_id}"
        for table in ("samples", "samples_str", "rejected", "catalogue", "series", "_staging"):
            files.remove(self.spark, f"{self.root}/{table}/{place}")
        files.remove(self.spark, f"{self.root}/_claims/stream={stream}/{batch_id}")

    def stage(self, rows: DataFrame, stream: str, batch_id: int) -> DataFrame:
        """``rows`` written to the batch's staging table and read back."""
        path = f"{self.root}/_staging/stream={stream}/batch_id={batch_id}"
        # Whole columns are read back, so nothing looks at their statistics.
        rows.write.mode("overwrite").options(**NO_STATISTICS).parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def unstage(self, stream: str, batch_id: int | None = None) -> None:
        """Remove the staging table of a batch, or all that a stream's dead jobs left."""
        place = f"{self.root}/_staging/stream={stream}"
        files.remove(self.spark, place if batch_id is None else f"{place}/batch_id={batch_id}")

    def write_batch(
        self,
        batch: Batch,
        stream: str,
        batch_id: int,
        created_at: Column | None = None,
    ) -> dict[str, int]:
        """Write all outputs of a batch and count its rows; a rerun changes nothing.

        Series go first, so no stored point ever lacks its tags. Only series
        of earlier batches count as known: a replay finds its own new ones new
        again and writes the same rows.
        """
        place = f"stream={stream}/batch_id={batch_id}"
        seen = batch.series.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            known = self.known_series(stream, batch_id, seen)
            fresh = new_series(seen, known).withColumn(
                "created_at", F.current_timestamp() if created_at is None else created_at
            )
            self._write_series(fresh, place)
            written = self.spark.read.schema(_SERIES).parquet(f"{self.root}/series/{place}")
            self._overwrite(catalogue_items(written), f"catalogue/{place}", rebalance_by=())
            self._write_points(batch.points, f"samples/{place}")
            if batch.text_points is not None:
                self._write_points(batch.text_points, f"samples_str/{place}")
            self._overwrite(batch.rejected, f"rejected/{place}", rebalance_by=())
        finally:
            seen.unpersist()
        return batch.rows.agg(
            *[count.alias(name) for name, count in batch.counts.items()]
        ).first().asDict()

    def _write_series(self, series: DataFrame, place: str) -> None:
        self._overwrite(
            series.withColumn("bucket", series_bucket()), f"series/{place}",
            ("bucket",), ("bucket", "metric", "series_key"), ("bucket",),
        )

    def _write_points(
        self, points: DataFrame, place: str, above: tuple[str, ...] = ()
    ) -> None:
        day = utc_day(F.col("ts"))
        period = F.trunc(day, "month") if self.grain == "month" else day
        dirs = [*above, "period", "metric"]
        placed = points.withColumn("period", period).hint("rebalance", *dirs).withColumn("place", _place_in_time())
        # One number in the order of directories and of time is sorted digit by
        # digit; the sort by directory then finds runs and compares few rows. The
        # filter, which all rows pass, keeps the first one from being optimised away.
        ordered = placed.sortWithinPartitions("place").where(F.monotonically_increasing_id() >= 0)
        self._write(ordered.sortWithinPartitions(*dirs, "place").drop("place"), place, tuple(dirs))

    def _overwrite(
        self,
        df: DataFrame,
        place: str,
        rebalance_by: tuple[str, ...],
        sort_by: tuple[str, ...] = (),
        partition_by: tuple[str, ...] = (),
    ) -> None:
        # Rebalancing puts rows of one directory together so files are few, and
        # lets adaptive execution split what is too big, so a hot metric is
        # written by many tasks. Time order inside a file keeps the row-group
        # ranges of ts narrow.
        out = df.hint("rebalance", *rebalance_by)
        if sort_by:
            out = out.sortWithinPartitions(*sort_by)
        self._write(out, place, partition_by)

    def _write(self, out: DataFrame, place: str, partition_by: tuple[str, ...]) -> None:
        writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.root}/{place}")


def new_series(series: DataFrame, known: DataFrame) -> DataFrame:
    """Series of a batch that no earlier batch registered.

    A batch has few series beside all that are known. When its counted keys
    fit a broadcast, the known table is only scanned and cut down to them, and
    is never shuffled; a bigger batch shuffles both sides.
    """
    keys = ["kind", "metric", "series_key"]
    seen = series.select(*keys)
    if seen.count() <= BROADCAST_SERIES:
        known = known.join(F.broadcast(seen), keys, "left_semi")
    return series.join(known.select(*keys), keys, "left_anti")


def latest(points: DataFrame) -> DataFrame:
    """Points of a lake, one for each series and time of a stream: the latest batch's.

    A batch that repeats a time itself keeps its largest value; a null counts
    as least. Rows are dealt out by series *and* time, so a hot series is no
    hot group. Batches of streams have no common order, so streams stay apart.
    """
    keys = ["stream", "metric", "series_key", "ts"]
    return (
        points.repartition(*keys).groupBy(*keys)
        .agg(F.max(F.struct("batch_id", "value")).alias("last"))
        .select(*keys, "last.batch_id", "last.value")
    )


def series_bucket() -> Column:
    """Bucket of a series."""
    return F.pmod(F.xxhash64("metric", "series_key"), F.lit(SERIES_BUCKETS)).cast("int")


def utc_day(ts: Column) -> Column:
    """UTC day of ``ts``, so a lake does not depend on the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86_400).cast("int"))


def _place_in_time() -> Column:
    """Number of a point that orders by ``period``, a hash of ``metric`` and ``ts``.

    22 bits for the day a period begins with, from year 1 to 9999, 9 for the
    hash and 32 for the time since, in ms, of a month at most. It is in order
    of time within a directory, which is all that the order of files needs.
    """
    begins = F.unix_date("period").cast("bigint")
    since = F.unix_millis("ts") - begins * 86_400_000
    return (
        F.shiftleft(begins - F.lit(FIRST_DAY), 41)
        .bitwiseOR(F.shiftleft(F.pmod(F.xxhash64("metric"), F.lit(512)), 32))
        .bitwiseOR(since)
    )


def in_period(lo: Column, hi: Column) -> Column:
    """Partition predicate that holds for every point with ``lo <= ts <= hi``.

    It reaches back one longest period, so it is right for either grain.
    """
    return F.col("period").between(
        F.date_sub(utc_day(lo), LONGEST_PERIOD_DAYS - 1), utc_day(hi)
    )


def compact(lake: Lake, target: Lake, latest_only: bool = False) -> None:
    """Rewrite a lake into a new root, each stream as its batch ``COMPACTED``.

    Streams stay apart, as a series is registered once in each, with the tags
    that stream stores. The batch comes before any that a stream writes, so
    its series count as known and no later batch overwrites it. All become one
    batch, so which of two points of a series and time came later is lost; with
    ``latest_only`` the later one alone is kept. Readers move
    over by opening ``target`` once this returns; the old root is left as it is.
    """
    if lake.root == target.root:
        raise ValueError("compact into a new root")
    own = F.lit(COMPACTED).cast("bigint").alias("batch_id")
    batch = ("stream", "batch_id")
    target._overwrite(
        lake.series().select(*SERIES_IDENTITY, "labels", "created_at", "stream", own, series_bucket().alias("bucket")),
        "series", ("stream", "bucket"), (*batch, "bucket", "metric", "series_key"), (*batch, "bucket"),
    )
    columns = ["metric", "series_key", "ts", "value", "stream"]
    for kind, table in ((values.NUMBER, "samples"), (values.TEXT, "samples_str")):
        points = lake.points(kind)
        points = (latest(points) if latest_only else points).select(*columns, own)
        target._write_points(points, table, batch)
    added = catalogue_items(target.series(), ("stream",)).withColumn("batch_id", own)
    target._overwrite(added, "catalogue", (), batch, batch)
    rejected = lake.rejected().select("source", "reason", "payload", "stream", own)
    target._overwrite(rejected, "rejected", (), batch, batch)


def ensure_namespace(spark: SparkSession, name: str) -> None:
    """Create the database ``name`` if it is missing and use it."""
    quoted = "`" + name.replace("`", "``") + "`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted}")
    spark.sql(f"USE {quoted}")
