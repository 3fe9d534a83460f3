"""Continuous ingest: a stream of requests or batches into a lake.

Known series and known tags are state, and the lake's ``series`` table is
where they live, so nothing unbounded is held in memory. Points of any age
are appended, hence no watermark. Each micro-batch overwrites its own
directories, so a batch that is run again after a failure replaces itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from metricloom.config import IngestOptions
from metricloom.operators import agent, remote
from metricloom.sources import files
from metricloom.sources.agent import read_agent_batches
from metricloom.sources.lake import Lake
from metricloom.sources.remote import read_write_requests

Report = Callable[[int, dict[str, int]], Any]


def identify(source: str, rows: DataFrame, options: IngestOptions) -> DataFrame:
    """Named, keyed and typed rows of input from ``remote`` or ``agent``."""
    if source == remote.SOURCE:
        return remote.identify_series(
            rows, options.key_mode, options.tag_bytes, options.tag_limit
        )
    if source == agent.SOURCE:
        return agent.identify_fields(agent.explode_metrics(rows), options.key_mode)
    raise ValueError(f"unknown source {source!r}")


def ingest_batch(
    lake: Lake,
    rows: DataFrame,
    source: str = remote.SOURCE,
    batch_id: int | None = None,
    options: IngestOptions = IngestOptions(),
    stream: str | None = None,
    created_at: Column | None = None,
    owner: str | None = None,
) -> dict[str, int]:
    """Ingest one bounded set of requests or batches as batch ``batch_id``.

    Without a ``batch_id`` it is the stream's next free one, claimed for this
    call, so jobs that run once each append, also at the same time; give one to
    replace a batch by running it again. With an ``owner`` the batch must be
    new or the owner's.

    Parsing and keying are most of the work, and up to four tables are written
    from their result. It is staged as a Parquet table beside the lake's, so
    the input is parsed once, no executor has to hold it, and a lost executor
    costs a re-read. The stage is removed when the batch is written or has failed.
    """
    stream = stream or source
    if batch_id is None:
        batch_id = lake.next_batch(stream)
    else:
        lake.claim(stream, batch_id, owner)
    if options.input_tasks:
        rows = rows.repartition(options.input_tasks)
    identified = identify(source, rows, options)
    try:
        staged = lake.stage(identified, stream, batch_id)
        if source == remote.SOURCE:
            batch = remote.batch_of(staged, options.key_mode, options.first_only)
        else:
            batch = agent.batch_of(staged, options.key_mode)
        lake.await_turn(stream, batch_id)
        return lake.write_batch(batch, stream, batch_id, created_at)
    finally:
        lake.unstage(stream, batch_id)


def follow(
    spark: SparkSession,
    path: str,
    source: str = remote.SOURCE,
    options: IngestOptions = IngestOptions(),
) -> DataFrame:
    """Streaming JSON input under ``path``, ``batch_size`` files a micro-batch."""
    readers = {
        remote.SOURCE: read_write_requests,
        agent.SOURCE: read_agent_batches,
    }
    if source not in readers:
        raise ValueError(f"unknown source {source!r}")
    return readers[source](
        spark, path, streaming=True, maxFilesPerTrigger=str(options.batch_size)
    )


def owner_of(spark: SparkSession, checkpoint: str) -> str:
    """The mark of a checkpoint's folder, made when it is first used."""
    path = f"{checkpoint.rstrip('/')}/lake-owner"
    mark = uuid.uuid4().hex
    return mark if files.create_new(spark, path, mark) else files.read_text(spark, path)


def start_ingest(
    lake: Lake,
    rows: DataFrame,
    checkpoint: str,
    source: str = remote.SOURCE,
    options: IngestOptions = IngestOptions(),
    stream: str | None = None,
    trigger: dict[str, Any] | None = None,
    created_at: Column | None = None,
    report: Report | None = None,
) -> StreamingQuery:
    """Start ingesting a streaming DataFrame.

    Batch ids count per checkpoint, and a batch overwrites its own id alone. A
    mark in the checkpoint's folder says whose its batches are and is part of
    the default ``stream`` name: a checkpoint made anew, at the same path too,
    is a new stream and leaves what an earlier one wrote. Under a name of the
    caller's, a batch of another checkpoint is refused. ``report`` gets each
    batch id with its row counts.
    """
    owner = owner_of(lake.spark, checkpoint)
    if stream is None:
        stream = f"{source}-{owner[:12]}"
    lake.unstage(stream)

    def write(rows: DataFrame, batch_id: int) -> None:
        counts = ingest_batch(
            lake, rows, source, batch_id, options, stream, created_at, owner
        )
        if report is not None:
            report(batch_id, counts)

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )
