"""Command line: ingest, read, catalogue and compaction jobs.

    spark-submit --py-files metricloom.zip run.py ingest remote IN LAKE CHECKPOINT

``run.py`` only has to call ``metricloom.__main__.main``; with Spark on the
path ``python -m metricloom`` does the same.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from metricloom import fixed
from metricloom.config import IngestOptions
from metricloom.operators import agent, catalog, reads, remote
from metricloom.sources.lake import GRAINS, Lake, compact, ensure_namespace
from metricloom.sources.logreplay import read_metric_log
from metricloom.sources.remote import read_requests
from metricloom.streaming.ingest import follow, ingest_batch, start_ingest


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="metricloom")
    jobs = parser.add_subparsers(dest="job", required=True)

    ingest = jobs.add_parser("ingest", help="follow a folder of JSON input")
    ingest.add_argument("source", choices=(remote.SOURCE, agent.SOURCE))
    ingest.add_argument("input")
    ingest.add_argument("lake")
    ingest.add_argument("checkpoint")
    ingest.add_argument("--stream", help="name of this stream in the lake")
    ingest.add_argument("--once", action="store_true", help="stop when all input is read")
    ingest.add_argument("--dbname", help="database to create if it is missing")
    ingest.add_argument("--batch-size", type=int, help="files a micro-batch")
    ingest.add_argument("--tag-length", type=int, default=fixed.TAG_VALUE_BYTES)
    ingest.add_argument("--tag-num", type=int, default=fixed.TAGS_PER_SERIES)
    ingest.add_argument("--key-mode", choices=("exact", "compat"), default="exact")
    ingest.add_argument("--first-only", action="store_true")
    ingest.add_argument("--grain", choices=GRAINS, default="day")

    replay = jobs.add_parser("replay", help="ingest a metric log")
    replay.add_argument("input")
    replay.add_argument("lake")
    replay.add_argument("--stream", default="replay")
    replay.add_argument("--batch-id", type=int, help="replace this batch instead of appending")

    read = jobs.add_parser("read", help="answer read requests as nested JSON")
    read.add_argument("requests")
    read.add_argument("lake")
    read.add_argument("output")
    read.add_argument("--merge", action="store_true")

    for name, text in (("list", "list metrics"), ("describe", "describe one metric")):
        job = jobs.add_parser(name, help=text)
        job.add_argument("lake")
        job.add_argument("output")
        if name == "describe":
            job.add_argument("metric")

    move = jobs.add_parser("compact", help="rewrite a lake into a new root")
    move.add_argument("lake")
    move.add_argument("target")
    move.add_argument("--latest", action="store_true", help="of points of one series and time keep the latest batch's")
    return parser


def _ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    changes = {
        "tag_bytes": args.tag_length,
        "tag_limit": args.tag_num,
        "key_mode": args.key_mode,
        "first_only": args.first_only,
    }
    if args.batch_size:
        changes["batch_size"] = args.batch_size
    if args.dbname:
        changes["namespace"] = args.dbname
    make = IngestOptions.for_agent if args.source == agent.SOURCE else IngestOptions
    options = make(**changes)
    ensure_namespace(spark, options.namespace)
    start_ingest(
        Lake(spark, args.lake, args.grain),
        follow(spark, args.input, args.source, options),
        args.checkpoint,
        args.source,
        options,
        args.stream,
        trigger={"availableNow": True} if args.once else None,
    ).awaitTermination()


def _read(spark: SparkSession, args: argparse.Namespace) -> None:
    queries = reads.queries_of(read_requests(spark, args.requests))
    points = reads.read_many(Lake(spark, args.lake), queries, merge_queries=args.merge)
    frames = reads.series_frames(points, [] if args.merge else ["query_id"])
    reads.write_series(frames, args.output)


def _write(df: DataFrame, output: str) -> None:
    df.write.mode("overwrite").json(output)


def main(argv: list[str] | None = None) -> None:
    """Run one job on the session ``spark-submit`` provides."""
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"metricloom-{args.job}").getOrCreate()
    if args.job == "ingest":
        _ingest(spark, args)
    elif args.job == "replay":
        ingest_batch(
            Lake(spark, args.lake),
            read_metric_log(spark, args.input),
            stream=args.stream,
            batch_id=args.batch_id,
        )
    elif args.job == "read":
        _read(spark, args)
    elif args.job == "list":
        _write(catalog.list_metrics(Lake(spark, args.lake).series()), args.output)
    elif args.job == "describe":
        series = Lake(spark, args.lake).series()
        _write(catalog.describe_metric(series, args.metric), args.output)
    else:
        compact(Lake(spark, args.lake), Lake(spark, args.target), args.latest)


if __name__ == "__main__":
    main()
