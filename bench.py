"""Headline timings as one JSON line.

Each query runs over whole tables into the ``noop`` sink: once to warm up,
then ``BENCH_RUNS`` times, and the median counts. Plan building is part of
the time, and so are the writes of queries that ingest.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from metricloom.plans import normalising, reading, tables
from metricloom.session import local_session

HEADLINE = (
    "rw_points",
    "series_register",
    "tag_schema",
    "agent_names",
    "agent_fields",
    "agent_numeric",
    "agent_series",
    "list_metrics",
    "describe_metric",
    "scan_metric",
    "wide_view",
    "read_name_eq",
    "read_name_re",
    "read_label_re",
    "read_range",
    "read_select",
    "read_series",
    "read_multi",
    "log_replay",
    "stream_ingest",
)


def _timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(
        cpus, int(cpus) if cpus.isdigit() else 8, **{"spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    every = {**normalising.QUERIES, **reading.QUERIES}

    def run(name: str) -> None:
        every[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    tables.lake_of(spark, sf_dir)
    seconds = {"ingest_lake": _timed(lambda: tables.build_lake(spark, sf_dir))}
    for name in HEADLINE:
        run(name)
        seconds[name] = statistics.median(_timed(lambda: run(name)) for _ in range(runs))
    lake = tables.lake_of(spark, sf_dir)
    points = lake.points().count() + lake.points("string").count()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "points_stored": points,
                "ingest_points_per_sec": round(points / seconds["ingest_lake"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
