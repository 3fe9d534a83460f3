"""What a row of agent input and a stored point cost: narrow rows, one number to sort by."""

import duckdb
from pyspark.sql import functions as F, types

import build
from metricloom.operators import agent
from metricloom.plans import tables as T
from metricloom.sources.lake import Lake
from metricloom.streaming.ingest import ingest_batch

BATCH = (
    '{"metrics":[{"name":"Disk","tags":{"Zone":"%s","srcip":"x"},'
    '"fields":{"used":%s,"state":"ok","up":true},"timestamp":%d}]}'
)


def test_a_field_row_holds_no_array_and_a_series_still_has_its_tags(spark):
    long = "é" * 40
    rows = agent.identify_fields(agent.explode_metrics(build.batches(spark, BATCH % (long, "1.5", 7))))
    nested = (types.ArrayType, types.MapType, types.StructType)
    assert not [f.name for f in rows.schema if isinstance(f.dataType, nested)]
    batch = agent.batch_of(rows)
    found = {r["kind"]: r["labels"] for r in batch.series.collect()}
    tags = {"zone": "é" * 29, "srcip": "10.0.0.1"}
    assert found == {"double": tags | {"field": "used"}, "string": tags | {"field": "state"}}
    (refused,) = batch.rejected.collect()
    assert refused["payload"] == (
        '{"name":"Disk","tags":{"zone":"%s","srcip":"10.0.0.1"},"field":"up","value":"true","timestamp":7}' % ("é" * 29)
    )


def test_points_are_in_time_order_by_one_number(spark, root):
    names = ("Disk", "Cpu", "Net")
    times = [86_400_000 * 40 * (i % 3) + (i * 7919) % 1000 for i in range(300)] + [-62_135_596_800_000, 253_402_300_799_999]
    lines = [BATCH.replace("Disk", names[i % 3]) % (f"z{i % 5}", i, ms) for i, ms in enumerate(times)]
    for grain in ("day", "month"):
        lake = Lake(spark, f"{root}/{grain}", grain=grain)
        ingest_batch(lake, build.batches(spark, *lines), "agent", batch_id=0)
        files = lake.points().select(F.input_file_name().alias("f")).distinct().collect()
        stored = []
        for (path,) in files:
            con = duckdb.connect()
            found = [r[0] for r in con.sql(
                f"SELECT epoch_ms(ts) FROM read_parquet('{path.removeprefix('file://')}', hive_partitioning=false)").fetchall()]
            assert found == sorted(found)
            stored += found
        assert sorted(stored) == sorted(times)
    batch = agent.normalise_batches(build.batches(spark, *lines))
    written = []
    keep = Lake._write
    try:
        Lake._write = lambda self, out, place, dirs: written.append(out)
        Lake(spark, root)._write_points(batch.points, "samples")
    finally:
        Lake._write = keep
    plan = written[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Sort [") == 2


def test_a_table_of_many_pieces_is_not_dealt_out_again(spark, root):
    cores = spark.sparkContext.defaultParallelism
    spark.range(cores * 100).repartition(cores).write.parquet(f"{root}/many.parquet")
    spark.range(100).coalesce(1).write.parquet(f"{root}/one.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        many, one = (T.table(spark, root, name)._jdf.queryExecution().optimizedPlan().toString() for name in ("many", "one"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert "Repartition" not in many and "Repartition" in one
