"""The driver's tables as metric input, and a lake built from them.

``events`` become remote-write requests, ``orders`` and ``lineitem`` become
agent batches in JSON text, row by row: nothing is grouped to make input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from metricloom.config import IngestOptions
from metricloom.functions import labels as L
from metricloom.session import work_dir
from metricloom.sources.agent import parse_agent_batches
from metricloom.sources.lake import Lake
from metricloom.sources.remote import SERIES_ARRAY
from metricloom.streaming.ingest import ingest_batch

MID = "2024-01-16 00:00:00"
CREATED_AT = "2024-02-01 00:00:00"
EVENT_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)

_lakes: dict[tuple[str, str], Lake] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, dealt out to all cores when it is read in fewer pieces than there are."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    pieces = rows._jdf.queryExecution().toRdd().getNumPartitions()
    return rows if pieces >= cores else rows.repartition(cores)


def _label(name: str, value: Column) -> Column:
    return L.pair(F.lit(name), value)


def _text(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def millis(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def with_labels(events: DataFrame) -> DataFrame:
    """Events with ``ms``, ``k`` and their label list; some lack ``tier``."""
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    tier = (
        F.when(F.col("k") % 4 == 1, F.lit(""))
        .when(F.col("k") % 4 == 2, F.lit("x"))
        .when(F.col("k") % 4 == 3, F.lit('y"q'))
    )
    base = F.array(
        _label("__name__", F.concat(F.lit("app:"), "event_type")),
        _label("User", _text("u", F.col("user_id") % 100)),
        _label("Zone", _text("zone-", F.col("user_id") % 8)),
    )
    return events.withColumns({"ms": millis("ts"), "k": k}).withColumn(
        "labels",
        F.when(F.col("k") % 4 == 0, base).otherwise(
            F.concat(base, F.array(_label("tier", tier)))
        ),
    )


def sample(value: Column, ms: Column) -> Column:
    return F.struct(value.alias("value"), ms.alias("timestamp"))


def as_requests(labelled: DataFrame, *samples: Column) -> DataFrame:
    """One request per labelled event, holding one series with ``samples``."""
    samples = samples or (sample(F.col("value"), F.col("ms")),)
    series = F.struct(F.col("labels"), F.array(*samples).alias("samples"))
    return labelled.select(F.array(series).cast(SERIES_ARRAY).alias("timeseries"))


def event_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_requests(with_labels(table(spark, sf_dir, "events")))


def _payload(name: str, tags: Column, fields: Column, ms: Column) -> Column:
    metric = F.struct(
        F.lit(name).alias("name"),
        tags.alias("tags"),
        fields.alias("fields"),
        ms.alias("timestamp"),
    )
    return F.to_json(F.struct(F.array(metric).alias("metrics")))


def order_batches(orders: DataFrame) -> DataFrame:
    """Agent batches of orders: a number, a text and a field of a bad type."""
    tags = F.create_map(
        F.lit("Priority"), "o_orderpriority",
        F.lit("user"), _text("c", F.col("o_custkey") % 50),
    )
    fields = F.struct(
        F.col("o_totalprice").alias("totalprice"),
        F.col("o_orderstatus").alias("orderstatus"),
        F.col("o_orderpriority").startswith("1").alias("urgent"),
    )
    payloads = orders.select(
        _text("10.0.0.", F.col("o_custkey") % 16).alias("srcip"),
        _payload("Order", tags, fields, millis("o_orderdate")).alias("payload"),
    )
    return parse_agent_batches(payloads, "payload")


def line_batches(lineitem: DataFrame) -> DataFrame:
    """Agent batches of line items: four numeric fields."""
    tags = F.create_map(
        F.lit("Return-Flag"), "l_returnflag", F.lit("status"), "l_linestatus"
    )
    fields = F.struct(
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("extendedprice"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
    )
    payloads = lineitem.select(
        _text("10.0.0.", F.col("l_suppkey") % 16).alias("srcip"),
        _payload("Line.Item", tags, fields, millis("l_shipdate")).alias("payload"),
    )
    return parse_agent_batches(payloads, "payload")


def agent_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_batches(table(spark, sf_dir, "orders")).unionByName(
        line_batches(table(spark, sf_dir, "lineitem"))
    )


def build_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """New lake of all events, orders and line items.

    Remote input goes in as two batches, earlier and later events, so the
    second one meets registered series.
    """
    lake = Lake(spark, work_dir(spark, "lake"), grain="month")
    created = F.lit(CREATED_AT).cast("timestamp")
    events = with_labels(table(spark, sf_dir, "events"))
    early = F.col("ts") < F.lit(MID).cast("timestamp_ntz")
    for batch_id, part in enumerate((early, ~early)):
        ingest_batch(
            lake,
            as_requests(events.where(part)),
            batch_id=batch_id,
            created_at=created,
        )
    ingest_batch(
        lake,
        agent_batches(spark, sf_dir),
        "agent",
        options=IngestOptions.for_agent(),
        created_at=created,
    )
    return lake


def lake_of(spark: SparkSession, sf_dir: str) -> Lake:
    """The lake of ``sf_dir``, built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _lakes:
        _lakes[key] = build_lake(spark, sf_dir)
    return _lakes[key]


def tag(name: str) -> Column:
    """One tag of a ``labels`` map as a column of that name."""
    return F.try_element_at("labels", F.lit(name)).alias(name)


def entry_text(entries: Column) -> Column:
    """``name=value`` list of an array of label pairs."""
    return F.array_join(
        F.transform(entries, lambda p: F.concat(p["name"], F.lit("="), p["value"])), ","
    )


# The same mapping in SQL, for the oracles.
EVENTS_SQL = """
k AS (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k,
             epoch_us(ts) // 1000 AS ms FROM events),
e AS (SELECT event_id, ts, ms, value, event_type, k,
             'app:' || event_type AS metric_raw, 'app_' || event_type AS metric,
             'u' || (user_id % 100) AS "user", 'zone-' || (user_id % 8) AS zone,
             CASE k % 4 WHEN 1 THEN '' WHEN 2 THEN 'x' WHEN 3 THEN 'y"q' END AS raw_tier,
             CASE k % 4 WHEN 1 THEN '' WHEN 2 THEN 'x' WHEN 3 THEN 'y''q' END AS tier
      FROM k)
"""

AGENT_SQL = """
o AS (SELECT epoch_us(o_orderdate) // 1000 AS ms, '10.0.0.' || (o_custkey % 16) AS srcip,
             o_orderpriority AS priority, 'c' || (o_custkey % 50) AS usr,
             o_totalprice, o_orderstatus, o_orderpriority LIKE '1%' AS urgent
      FROM orders),
l AS (SELECT epoch_us(l_shipdate) // 1000 AS ms, '10.0.0.' || (l_suppkey % 16) AS srcip,
             l_returnflag AS flag, l_linestatus AS status,
             l_quantity, l_extendedprice, l_discount, l_tax
      FROM lineitem),
f AS (SELECT 'Order' AS name, '_order' AS metric, ms, srcip, array_to_string(list_sort([priority, usr]), '') AS vals,
             'totalprice' AS field, o_totalprice AS num, NULL AS txt, 'double' AS kind FROM o
      UNION ALL
      SELECT 'Order', '_order', ms, srcip, array_to_string(list_sort([priority, usr]), ''),
             'orderstatus', NULL, o_orderstatus, 'string' FROM o
      UNION ALL
      SELECT 'Order', '_order', ms, srcip, array_to_string(list_sort([priority, usr]), ''),
             'urgent', NULL, CAST(urgent AS VARCHAR), NULL FROM o
      UNION ALL
      SELECT 'Line.Item', 'line_item', ms, srcip, array_to_string(list_sort([flag, status]), ''),
             'quantity', l_quantity, NULL, 'double' FROM l
      UNION ALL
      SELECT 'Line.Item', 'line_item', ms, srcip, array_to_string(list_sort([flag, status]), ''),
             'extendedprice', l_extendedprice, NULL, 'double' FROM l
      UNION ALL
      SELECT 'Line.Item', 'line_item', ms, srcip, array_to_string(list_sort([flag, status]), ''),
             'discount', l_discount, NULL, 'double' FROM l
      UNION ALL
      SELECT 'Line.Item', 'line_item', ms, srcip, array_to_string(list_sort([flag, status]), ''),
             'tax', l_tax, NULL, 'double' FROM l)
"""


def cut_sql(expr: str, limit: int) -> str:
    """SQL for the longest run of whole characters of at most ``limit`` bytes."""
    return (
        f"CASE WHEN strlen({expr}) <= {limit} THEN {expr} ELSE left({expr}, "
        f"len(list_filter(range(1, {limit + 1}), "
        f"lambda n: strlen(left({expr}, n)) <= {limit}))::BIGINT) END"
    )
