"""Registered queries of the write paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from metricloom import fixed
from metricloom.functions import identity, labels as L, names, values
from metricloom.operators import agent, remote
from metricloom.operators.catalog import detect_new_tags, infer_tag_schema
from metricloom.plans import tables as T
from metricloom.sources.lake import new_series


def _points(points: DataFrame) -> DataFrame:
    return points.select(
        "metric", "series_key", values.to_ms(F.col("ts")).alias("ms"), "value"
    )


def _two_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests with two samples a series; every fifth second one is NaN."""
    later = F.when(F.col("k") % 5 == 0, float("nan")).otherwise(F.col("value") + 0.5)
    return T.as_requests(
        T.with_labels(T.table(spark, sf_dir, "events")),
        T.sample(F.col("value"), F.col("ms")),
        T.sample(later, F.col("ms") + 500),
    )


def rw_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = remote.normalise_requests(_two_samples(spark, sf_dir), key_mode="compat")
    return _points(batch.points)


def rw_first_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = remote.normalise_requests(
        _two_samples(spark, sf_dir), key_mode="compat", first_only=True
    )
    return _points(batch.points)


def rw_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with an odd id lose their name label, so they cannot be stored."""
    events = T.with_labels(T.table(spark, sf_dir, "events"))
    nameless = F.when(
        F.col("event_id") % 2 == 1, F.slice("labels", 2, 2)
    ).otherwise(F.col("labels"))
    batch = remote.normalise_requests(
        T.as_requests(
            events.withColumn("labels", nameless),
            T.sample(F.lit(1.5), F.col("ms")),
        )
    )
    return batch.rejected


def metric_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(
        F.lit("Shop:"), "p_type", F.lit("."), F.expr("repeat(p_name || '-', p_size)")
    )
    return T.table(spark, sf_dir, "part").select(
        "p_partkey", names.escape_metric(name).alias("metric")
    )


def _cut_text(spark: SparkSession, sf_dir: str, limit: int) -> DataFrame:
    return T.table(spark, sf_dir, "documents").select(
        "doc_id", names.truncate_bytes(F.col("text"), limit).alias("tag")
    )


def label_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cut_text(spark, sf_dir, fixed.TAG_VALUE_BYTES)


def agent_tag_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cut_text(spark, sf_dir, fixed.AGENT_TAG_VALUE_BYTES)


def quote_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.table(spark, sf_dir, "events").select(
        "event_id", L.sanitise_quotes(F.col("props")).alias("tag")
    )


def finite_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = (
        F.when(F.col("event_id") % 5 == 1, float("nan"))
        .when(F.col("event_id") % 5 == 2, float("inf"))
        .when(F.col("event_id") % 5 == 3, float("-inf"))
        .otherwise(F.col("value"))
    )
    return T.table(spark, sf_dir, "events").select(
        "event_id", values.finite_or_null(value).alias("value")
    )


def _folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        T.with_labels(T.table(spark, sf_dir, "events"))
        .withColumn("pairs", L.renamed(L.tag_pairs(F.col("labels"))))
        .withColumn("entries", L.entries(F.col("pairs")))
    )


def _keyed(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    return _folded(spark, sf_dir).select(
        "event_id",
        identity.series_key(
            L.metric_name(F.col("labels")), F.col("labels"), F.col("entries"), mode
        ).alias("series_key"),
    )


def series_key_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(spark, sf_dir, "exact")


def series_key_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(spark, sf_dir, "compat")


def tag_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folded(spark, sf_dir).select(
        "event_id",
        identity.tag_hash(F.col("pairs"), F.col("entries")).alias("taghash"),
    )


def label_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = L.stored_entries(F.col("pairs"), F.col("entries"), tag_limit=2)
    return _folded(spark, sf_dir).select(
        "event_id", T.entry_text(kept).alias("labels")
    )


def label_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    again = L.pair(F.lit("ZONE"), F.col("event_type"))
    pairs = L.renamed(F.concat(L.tag_pairs(F.col("labels")), F.array(again)))
    return (
        T.with_labels(T.table(spark, sf_dir, "events"))
        .withColumn("pairs", pairs)
        .select("event_id", T.entry_text(L.entries(F.col("pairs"))).alias("labels"))
    )


def tag_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = remote.normalise_requests(T.event_requests(spark, sf_dir)).series
    return infer_tag_schema(series).select("metric", "position", "tag")


def _series_when(events: DataFrame, part: Column) -> DataFrame:
    return remote.normalise_requests(T.as_requests(events.where(part))).series


def _early() -> Column:
    return F.col("ts") < F.lit(T.MID).cast("timestamp_ntz")


def new_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label per day of the month drifts in; later days are new tags."""
    day = L.pair(F.concat(F.lit("Day-"), F.dayofmonth("ts").cast("string")), F.lit("y"))
    drifting = T.with_labels(T.table(spark, sf_dir, "events")).withColumn(
        "labels", F.concat("labels", F.array(day))
    )
    return detect_new_tags(
        _series_when(drifting, ~_early()), _series_when(drifting, _early())
    ).select("metric", "tag")


def _series_text(series: DataFrame) -> DataFrame:
    return series.select(
        "metric",
        "metric_raw",
        "taghash",
        T.entry_text(
            L.to_label_pairs(F.col("metric"), F.col("labels"))
        ).alias("labels"),
    )


def series_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _series_text(
        remote.normalise_requests(T.event_requests(spark, sf_dir)).series
    )


def new_series_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = T.with_labels(T.table(spark, sf_dir, "events"))
    return _series_text(
        new_series(_series_when(events, ~_early()), _series_when(events, _early()))
    )


def agent_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = agent.explode_fields(agent.explode_metrics(T.agent_batches(spark, sf_dir)))
    return agent.route_fields(fields).select(
        "name", "field", "srcip", F.col("timestamp").alias("ms"), "kind"
    )


def agent_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = agent.normalise_batches(T.agent_batches(spark, sf_dir), key_mode="compat")
    return _points(batch.points)


def agent_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = agent.normalise_batches(T.agent_batches(spark, sf_dir), key_mode="compat")
    return _points(batch.text_points)


def agent_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agent.normalise_batches(T.agent_batches(spark, sf_dir)).rejected


def agent_series_key_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = agent.normalise_batches(T.agent_batches(spark, sf_dir), key_mode="compat")
    return batch.series.select("kind", "metric", "metric_raw", "series_key")


def agent_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = agent.normalise_batches(T.agent_batches(spark, sf_dir)).series
    return series.select(
        "kind", "metric", T.entry_text(
            F.sort_array(F.map_entries("labels")).cast(L.PAIRS)
        ).alias("labels"),
    )


def agent_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = (
        T.table(spark, sf_dir, "documents")
        .select(F.explode(F.split("text", " ")).alias("word"))
        .distinct()
    )
    return words.select(
        "word",
        names.escape_agent_table(F.col("word")).alias("table_name"),
        names.escape_agent_tags(F.array("word"))[0].alias("tag_name"),
    )


def agent_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = agent.normalise_batches(T.agent_batches(spark, sf_dir)).series
    return infer_tag_schema(series).select("metric", "kind", "position", "tag")


def agent_batch_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = agent.batch_groups(agent.explode_metrics(T.agent_batches(spark, sf_dir)))
    return groups.select(
        values.to_ms(F.col("ts")).alias("ms"), "name", "metrics", "fields"
    ).orderBy("ms", "name")


QUERIES = {
    "rw_points": rw_points,
    "rw_first_sample": rw_first_sample,
    "rw_rejected": rw_rejected,
    "metric_escape": metric_escape,
    "label_truncate": label_truncate,
    "agent_tag_truncate": agent_tag_truncate,
    "quote_sanitise": quote_sanitise,
    "finite_or_null": finite_or_null,
    "series_key_exact": series_key_exact,
    "series_key_compat": series_key_compat,
    "tag_hash": tag_hash,
    "label_cap": label_cap,
    "label_fold": label_fold,
    "tag_schema": tag_schema,
    "new_tags": new_tags,
    "series_register": series_register,
    "new_series": new_series_found,
    "agent_fields": agent_fields,
    "agent_numeric": agent_numeric,
    "agent_text": agent_text,
    "agent_rejected": agent_rejected,
    "agent_series_key_compat": agent_series_key_compat,
    "agent_series": agent_series,
    "agent_names": agent_names,
    "agent_schema": agent_schema,
    "agent_batch_groups": agent_batch_groups,
}

_E = "WITH " + T.EVENTS_SQL
_A = "WITH " + T.AGENT_SQL
_COMPAT = "'MD5_' || md5(metric_raw || \"user\" || zone || coalesce(raw_tier, ''))"
_TAGHASH = "md5(coalesce(raw_tier, '') || \"user\" || zone)"
_LABELS = (
    "'__name__=' || metric || coalesce(',tier=' || tier, '') "
    "|| ',user=' || \"user\" || ',zone=' || zone"
)
_SERIES = f"SELECT DISTINCT metric, metric_raw, {_TAGHASH} AS taghash, {_LABELS} AS labels FROM e"
_AGENT_KEY = "'MD5_' || md5(name || vals || srcip || field)"
_PLAIN = "translate(lower(word), ':.-', '___')"
_ESCAPED = (
    f"CASE WHEN {_PLAIN} = '' THEN '__' "
    f"WHEN regexp_matches({_PLAIN}, '^\\p{{Nd}}') OR {_PLAIN} IN ("
    + ", ".join(f"'{w}'" for w in fixed.RESERVED_WORDS)
    + f") THEN '_' || {_PLAIN} ELSE {_PLAIN} END"
)
_SHOP = "translate('Shop:' || p_type || '.' || repeat(p_name || '-', p_size), ':.-', '___')"

ORACLES = {
    "rw_points": f"""{_E}
        SELECT metric, {_COMPAT} AS series_key, ms, value FROM e
        UNION ALL
        SELECT metric, {_COMPAT}, ms + 500, CASE WHEN k % 5 <> 0 THEN value + 0.5 END FROM e""",
    "rw_first_sample": f"{_E} SELECT metric, {_COMPAT} AS series_key, ms, value FROM e",
    "rw_rejected": f"""{_E}
        SELECT 'remote' AS source, 'missing_name' AS reason,
               '{{"labels":[{{"name":"User","value":"' || "user" || '"}},{{"name":"Zone","value":"' || zone
               || '"}}],"samples":[{{"value":1.5,"timestamp":' || ms || '}}]}}' AS payload
        FROM e WHERE event_id % 2 = 1""",
    "metric_escape": f"SELECT p_partkey, left({_SHOP}, 190) AS metric FROM part",
    "label_truncate": f"SELECT doc_id, {T.cut_sql('text', 128)} AS tag FROM documents",
    "agent_tag_truncate": f"SELECT doc_id, {T.cut_sql('text', 59)} AS tag FROM documents",
    "quote_sanitise": "SELECT event_id, replace(props, '\"', '''') AS tag FROM events",
    "finite_or_null": """
        WITH v AS (SELECT event_id, CASE event_id % 5 WHEN 1 THEN 'nan'::DOUBLE
                   WHEN 2 THEN 'inf'::DOUBLE WHEN 3 THEN '-inf'::DOUBLE ELSE value END AS v FROM events)
        SELECT event_id, CASE WHEN isfinite(v) THEN v END AS value FROM v""",
    "series_key_exact": f"""{_E}
        SELECT event_id, md5('{{"metric":"' || metric_raw || '","labels":['
            || coalesce('{{"name":"tier","value":"' || replace(raw_tier, '"', '\\"') || '"}},', '')
            || '{{"name":"user","value":"' || "user" || '"}},{{"name":"zone","value":"' || zone || '"}}]}}') AS series_key
        FROM e""",
    "series_key_compat": f"{_E} SELECT event_id, {_COMPAT} AS series_key FROM e",
    "tag_hash": f"{_E} SELECT event_id, {_TAGHASH} AS taghash FROM e",
    "label_cap": f"""{_E} SELECT event_id, 'user=' || "user" || ',zone=' || zone AS labels FROM e""",
    "label_fold": f"""{_E}
        SELECT event_id, coalesce('tier=' || raw_tier || ',', '') || 'user=' || "user"
               || ',zone=' || event_type AS labels FROM e""",
    "tag_schema": f"""{_E},
        t AS (SELECT metric, 'user' AS tag FROM e UNION SELECT metric, 'zone' FROM e
              UNION SELECT metric, 'tier' FROM e WHERE tier IS NOT NULL)
        SELECT metric, CAST(row_number() OVER (PARTITION BY metric ORDER BY tag) AS INTEGER) AS position, tag
        FROM t""",
    "new_tags": f"""{_E},
        t AS (SELECT metric, 'user' AS tag, ts FROM e UNION ALL SELECT metric, 'zone', ts FROM e
              UNION ALL SELECT metric, 'tier', ts FROM e WHERE tier IS NOT NULL
              UNION ALL SELECT metric, 'day-' || day(ts), ts FROM e)
        SELECT metric, tag FROM t WHERE ts >= TIMESTAMP '{T.MID}'
        EXCEPT SELECT metric, tag FROM t WHERE ts < TIMESTAMP '{T.MID}'""",
    "series_register": f"{_E} {_SERIES}",
    "new_series": f"""{_E} {_SERIES} WHERE ts >= TIMESTAMP '{T.MID}'
        EXCEPT {_SERIES} WHERE ts < TIMESTAMP '{T.MID}'""",
    "agent_fields": f"{_A} SELECT name, field, srcip, ms, kind FROM f",
    "agent_numeric": f"""{_A}
        SELECT metric, {_AGENT_KEY} AS series_key, ms, num AS value FROM f WHERE kind = 'double'""",
    "agent_text": f"""{_A}
        SELECT metric, {_AGENT_KEY} AS series_key, ms, txt AS value FROM f WHERE kind = 'string'""",
    "agent_rejected": f"""{_A}
        SELECT 'agent' AS source, 'field_type' AS reason,
               '{{"name":"Order","tags":{{"_user":"' || usr || '","priority":"' || priority
               || '","srcip":"' || srcip || '"}},"field":"urgent","value":"' || urgent || '","timestamp":' || ms || '}}' AS payload
        FROM o""",
    "agent_series_key_compat": f"""{_A}
        SELECT DISTINCT kind, metric, name AS metric_raw, {_AGENT_KEY} AS series_key
        FROM f WHERE kind IS NOT NULL""",
    "agent_series": f"""{_A}
        SELECT DISTINCT CASE x WHEN 'orderstatus' THEN 'string' ELSE 'double' END AS kind, '_order' AS metric,
               '_user=' || usr || ',field=' || x || ',priority=' || priority || ',srcip=' || srcip AS labels
        FROM o, (VALUES ('totalprice'), ('orderstatus')) AS n(x)
        UNION
        SELECT DISTINCT 'double', 'line_item',
               'field=' || x || ',return_flag=' || flag || ',srcip=' || srcip || ',status=' || status
        FROM l, (VALUES ('quantity'), ('extendedprice'), ('discount'), ('tax')) AS n(x)""",
    "agent_names": f"""
        WITH w AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM documents),
        x AS (SELECT word, {_ESCAPED} AS escaped FROM w)
        SELECT word, {T.cut_sql('escaped', 160)} AS table_name, {T.cut_sql('escaped', 64)} AS tag_name
        FROM x""",
    "agent_schema": """
        WITH t(metric, position, tag) AS (VALUES
            ('_order', 1, '_user'), ('_order', 2, 'priority'), ('_order', 3, 'srcip'), ('_order', 4, 'field'),
            ('line_item', 1, 'return_flag'), ('line_item', 2, 'status'), ('line_item', 3, 'srcip'),
            ('line_item', 4, 'field')),
        present AS (SELECT '_order' AS metric FROM orders UNION SELECT 'line_item' FROM lineitem)
        SELECT t.metric || suffix AS metric, kind, position, tag
        FROM t JOIN present USING (metric), (VALUES ('', 'double'), ('_str', 'string')) AS k(suffix, kind)""",
    "agent_batch_groups": f"""{_A}
        SELECT ms, name, count(*) // max(n) AS metrics, count(*) AS fields
        FROM (SELECT *, CASE name WHEN 'Order' THEN 3 ELSE 4 END AS n FROM f)
        GROUP BY ms, name""",
}
