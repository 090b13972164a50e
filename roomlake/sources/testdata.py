"""Readings and threshold-config views over the driver's test tables.

The driver ships TPC-H-like parquet tables; ``events`` stands in for the
sensor stream and ``orders`` for the config changelog.  The mapping below is
only a schema adapter: it produces rows of the shapes the jobs expect and
does none of their work.

readings (from events)                    config (from orders)
  device_id   'dev_' || user_id             device_id  'dev_' || o_custkey
  event_ts    ts (UTC)                      user_id    'user_' || o_orderkey % 7
  t           epoch milliseconds            updated_at o_orderdate (seq o_orderkey)
  temperature value                         warning    20 + o_orderkey % 5
  light       props.k                       violation  warning + 20
  humidity    k / 2                         light      30
  co2         400 + k
  humidity_ratio value / 1000
  occupancy   1 for view/click, else 0
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomlake.functions.columns import iso_utc_string, utc_string

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_utc(df: DataFrame, col: str) -> Column:
    """A TIMESTAMP column as it is; a zone-less timestamp or a date read as UTC, not the session zone."""
    if df.schema[col].dataType.typeName() == "timestamp":
        return F.col(col)
    # days, and microseconds of a zone-less timestamp, counted without any zone
    day = F.unix_date(F.col(col).cast("date"))
    if df.schema[col].dataType.typeName() == "date":
        return F.timestamp_seconds(day.cast("long") * 86400)
    of_day = F.hour(col) * 3600 + F.minute(col) * 60
    micros = (F.extract(F.lit("SECOND"), F.col(col)) * 1_000_000).cast("long")
    return F.timestamp_micros((day.cast("long") * 86400 + of_day) * 1_000_000 + micros)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed sensor readings: event_id, device_id, event_ts, t, event_time, measures."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    ts = as_utc(ev, "ts")
    return ev.select(
        F.col("event_id"),
        F.concat(F.lit("dev_"), F.col("user_id").cast("string")).alias("device_id"),
        ts.alias("event_ts"),
        F.unix_millis(ts).alias("t"),
        F.concat(utc_string(ts, "T", 6), F.lit("Z")).alias("event_time"),
        F.col("value").alias("temperature"),
        (k / F.lit(2.0)).alias("humidity"),
        k.alias("light"),
        (F.lit(400.0) + k).alias("co2"),
        (F.col("value") / F.lit(1000.0)).alias("humidity_ratio"),
        F.when(F.col("event_type").isin("view", "click"), F.lit(1)).otherwise(F.lit(0))
         .cast("int").alias("occupancy"),
    )


def config_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold config changelog: several updates per device; seq orders ties."""
    o = table(spark, sf_dir, "orders")
    warn = F.lit(20.0) + (F.col("o_orderkey") % 5).cast("double")
    upd = as_utc(o, "o_orderdate")
    return o.select(
        F.concat(F.lit("dev_"), F.col("o_custkey").cast("string")).alias("device_id"),
        F.concat(F.lit("user_"), (F.col("o_orderkey") % 7).cast("string")).alias("user_id"),
        upd.alias("updated_ts"),
        iso_utc_string(upd).alias("updated_at"),
        F.col("o_orderkey").alias("seq"),
        warn.alias("temperature_warning_threshold"),
        (warn + F.lit(20.0)).alias("temperature_violation_threshold"),
        F.lit(30.0).alias("no_occupancy_light_threshold"),
    )


#: config changes spread over the readings' 30 days: seconds after the first of them
CHANGE_STEP, CHANGE_SPAN, CHANGE_START = 7919, 30 * 86400, 1704067200


def config_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The config updates, each at a time within the readings' period, so that a device's config changes meanwhile."""
    after = (F.col("seq") * CHANGE_STEP) % CHANGE_SPAN
    ts = F.timestamp_seconds(F.lit(CHANGE_START) + after)
    return config_updates(spark, sf_dir).withColumn("updated_ts", ts).withColumn("updated_at", iso_utc_string(ts))


# DuckDB twins of the views, used by the oracle SQL strings.
READINGS_SQL = """
SELECT event_id,
       'dev_' || CAST(user_id AS VARCHAR) AS device_id,
       ts,
       ts AS event_ts,
       epoch_us(ts) // 1000 AS t,
       value AS temperature,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) / 2.0 AS humidity,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS light,
       400.0 + CAST(json_extract_string(props, '$.k') AS DOUBLE) AS co2,
       value / 1000.0 AS humidity_ratio,
       CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END AS occupancy
FROM events
"""

CONFIG_SQL = """
SELECT 'dev_' || CAST(o_custkey AS VARCHAR) AS device_id,
       'user_' || CAST(o_orderkey % 7 AS VARCHAR) AS user_id,
       o_orderdate AS updated_ts,
       o_orderkey AS seq,
       20.0 + CAST(o_orderkey % 5 AS DOUBLE) AS temperature_warning_threshold,
       20.0 + CAST(o_orderkey % 5 AS DOUBLE) + 20.0 AS temperature_violation_threshold,
       30.0 AS no_occupancy_light_threshold
FROM orders
"""

CHANGES_SQL = f"""
SELECT * REPLACE (make_timestamp(({CHANGE_START} + (seq * {CHANGE_STEP}) % {CHANGE_SPAN}) * 1000000) AS updated_ts)
FROM ({CONFIG_SQL})
"""
