"""Silver layer: parse, key, cast and de-duplicate bronze rows.

FLT-1 required fields, FLT-2 look-back, PRJ-4 ISO parse, PRJ-9 date/hour,
PRJ-10 casts, PRJ-11 surrogate key, WIN-1/WIN-2 keep-first, FLT-6 rnk = 1.

Times parse leniently (offset optional, none means UTC), as the batch SQL
of the source does; a row whose time is not ISO-8601 at all gets no silver
row (the source's query would fail on it; the live job quarantines such
lines before bronze).

De-duplication is ``row_number() = 1`` over the natural key.  Spark turns it
into a WindowGroupLimit that keeps one row per key *before* the shuffle
as well as after it, so exact copies cost no network.  The key includes the
event timestamp, so a device with many readings spreads over all tasks.
The reference's order key is constant inside a key (any survivor); ours is
content based (greatest measures first) so re-runs pick the same row
whatever the file order.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomlake.functions.columns import (iso_timestamp, lookback_cutoff, surrogate_key,
                                        ts_literal, utc_date, utc_hour)
from roomlake.schemas import MEASURES

READING_KEY = ["device_id", "event_ts"]
READING_ORDER = [*MEASURES, "occupancy"]
ALERT_KEY = ["user_id", "device_id", "rule", "severity", "alert_ts"]

SILVER_READING_COLUMNS = ["pk_sensor_event_id", "event_ts", "event_date", "event_hour",
                          "device_id", *MEASURES, "occupancy", "rnk"]
SILVER_ALERT_COLUMNS = ["pk_alert_event_id", "alert_ts", "alert_date", "alert_hour",
                        "user_id", "device_id", "rule", "severity", "metric",
                        "observed_value", "threshold_value", "window_start_ms",
                        "window_end_ms", "rnk"]


def _cutoff(now, lookback_hours, cutoff):
    if cutoff is not None:
        return cutoff
    if now is None:
        raise ValueError("incremental runs need 'now' or an explicit cutoff")
    return lookback_cutoff(now, lookback_hours)


def _keep_first(df: DataFrame, key: list[str], order_cols: list[str]) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() for c in order_cols])
    return (df.withColumn("rnk", F.row_number().over(w).cast("bigint"))
              .where(F.col("rnk") == 1))


def readings_to_keep(bronze: DataFrame) -> DataFrame:
    """Typed readings (event_ts, device_id, measures) with a device and a time that parses (FLT-1)."""
    if "event_ts" in bronze.columns:
        ts = F.col("event_ts").cast("timestamp")
        has_time = F.col("event_ts").isNotNull()
    else:
        ts = iso_timestamp("event_time")
        has_time = F.col("event_time").isNotNull()
    return (bronze.where(F.col("device_id").isNotNull() & has_time)
                  .select(ts.alias("event_ts"), "device_id",
                          *[F.col(m).cast("double").alias(m) for m in MEASURES],
                          F.col("occupancy").cast("int").alias("occupancy"))
                  .where(F.col("event_ts").isNotNull()))   # unparseable time: no silver row


def silver_readings(bronze: DataFrame, now: _dt.datetime | None = None,
                    lookback_hours: int = 2, incremental: bool = False,
                    cutoff: _dt.datetime | None = None) -> DataFrame:
    """Bronze readings (event_time string, or event_ts timestamp) -> silver rows.

    ``incremental`` applies the look-back filter ``event_ts >= date_trunc('hour',
    now - lookback)``; a first run / full refresh reads everything.
    """
    base = readings_to_keep(bronze)
    if incremental:
        base = base.where(F.col("event_ts") >= ts_literal(_cutoff(now, lookback_hours, cutoff)))
    # keys, dates and hours are made of the rows that stay
    first = _keep_first(base, READING_KEY, READING_ORDER)
    return first.select(
        surrogate_key(base, READING_KEY).alias("pk_sensor_event_id"),
        "event_ts",
        utc_date("event_ts").alias("event_date"),
        utc_hour("event_ts").alias("event_hour"),
        "device_id", *MEASURES, "occupancy", "rnk").select(*SILVER_READING_COLUMNS)


def silver_alerts(bronze: DataFrame, now: _dt.datetime | None = None,
                  lookback_hours: int = 2, incremental: bool = False,
                  cutoff: _dt.datetime | None = None) -> DataFrame:
    """Bronze alerts (alert_time string) -> silver alert rows."""
    if "alert_ts" in bronze.columns:
        ts = F.col("alert_ts").cast("timestamp")
        has_time = F.col("alert_ts").isNotNull()
    else:
        ts = iso_timestamp("alert_time")
        has_time = F.col("alert_time").isNotNull()
    base = (bronze.where(has_time & F.col("device_id").isNotNull() & ts.isNotNull())
                  .select(ts.alias("alert_ts"), "user_id", "device_id", "rule", "severity",
                          "metric",
                          F.col("observed_value").cast("double").alias("observed_value"),
                          F.col("threshold_value").cast("double").alias("threshold_value"),
                          F.col("window_start_ms").cast("bigint").alias("window_start_ms"),
                          F.col("window_end_ms").cast("bigint").alias("window_end_ms")))
    if incremental:
        base = base.where(F.col("alert_ts") >= ts_literal(_cutoff(now, lookback_hours, cutoff)))
    order = ["window_end_ms", "window_start_ms", "observed_value", "threshold_value", "metric"]
    first = _keep_first(base, ALERT_KEY, order)
    return first.select(
        surrogate_key(base, ALERT_KEY).alias("pk_alert_event_id"),
        "alert_ts",
        utc_date("alert_ts").alias("alert_date"),
        utc_hour("alert_ts").alias("alert_hour"),
        "user_id", "device_id", "rule", "severity", "metric", "observed_value",
        "threshold_value", "window_start_ms", "window_end_ms", "rnk").select(*SILVER_ALERT_COLUMNS)
