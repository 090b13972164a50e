"""JOB-1: one lakehouse run -- bronze -> silver -> gold -> checks.

Steps run in order and the first failure stops the run, as the hourly job
does.  Incremental runs (target exists, no full refresh) re-process the
look-back slice ``ts >= date_trunc('hour', now - lookback)``:

* bronze folders are pruned with ``dt >= date(cutoff) - slack`` (bronze is
  bucketed by ingestion time, which is at or after event time unless a device
  clock runs ahead; ``bronze_slack_days`` covers that);
* silver rows are merged by primary key into their event-date partitions;
* gold slices from the cutoff hour on are replaced.  Both device-hour gold
  tables come from one aggregation over silver readings.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from roomlake.functions.columns import lookback_cutoff, naive_utc, to_epoch_micros, utc_date
from roomlake.operators import gold, silver, tables
from roomlake.operators.check_state import LAKE_KEYS, check_table
from roomlake.operators.checks import assert_checks, run_checks
from roomlake.schemas import TABLE_KEYS
from roomlake.sources.bronze_stats import refresh_stats
from roomlake.sources.files import read_bronze_alerts, read_bronze_readings


@dataclass
class LakePaths:
    bronze_readings: str
    bronze_alerts: str
    root: str

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


@dataclass
class RunReport:
    actions: dict = field(default_factory=dict)
    checks: list = field(default_factory=list)


def run_lakehouse(spark: SparkSession, paths: LakePaths, now: _dt.datetime,
                  full_refresh: bool = False, run_checks_after: bool = True,
                  lookback_hours: int = 2, bronze_slack_days: int = 1,
                  cutoff_from: str = "clock", bronze_bounds: bool = True,
                  whole_checks: bool = True) -> RunReport:
    """``cutoff_from="clock"``: re-process from ``date_trunc('hour', now - lookback)``
    (the source's rule).  ``"high_water_mark"``: from the silver readings'
    ``max(event_ts) - lookback`` (AGG-5), so a late replay of old readings
    up to that mark is still picked up.  ``bronze_bounds`` keeps event-time bounds per bronze folder, by
    which incremental runs skip folders (``sources/bronze_stats.py``).  ``whole_checks=False`` checks only the dates
    whose files changed."""
    report = RunReport()
    now = naive_utc(now)
    cutoff = lookback_cutoff(now, lookback_hours)
    sr_path0 = paths.table("silver_iot_sensor_readings")
    if cutoff_from == "high_water_mark" and not full_refresh and tables.table_exists(spark, sr_path0):
        mark = tables.high_water_mark(tables.read_table(spark, sr_path0), "event_ts",
                                      lookback=f"{int(lookback_hours)} hours")
        us = mark.select(F.unix_micros("hwm")).first()[0]      # zone-free transfer
        hwm = _dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=us)
        cutoff = min(cutoff, hwm.replace(minute=0, second=0, microsecond=0))
    since = (cutoff - _dt.timedelta(days=bronze_slack_days)).date()

    # --- silver readings -------------------------------------------------
    sr_path = paths.table("silver_iot_sensor_readings")
    inc = not full_refresh and tables.table_exists(spark, sr_path)
    if bronze_bounds:
        refresh_stats(spark, paths.bronze_readings)
    bronze_r = read_bronze_readings(spark, paths.bronze_readings, since_date=since if inc else None,
                                    since_ms=to_epoch_micros(cutoff) // 1000 if inc and bronze_bounds else None)
    sr = silver.silver_readings(bronze_r, now=now, lookback_hours=lookback_hours,
                                incremental=inc, cutoff=cutoff)
    report.actions["silver_iot_sensor_readings"] = tables.upsert(
        spark, sr_path, sr, "pk_sensor_event_id", "event_date", full_refresh=not inc)

    # --- silver alerts ---------------------------------------------------
    sa_path = paths.table("silver_threshold_breached_alerts")
    inc_a = not full_refresh and tables.table_exists(spark, sa_path)
    bronze_a = read_bronze_alerts(spark, paths.bronze_alerts,
                                  since_date=since if inc_a else None)
    sa = silver.silver_alerts(bronze_a, now=now, lookback_hours=lookback_hours,
                              incremental=inc_a, cutoff=cutoff)
    report.actions["silver_threshold_breached_alerts"] = tables.upsert(
        spark, sa_path, sa, "pk_alert_event_id", "alert_date", full_refresh=not inc_a)

    # --- gold ------------------------------------------------------------
    silver_r = tables.read_table(spark, sr_path)
    silver_a = tables.read_table(spark, sa_path)
    gm_path = paths.table("gold_sensor_hourly_metrics")
    go_path = paths.table("gold_hourly_occupancy_rate")
    gb_path = paths.table("gold_hourly_breach_counts")
    inc_g = not full_refresh and tables.table_exists(spark, gm_path) \
        and tables.table_exists(spark, go_path)
    if inc_g:
        silver_r = silver_r.where(F.col("event_date") >= F.lit(cutoff.date().isoformat()).cast("date"))
    rollup = (gold.hourly_device_rollup(silver_r, now=now, lookback_hours=lookback_hours,
                                        incremental=inc_g, cutoff=cutoff)
              .withColumn("hour_date", utc_date("hour_ts"))
              .persist())
    try:
        metrics = rollup.select(*gold.METRICS_COLUMNS, "hour_date")
        occ = rollup.select(*gold.OCCUPANCY_COLUMNS, "hour_date")
        report.actions["gold_sensor_hourly_metrics"] = tables.replace_slice(
            spark, gm_path, metrics, "hour_ts", cutoff, full_refresh=not inc_g)
        report.actions["gold_hourly_occupancy_rate"] = tables.replace_slice(
            spark, go_path, occ, "hour_ts", cutoff, full_refresh=not inc_g)
    finally:
        rollup.unpersist()

    inc_b = not full_refresh and tables.table_exists(spark, gb_path)
    if inc_b:
        silver_a = silver_a.where(F.col("alert_date") >= F.lit(cutoff.date().isoformat()).cast("date"))
    breaches = (gold.hourly_breach_counts(silver_a, now=now, lookback_hours=lookback_hours,
                                          incremental=inc_b, cutoff=cutoff)
                .withColumn("hour_date", utc_date("hour_ts")))
    report.actions["gold_hourly_breach_counts"] = tables.replace_slice(
        spark, gb_path, breaches, "hour_ts", cutoff, full_refresh=not inc_b)

    # --- checks ----------------------------------------------------------
    if run_checks_after and whole_checks:
        report.checks = assert_checks(lake_checks(spark, paths))
    elif run_checks_after:
        report.checks = changed_checks(spark, paths)
    return report


def changed_checks(spark: SparkSession, paths: LakePaths) -> list[dict]:
    """CHK-1/CHK-2 of the dates that changed since the last look (``operators/check_state.py``)."""
    found = [check_table(spark, paths.table(name), name, keyed) for name, keyed in LAKE_KEYS.items()]
    bad = [r for r in found if r["unique"] or r["not_null"]]
    if bad:
        raise AssertionError("data checks failed: " + ", ".join(
            f"{r['table']} unique={r['unique']} not_null={r['not_null']}" for r in bad))
    return found


def lake_checks(spark: SparkSession, paths: LakePaths):
    """CHK-1/CHK-2 on the five primary keys."""
    return run_checks({name: (tables.read_table(spark, paths.table(name)), pk)
                       for name, (pk, _) in TABLE_KEYS.items()})
