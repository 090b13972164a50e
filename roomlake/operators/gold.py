"""Gold layer: hourly rollups of silver tables (AGG-1..4, PRJ-12, PRJ-11).

All three are hash aggregations with a map-side partial step, so the shuffle
carries one partial row per (task, device, hour) whatever the input size,
and a hot device is pre-aggregated before it reaches the network.
``hourly_device_rollup`` computes the metrics and the occupancy rate in one
pass, so the lakehouse job scans and groups silver readings once for both
gold tables.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomlake.functions.columns import (hour_ts, lookback_cutoff, surrogate_key,
                                        ts_literal)
from roomlake.operators.silver import READING_ORDER, _keep_first, readings_to_keep

METRIC_MEASURES = ["temperature", "humidity", "light", "co2"]

METRICS_COLUMNS = (["pk_sensor_device_hour_id", "device_id", "hour_ts"]
                   + [f"{a}_{m}" for m in METRIC_MEASURES for a in ("avg", "min", "max")]
                   + ["avg_humidity_ratio"])
OCCUPANCY_COLUMNS = ["pk_sensor_device_hour_id", "device_id", "hour_ts", "occupancy_rate"]
BREACH_COLUMNS = ["pk_alert_hour_id", "device_id", "hour_ts", "severity", "rule",
                  "breach_count"]


def _since(df: DataFrame, ts_col: str, now, lookback_hours: int, incremental: bool,
           cutoff: _dt.datetime | None = None):
    if not incremental:
        return df
    if cutoff is None:
        if now is None:
            raise ValueError("incremental runs need 'now' or an explicit cutoff")
        cutoff = lookback_cutoff(now, lookback_hours)
    return df.where(F.col(ts_col) >= ts_literal(cutoff))


def _rollup_columns() -> list:
    aggs = []
    for m in METRIC_MEASURES:
        aggs += [F.avg(m).alias(f"avg_{m}"), F.min(m).alias(f"min_{m}"),
                 F.max(m).alias(f"max_{m}")]
    return aggs + [F.avg("humidity_ratio").alias("avg_humidity_ratio"),
                   F.avg(F.col("occupancy").cast("double")).alias("occupancy_rate")]


#: readings of one device and hour above which they are rolled up in parts
HOT_DEVICE_HOUR = 1_000_000
#: hot device-hours up to which they are told from the others by a broadcast of their keys
FEW_HOT = 100_000
#: rows dealt to one task
ROWS_PER_TASK = 500_000

_AVERAGED = [*METRIC_MEASURES, "humidity_ratio", "occupancy"]


def _partial_columns() -> list:
    aggs = [f(F.col(m).cast("double")).alias(f"{n}_{m}") for m in _AVERAGED for n, f in (("sum", F.sum), ("n", F.count))]
    return aggs + [f(m).alias(f"{n}_{m}") for m in METRIC_MEASURES for n, f in (("min", F.min), ("max", F.max))]


def _merged_columns() -> list:
    avg = lambda m: F.try_divide(F.sum(f"sum_{m}"), F.sum(f"n_{m}"))
    aggs = []
    for m in METRIC_MEASURES:
        aggs += [avg(m).alias(f"avg_{m}"), F.min(f"min_{m}").alias(f"min_{m}"), F.max(f"max_{m}").alias(f"max_{m}")]
    return aggs + [avg("humidity_ratio").alias("avg_humidity_ratio"), avg("occupancy").alias("occupancy_rate")]


def rollup_from_bronze(bronze: DataFrame, hot_rows: int | None = HOT_DEVICE_HOUR, parts: int = 64) -> DataFrame:
    """WIN-1 and AGG-1/2 in one exchange: bronze readings, de-duplicated and rolled up by device and hour.

    Rows are dealt by (device, hour).  The key of the de-duplication holds both and the roll-up's key is both, so
    neither needs another exchange.  A device-hour with more than ``hot_rows`` readings would be one task: those
    (at most rows / ``hot_rows`` of them, found by one small aggregation) are dealt by parts of their event time too,
    which a key never leaves, and their partial roll-ups are merged (``hot_rows=None``: known to have none, no look).
    A few are told from the others by a broadcast of their keys; where they are many, all device-hours are dealt by parts,
    as a join would bring a hot one's rows together.  The look counts the rows as well, and the number of tasks
    follows them, so that a task's share does not grow with the table.
    Same values as ``hourly_device_rollup`` over ``silver_readings``.
    """
    rows = readings_to_keep(bronze).withColumn("hour_ts", hour_ts("event_ts"))
    keys = ["device_id", "hour_ts"]
    if hot_rows is None:
        tasks, n_hot = [], 0
    else:
        counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        look = counts.agg(F.sum("n").alias("rows"), F.count_if(F.col("n") > hot_rows).alias("hot")).first()
        least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        tasks, n_hot = [max(least, -(-(look.rows or 0) // ROWS_PER_TASK))], look.hot

    def usual(part: DataFrame) -> DataFrame:
        first = _keep_first(part.repartition(*tasks, *keys), [*keys, "event_ts"], READING_ORDER)
        return first.groupBy(*keys).agg(*_rollup_columns())

    def in_parts(part: DataFrame) -> DataFrame:
        salted = part.withColumn("part", F.pmod(F.xxhash64("event_ts"), F.lit(parts)))
        first = _keep_first(salted.repartition(*tasks, *keys, "part"), [*keys, "part", "event_ts"], READING_ORDER)
        partial = first.groupBy(*keys, "part").agg(*_partial_columns())
        return partial.repartition(*tasks, *keys).groupBy(*keys).agg(*_merged_columns())

    if not n_hot:
        out = usual(rows)
    elif n_hot <= FEW_HOT:
        hot = F.broadcast(counts.where(F.col("n") > hot_rows).select(*keys))
        out = usual(rows.join(hot, keys, "left_anti")).unionByName(in_parts(rows.join(hot, keys, "left_semi")))
    else:
        out = in_parts(rows)
    return out.withColumn("pk_sensor_device_hour_id", surrogate_key(out, keys))


def hourly_device_rollup(silver: DataFrame, now: _dt.datetime | None = None,
                         lookback_hours: int = 2, incremental: bool = False,
                         cutoff: _dt.datetime | None = None) -> DataFrame:
    """One aggregation feeding both gold_sensor_hourly_metrics and occupancy rate."""
    base = _since(silver, "event_ts", now, lookback_hours, incremental, cutoff)
    agg = (base.groupBy("device_id", hour_ts("event_ts").alias("hour_ts")).agg(*_rollup_columns()))
    return agg.withColumn("pk_sensor_device_hour_id",
                          surrogate_key(agg, ["device_id", "hour_ts"]))


def sensor_hourly_metrics(silver: DataFrame, **kw) -> DataFrame:
    """AGG-1: avg/min/max of temperature, humidity, light, co2 and avg humidity_ratio."""
    return hourly_device_rollup(silver, **kw).select(*METRICS_COLUMNS)


def hourly_occupancy_rate(silver: DataFrame, **kw) -> DataFrame:
    """AGG-2: share of occupied readings per device and hour."""
    return hourly_device_rollup(silver, **kw).select(*OCCUPANCY_COLUMNS)


def hourly_breach_counts(silver_alerts: DataFrame, now: _dt.datetime | None = None,
                         lookback_hours: int = 2, incremental: bool = False,
                         cutoff: _dt.datetime | None = None) -> DataFrame:
    """AGG-3: alerts per device, hour, severity and rule."""
    base = _since(silver_alerts, "alert_ts", now, lookback_hours, incremental, cutoff)
    agg = (base.groupBy("device_id", hour_ts("alert_ts").alias("hour_ts"), "severity", "rule")
               .agg(F.count(F.lit(1)).alias("breach_count")))
    return (agg.withColumn("pk_alert_hour_id",
                           surrogate_key(agg, ["device_id", "hour_ts", "severity", "rule"]))
               .select(*BREACH_COLUMNS))
