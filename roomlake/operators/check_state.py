"""CHK-1/2 at scale: key checks of a partitioned table that regroup only the dates that changed.

Every table's key contains the time that fixes its date partition, so a key cannot occur in two dates, provided that
each row's key is the one its columns give and its date is the one its time gives.  Both are tested row by row with the
checks themselves.  So a date's result (rows, null keys, keys that occur more than once, strays: rows whose key or
date is not theirs) stays valid until its files change, and an hourly run checks the few dates that it wrote.  Where any
date has strays the argument does not hold, and the table is checked whole, as ``exact=True`` does on demand.

Results are kept in a small JSON file beside the table (a line's worth a date), with the number and bytes of the files
that they were taken from.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomlake.functions.columns import surrogate_key, utc_date
from roomlake.operators.checks import check_frame
from roomlake.operators.tables import _fs, _read_small, _write_small, read_table

STATE_FILE = "_checks.json"


@dataclass(frozen=True)
class KeyedTable:
    """What a table's key is made of: (key column, its columns, the time among them, the date partition)."""
    key: str
    columns: tuple
    time: str
    date: str


#: the five tables of the lake
LAKE_KEYS = {
    "silver_iot_sensor_readings": KeyedTable("pk_sensor_event_id", ("device_id", "event_ts"), "event_ts", "event_date"),
    "silver_threshold_breached_alerts": KeyedTable("pk_alert_event_id", ("user_id", "device_id", "rule", "severity", "alert_ts"),
                                                   "alert_ts", "alert_date"),
    "gold_sensor_hourly_metrics": KeyedTable("pk_sensor_device_hour_id", ("device_id", "hour_ts"), "hour_ts", "hour_date"),
    "gold_hourly_occupancy_rate": KeyedTable("pk_sensor_device_hour_id", ("device_id", "hour_ts"), "hour_ts", "hour_date"),
    "gold_hourly_breach_counts": KeyedTable("pk_alert_hour_id", ("device_id", "hour_ts", "severity", "rule"), "hour_ts", "hour_date"),
}


def _dates(spark: SparkSession, path: str, col: str) -> dict[str, list[int]]:
    """Date -> [files, bytes] of every partition there is."""
    fs, p = _fs(spark, path)
    out = {}
    for s in fs.listStatus(p) if fs.exists(p) else []:
        name = s.getPath().getName()
        if s.isDirectory() and name.startswith(f"{col}="):
            size = fs.getContentSummary(s.getPath())
            out[name.split("=", 1)[1]] = [int(size.getFileCount()), int(size.getLength())]
    return out


def check_dates(df: DataFrame, table: KeyedTable) -> DataFrame:
    """One row a date: rows, null keys, keys that occur more than once, strays.  Keys are exchanged once, by (date, key)."""
    stray = (F.col(table.key).isNotNull() & (F.col(table.key) != surrogate_key(df, list(table.columns)))) \
        | F.col(table.date).isNull() | (utc_date(table.time) != F.col(table.date))
    per_key = (df.withColumn("_stray", F.coalesce(stray, F.lit(True)))
                 .groupBy(F.col(table.date).cast("string").alias("date"), F.col(table.key).alias("k"))
                 .agg(F.count(F.lit(1)).alias("n"), F.count_if("_stray").alias("s")))
    return per_key.groupBy("date").agg(
        F.sum("n").alias("rows"), F.sum(F.when(F.col("k").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        F.count_if(F.col("k").isNotNull() & (F.col("n") > 1)).alias("repeated"), F.sum("s").alias("strays"))


def check_table(spark: SparkSession, path: str, name: str, table: KeyedTable, exact: bool = False) -> dict:
    """``unique`` and ``not_null`` failures of the table at ``path``; ``checked``: the dates that were read for it."""
    path = path.rstrip("/")
    text = _read_small(spark, f"{path}/{STATE_FILE}")
    old = {} if text is None else {r["date"]: r for r in json.loads(text)}
    now = _dates(spark, path, table.date)
    keep = {} if exact else {d: r for d, r in old.items() if now.get(d) == r["size"]}
    changed = sorted(d for d in now if d not in keep)
    df = read_table(spark, path)
    if changed:
        for r in check_dates(df.where(F.col(table.date).cast("string").isin(changed)), table).collect():    # a row a date
            keep[r.date] = {**r.asDict(), "size": now[r.date]}
        for d in changed:                              # a date whose files hold no row
            keep.setdefault(d, {"date": d, "rows": 0, "nulls": 0, "repeated": 0, "strays": 0, "size": now[d]})
    if changed or keep.keys() != old.keys():
        _write_small(spark, f"{path}/{STATE_FILE}", json.dumps([keep[d] for d in sorted(keep)]))
    result = {"table": name, "unique": sum(r["repeated"] for r in keep.values()),
              "not_null": sum(r["nulls"] for r in keep.values()), "checked": changed, "whole": False}
    if exact or any(r["strays"] for r in keep.values()):
        whole = {r.check_name: r.failures for r in check_frame(name, df, table.key).collect()}
        result |= {"unique": whole["unique"], "not_null": whole["not_null"], "whole": True}
    return result
