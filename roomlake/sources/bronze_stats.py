"""Pruned bronze scans (SRC-3, FLT-2): per-folder event-time bounds beside the data.

Bronze folders are named by processing time, look-back filters are on event time, so folder names alone cannot be pruned
by them.  ``refresh_stats`` keeps, per ``dt``/``hour`` folder, the least and greatest ``eventTimeMillis``; it scans only
folders that are new or have changed (by number of files and bytes).  ``folders_since`` then names the folders
that may hold a reading from a time on.  A folder without bounds, with rows without event time, or changed since
its bounds were taken is always read, so a missing or old file of bounds costs time, never rows.

The bounds are a small JSON file ``_stats.json`` (a line's worth per folder), written by whoever runs the job.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomlake.operators.tables import _fs, _read_small, _write_small

STATS_FILE = "_stats.json"
TIME = "eventTimeMillis"


def _folders(spark: SparkSession, path: str) -> dict[tuple[str, str], list[int]]:
    """(dt, hour) -> [files, bytes] of every folder there is."""
    out = {}
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return out
    for day in fs.listStatus(root):
        dt = day.getPath().getName()
        if not (day.isDirectory() and dt.startswith("dt=")):
            continue
        for hour in fs.listStatus(day.getPath()):
            name = hour.getPath().getName()
            if hour.isDirectory() and name.startswith("hour="):
                s = fs.getContentSummary(hour.getPath())
                out[dt[3:], name[5:]] = [int(s.getFileCount()), int(s.getLength())]
    return out


def _stored(spark: SparkSession, path: str) -> dict[tuple[str, str], dict]:
    text = _read_small(spark, f"{path.rstrip('/')}/{STATS_FILE}")
    return {} if text is None else {(r["dt"], r["hour"]): r for r in json.loads(text)}


def refresh_stats(spark: SparkSession, path: str) -> int:
    """Take the bounds of new and changed folders; returns how many were scanned."""
    now, old = _folders(spark, path), _stored(spark, path)
    keep = {k: r for k, r in old.items() if now.get(k) == r["size"]}
    changed = [k for k in now if k not in keep]
    if changed:
        schema = T.StructType([T.StructField(TIME, T.LongType()), T.StructField("dt", T.StringType()),
                               T.StructField("hour", T.StringType())])
        rows = spark.read.schema(schema).json(path).where(_in_folders(changed))
        bounds = rows.groupBy("dt", "hour").agg(F.min(TIME).alias("lo"), F.max(TIME).alias("hi"),
                                                F.count_if(F.col(TIME).isNull()).alias("unknown"))
        for r in bounds.collect():                            # a row a folder
            keep[r.dt, r.hour] = {"dt": r.dt, "hour": r.hour, "size": now[r.dt, r.hour], "lo": r.lo, "hi": r.hi,
                                  "unknown": r.unknown}
    if changed or keep.keys() != old.keys():
        _write_small(spark, f"{path.rstrip('/')}/{STATS_FILE}", json.dumps([keep[k] for k in sorted(keep)]))
    return len(changed)


def _in_folders(folders: list[tuple[str, str]]) -> Column:
    by_day: dict[str, list[str]] = {}
    for dt, hour in folders:
        by_day.setdefault(dt, []).append(hour)
    cond = F.lit(False)
    for dt, hours in sorted(by_day.items()):
        cond = cond | ((F.col("dt") == dt) & F.col("hour").isin(sorted(hours)))
    return cond


def folders_since(spark: SparkSession, path: str, since_ms: int) -> list[tuple[str, str]]:
    """The folders that may hold a reading at or after ``since_ms``."""
    stored = _stored(spark, path)
    out = []
    for key, size in _folders(spark, path).items():
        r = stored.get(key)
        if r is None or r["size"] != size or r["unknown"] or r["hi"] is None or r["hi"] >= since_ms:
            out.append(key)
    return out


def prune(df: DataFrame, path: str, since_ms: int) -> DataFrame:
    """A bronze frame cut to the folders and rows at or after ``since_ms``.

    The row filter reaches the JSON reader as well (rows without event time pass: their time may be parsed later).
    """
    return df.where(_in_folders(folders_since(df.sparkSession, path, since_ms))
                    & ((F.col(TIME) >= since_ms) | F.col(TIME).isNull()))
