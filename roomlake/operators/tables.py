"""Incremental table writes on partitioned Parquet (SNK-5/6/7, SRC-6, AGG-5).

upsert         MERGE by primary key, only in the partitions the updates touch
replace_slice  delete ``ts >= cutoff`` then append, partition-exact
high_water_mark  coalesce(max(ts), default) - look-back, as an alternative cutoff

Both writers use dynamic partition overwrite, so untouched partitions are
never rewritten; the touched partition list is derived from the (small)
update batch and reaches the scan as a partition filter.  A first run (the
target does not exist) or ``full_refresh`` writes the whole table.  Writers
assume one writer per table at a time (as an hourly job with one active run
gives).  Task and executor failures are retried inside the job and nothing
is visible before the job commits; the commit itself replaces partitions one
by one, so a driver crash during it can leave a touched partition missing or
old -- an open table format with atomic commits removes that window.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomlake.functions.columns import naive_utc, ts_literal


def _fs(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``: whatever store the session's readers and writers use."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    """A table is there once its schema sidecar is: it is written after the first full build commits,
    whether or not the committer leaves success markers."""
    fs, _ = _fs(spark, path)
    return fs.exists(_fs(spark, f"{path.rstrip('/')}/_schema.json")[1])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a table written here, with its recorded schema, so a table that
    is still empty (a partitioned write of no rows leaves no files) reads as
    an empty frame instead of failing schema inference."""
    from pyspark.sql.types import StructType

    text = _read_small(spark, f"{path.rstrip('/')}/_schema.json")
    if text is not None:
        return spark.read.schema(StructType.fromJson(json.loads(text))).parquet(path)
    return spark.read.parquet(path)


def _read_small(spark: SparkSession, path: str) -> str | None:
    """A small metadata file's text (no Spark job), None when absent."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_small(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _write_schema(df: DataFrame, path: str) -> None:
    _write_small(df.sparkSession, f"{path.rstrip('/')}/_schema.json", df.schema.json())


def _write(df: DataFrame, path: str, partition_cols: list[str], dynamic: bool) -> None:
    # Full builds span every date: rebalance on the partition columns so AQE
    # packs each date into few files (not one per task and date) and splits an
    # oversized date.  Incremental merges touch a day or two, so they skip
    # the extra shuffle.
    if not dynamic:
        df = df.hint("rebalance", *partition_cols)
    w = df.write.mode("overwrite").partitionBy(*partition_cols)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)
    if not dynamic:            # (re)created: record the schema beside the data
        _write_schema(df, path)


def _partition_filter(values: list, col: str) -> Column:
    if not values:
        return F.lit(False)
    return F.col(col).isin(values)


def upsert(spark: SparkSession, path: str, updates: DataFrame, key: str,
           partition_col: str, full_refresh: bool = False) -> str:
    """MERGE ``updates`` into the table at ``path`` by ``key``.

    The key fixes the partition value (it contains the event time), so a key
    never moves partition.  Returns "created" or "merged".
    """
    if full_refresh or not table_exists(spark, path):
        _write(updates, path, [partition_col], dynamic=False)
        return "created"
    # the update batch feeds three steps; keep it (recomputable from bronze)
    updates = updates.persist()
    try:
        # touched partitions: one value per day, so a tiny list on the driver
        touched = [r[0] for r in updates.select(partition_col).distinct().collect()]
        target = read_table(spark, path).where(_partition_filter(touched, partition_col))
        kept = target.join(updates.select(key), on=key, how="left_anti")
        merged = kept.unionByName(updates.select(*target.columns))
        _write(merged, path, [partition_col], dynamic=True)
    finally:
        updates.unpersist()
    return "merged"


def _delete_partitions(spark: SparkSession, path: str, col: str, values: list[str]) -> None:
    for v in values:
        fs, p = _fs(spark, f"{path.rstrip('/')}/{col}={v}")
        if fs.exists(p):
            fs.delete(p, True)


def _partition_values(spark: SparkSession, path: str, col: str) -> list[str]:
    fs, p = _fs(spark, path)
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(f"{col}="):
            out.append(name.split("=", 1)[1])
    return out


def replace_slice(spark: SparkSession, path: str, new_rows: DataFrame, ts_col: str,
                  cutoff: _dt.datetime, partition_col: str = "hour_date",
                  full_refresh: bool = False) -> str:
    """Delete rows with ``ts_col >= cutoff`` and append ``new_rows`` (all >= cutoff).

    Partitions are by date; the cutoff's date keeps its rows before the
    cutoff, later dates are replaced, and later partitions that got no new
    rows are deleted (a dynamic overwrite alone would leave them).
    """
    if full_refresh or not table_exists(spark, path):
        _write(new_rows, path, [partition_col], dynamic=False)
        return "created"
    cutoff = naive_utc(cutoff)           # partitions are UTC dates
    cut_date = cutoff.date().isoformat()
    cut = ts_literal(cutoff)
    target = read_table(spark, path)
    survivors = target.where((F.col(partition_col) == F.lit(cut_date).cast("date"))
                             & (F.col(ts_col) < cut))
    fresh = new_rows.where(F.col(ts_col) >= cut).select(*target.columns).persist()
    try:
        merged = survivors.unionByName(fresh)
        written = {str(r[0]) for r in merged.select(partition_col).distinct().collect()}
        existing = [v for v in _partition_values(spark, path, partition_col) if v >= cut_date]
        if written:
            _write(merged, path, [partition_col], dynamic=True)
        _delete_partitions(spark, path, partition_col, [v for v in existing if v not in written])
    finally:
        fresh.unpersist()
    return "replaced"


def high_water_mark(df: DataFrame, ts_col: str, default: str = "2010-01-01",
                    lookback: str = "0 days", where: str | None = None) -> DataFrame:
    """AGG-5: one row ``hwm = coalesce(max(ts), default) - INTERVAL lookback``."""
    base = df.where(where) if where else df
    floor = ts_literal(_dt.datetime.fromisoformat(default))
    return base.agg((F.coalesce(F.max(ts_col), floor)
                     - F.expr(f"INTERVAL {lookback}")).alias("hwm"))
