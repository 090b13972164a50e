"""File sources: sensor / threshold CSV (SRC-7/8, PRJ-5/6, CHK-3) and the
bronze NDJSON tables (SRC-3/4/5).

Every reader takes an explicit schema: no inference pass over the data, and
stable types whatever the files hold.  Bronze partition columns ``dt`` and
``hour`` are declared as strings so they are not re-typed by discovery, and
a ``dt`` predicate prunes directories before any file is opened.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomlake.functions.columns import iso_utc_string, naive_as_utc, utc_date, utc_hour, utc_string
from roomlake.operators.checks import require_columns
from roomlake.schemas import (ALERT_MESSAGE, BRONZE_READING, SENSOR_CSV_COLUMNS,
                              THRESHOLD_CSV_COLUMNS)

DEFAULT_DEVICE_ID = "dev_123"

PARTITION_FIELDS = [T.StructField("dt", T.StringType()), T.StructField("hour", T.StringType())]


def read_csv_checked(spark: SparkSession, path: str, required: list[str],
                     what: str) -> DataFrame:
    """CSV with a header; every required column must be present (extras allowed).

    Columns are read as strings and cast by the projection that follows,
    which avoids an inference pass over the file.
    """
    header = spark.read.option("header", True).csv(path).columns
    require_columns(header, required, what)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    return spark.read.option("header", True).schema(schema).csv(path)


def read_sensor_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_checked(spark, path, SENSOR_CSV_COLUMNS, "iot csv")


def read_threshold_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_checked(spark, path, THRESHOLD_CSV_COLUMNS, "config csv")


def sensor_csv_to_readings(csv: DataFrame, device_id: str | Column = DEFAULT_DEVICE_ID) -> DataFrame:
    """PRJ-5: CSV row -> reading message columns; date normalised to UTC '...Z'."""
    dev = device_id if isinstance(device_id, Column) else F.lit(device_id)
    ts = naive_as_utc("date")
    return csv.select(
        iso_utc_string(ts).alias("event_time"),
        dev.alias("device_id"),
        F.col("Temperature").cast("double").alias("temperature"),
        F.col("Humidity").cast("double").alias("humidity"),
        F.col("Light").cast("double").alias("light"),
        F.col("CO2").cast("double").alias("co2"),
        F.col("HumidityRatio").cast("double").alias("humidity_ratio"),
        F.col("Occupancy").cast("double").cast("int").alias("occupancy"),
    )


def threshold_csv_to_configs(csv: DataFrame, updated_at: _dt.datetime | Column | None = None) -> DataFrame:
    """PRJ-6: CSV row -> config message; light_threshold is renamed and the
    row is stamped with ``updated_at`` (default: the query's current time)."""
    if updated_at is None:
        stamp = F.current_timestamp()
    elif isinstance(updated_at, Column):
        stamp = updated_at
    else:
        from roomlake.functions.columns import ts_literal
        stamp = ts_literal(updated_at)
    return csv.select(
        F.concat(utc_string(stamp, "T", 6), F.lit("Z")).alias("updated_at"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("device_id").cast("string").alias("device_id"),
        F.col("temperature_warning_threshold").cast("double").alias("temperature_warning_threshold"),
        F.col("temperature_violation_threshold").cast("double").alias("temperature_violation_threshold"),
        F.col("light_threshold").cast("double").alias("no_occupancy_light_threshold"),
    )


def read_bronze(spark: SparkSession, path: str, schema: T.StructType,
                since_date: _dt.date | None = None, repair_table: str | None = None) -> DataFrame:
    """NDJSON under ``dt=YYYY-MM-DD/hour=HH`` with an explicit schema.

    Path reads list partitions at analysis time, so new folders are always
    seen; for a catalog table pass ``repair_table`` to run the partition
    repair first (SRC-5).  ``since_date`` prunes ``dt`` folders.
    """
    if repair_table:
        spark.sql(f"MSCK REPAIR TABLE {repair_table}")
        df = spark.table(repair_table)
    else:
        from roomlake.operators.tables import _fs

        full = T.StructType(schema.fields + PARTITION_FIELDS)
        fs, p = _fs(spark, path)
        if not fs.exists(p):          # nothing landed yet (e.g. no alert so far)
            return spark.createDataFrame([], full)
        # live alert files lie one level deeper, in a folder per micro-batch
        df = spark.read.schema(full).option("mode", "PERMISSIVE").json(path).select(*full.names)
    if since_date is not None:
        df = df.where(F.col("dt") >= F.lit(since_date.isoformat()))
    return df


def read_bronze_readings(spark: SparkSession, path: str, since_ms: int | None = None, **kw) -> DataFrame:
    """Bronze readings; ``since_ms`` reads only the folders that may hold a reading from that event time on
    (by the bounds that ``bronze_stats.refresh_stats`` keeps) and drops older rows in the reader."""
    df = read_bronze(spark, path, BRONZE_READING, **kw)
    if since_ms is None:
        return df
    from roomlake.sources.bronze_stats import prune

    return prune(df, path, since_ms)


def read_bronze_alerts(spark: SparkSession, path: str, **kw) -> DataFrame:
    return read_bronze(spark, path, ALERT_MESSAGE, **kw)


def write_bronze(df: DataFrame, path: str, bucket_ts: Column | None = None,
                 mode: str = "append") -> None:
    """SNK-2/3 in batch: NDJSON partitioned by UTC ``dt``/``hour`` of
    ``bucket_ts`` (processing time by default)."""
    ts = F.current_timestamp() if bucket_ts is None else bucket_ts
    out = (df.withColumn("dt", utc_date(ts).cast("string"))
             .withColumn("hour", F.lpad(utc_hour(ts).cast("string"), 2, "0")))
    # rebalance: AQE packs each hour folder into few files and splits a hot hour
    out.hint("rebalance", "dt", "hour").write.mode(mode).partitionBy("dt", "hour").json(path)
