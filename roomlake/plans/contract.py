"""Contract queries: one per operator group of the survey, each
``(spark, sf_dir) -> DataFrame`` over the driver tables (whole tables).

The readings / config views are defined in ``roomlake.sources.testdata``.
Readings are ~11 h apart per device, so rule timings here are 12 h duration
and 24 h cooldown instead of minutes.  Timestamps leave as formatted
strings and averages are rounded to 4 places so the DuckDB oracle can
compare values exactly.  Queries that exercise writers (tables, bronze,
streams) write to fresh folders under the session's checkpoint folder.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomlake.functions.columns import iso_utc_string, lookback_cutoff, utc_date, utc_hour, utc_string
from roomlake.functions.messages import (alert_messages, config_messages, header_value,
                                         parse_configs, parse_readings, reading_messages)
from roomlake.operators import gold, silver, tables
from roomlake.operators.asof import join_config_in_force
from roomlake.operators.breaches import detect_breaches, rule_matches
from roomlake.operators.checks import run_checks
from roomlake.operators.config import join_config, latest_config
from roomlake.schemas import ALERT_MESSAGE, BRONZE_READING, MEASURES
from roomlake.session import ensure_checkpoint_dir, scratch_path, ship_package
from roomlake.settings import DEFAULT_RULES, with_timing
from roomlake.sources import testdata
from roomlake.sources.files import (read_bronze_readings, read_sensor_csv, read_threshold_csv,
                                    sensor_csv_to_readings, threshold_csv_to_configs,
                                    write_bronze)

HOUR_S = 3600
CONTRACT_RULES = with_timing(DEFAULT_RULES, 12 * HOUR_S, 24 * HOUR_S)
EPISODE_RULES = with_timing(DEFAULT_RULES, 12 * HOUR_S, 0)
NOW = _dt.datetime(2024, 1, 16, 0, 30, 0)          # fixed "now" of incremental runs
CUTOFF = lookback_cutoff(NOW, 2)
TIE = ("event_ts", "event_id")
_MIDDLE_MS = 1705320000000                          # 2024-01-15 12:00 UTC, within the readings' period
_PLANTED_FROM = "2024-01-20"

TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
HOUR_FMT = "yyyy-MM-dd HH:mm:ss"
ALERT_COLS = [f.name for f in ALERT_MESSAGE.fields]


def _ts(c: str, fmt: str = TS_FMT):
    return utc_string(c, " ", 6 if fmt == TS_FMT else 0).alias(c)


def _d(c: str):
    return F.col(c).cast("string").alias(c)


def _r4(c: str):
    """Round half up at 4 places with plain double arithmetic (same in DuckDB)."""
    return (F.floor(F.col(c) * 10000.0 + 0.5) / 10000.0).alias(c)


# ---------------------------------------------------------------- inputs

def joined(spark: SparkSession, sf: str) -> DataFrame:
    cfg = latest_config(testdata.config_updates(spark, sf))
    return join_config(testdata.readings(spark, sf), cfg)


def contract_alerts(spark: SparkSession, sf: str, rules=CONTRACT_RULES) -> DataFrame:
    return detect_breaches(joined(spark, sf), rules, tie_cols=TIE)


def bronze_readings_rows(spark: SparkSession, sf: str, temp_delta: float = 0.0) -> DataFrame:
    """Reading messages as they land in bronze (event_time string)."""
    r = testdata.readings(spark, sf)
    return r.select("event_time", "device_id",
                    (F.col("temperature") + F.lit(temp_delta)).alias("temperature"),
                    *[m for m in MEASURES if m != "temperature"], "occupancy",
                    F.col("t").alias("eventTimeMillis"))


def bronze_alert_rows(alerts: DataFrame) -> DataFrame:
    return alerts.select(*ALERT_COLS)


# ---------------------------------------------------------------- queries

def readings_projection(spark, sf):
    """SRC-7 + CHK-3 + PRJ-5/9/10: sensor CSV -> reading rows with date/hour."""
    ev = testdata.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    path = scratch_path(spark, "sensor-csv")
    (ev.select(utc_string(testdata.as_utc(ev, "ts")).alias("date"),
               F.col("value").alias("Temperature"), (k / 2.0).alias("Humidity"),
               k.alias("Light"), (k + 400.0).alias("CO2"),
               (F.col("value") / 1000.0).alias("HumidityRatio"),
               F.when(F.col("event_type").isin("view", "click"), 1).otherwise(0).alias("Occupancy"))
       .write.option("header", True).csv(path))
    r = sensor_csv_to_readings(read_sensor_csv(spark, path))
    ts = F.to_timestamp("event_time")
    return r.select("event_time", "device_id", *MEASURES, "occupancy",
                    utc_date(ts).cast("string").alias("event_date"),
                    utc_hour(ts).alias("event_hour"))


def reading_json_roundtrip(spark, sf):
    """PRJ-8 -> PRJ-1/3: readings -> keyed JSON messages -> typed readings."""
    r = testdata.readings(spark, sf)
    msgs = reading_messages(r)
    parsed = parse_readings(msgs)
    return parsed.select("key", "device_id", "event_time",
                         F.col("eventTimeMillis").alias("event_time_ms"), *MEASURES, "occupancy",
                         header_value("event_type").alias("event_type"),
                         header_value("schema_version").alias("schema_version"),
                         F.col("_corrupt").alias("corrupt"))


def config_json_parse(spark, sf):
    """SRC-8 + PRJ-6 + PRJ-8 + PRJ-2: threshold CSV -> config messages -> typed configs."""
    o = testdata.config_updates(spark, sf)
    path = scratch_path(spark, "threshold-csv")
    (o.select("user_id", "device_id", "temperature_warning_threshold",
              "temperature_violation_threshold",
              F.col("no_occupancy_light_threshold").alias("light_threshold"))
      .write.option("header", True).csv(path))
    cfg = threshold_csv_to_configs(read_threshold_csv(spark, path), updated_at=NOW)
    parsed = parse_configs(config_messages(cfg))
    return parsed.select("key", "user_id", "device_id", "updated_at",
                         F.col("updatedAtMillis").alias("updated_at_ms"),
                         F.col("userDeviceKey").alias("user_device_key"),
                         "temperature_warning_threshold", "temperature_violation_threshold",
                         "no_occupancy_light_threshold",
                         header_value("producer").alias("producer"))


def _silver_out(df: DataFrame) -> DataFrame:
    return df.select("pk_sensor_event_id", _ts("event_ts"), _d("event_date"), "event_hour",
                     "device_id", *MEASURES, "occupancy", "rnk")


def silver_readings_q(spark, sf):
    """FLT-1/6, PRJ-4/11, WIN-1: bronze with repeated and altered deliveries."""
    b = bronze_readings_rows(spark, sf)
    bronze = b.unionByName(b).unionByName(bronze_readings_rows(spark, sf, 0.5))
    return _silver_out(silver.silver_readings(bronze))


def _silver_alerts(spark, sf) -> DataFrame:
    a = bronze_alert_rows(contract_alerts(spark, sf))
    return silver.silver_alerts(a.unionByName(a))


def silver_alerts_q(spark, sf):
    """WIN-2 + PRJ-11 on alerts delivered twice."""
    s = _silver_alerts(spark, sf)
    return s.select("pk_alert_event_id", _ts("alert_ts"), _d("alert_date"), "alert_hour",
                    "user_id", "device_id", "rule", "severity", "metric", "observed_value",
                    "threshold_value", "window_start_ms", "window_end_ms", "rnk")


def _silver(spark, sf, delta=0.0) -> DataFrame:
    return silver.silver_readings(bronze_readings_rows(spark, sf, delta))


def _metrics_out(df: DataFrame) -> DataFrame:
    cols = []
    for c in gold.METRICS_COLUMNS[3:]:
        cols.append(_r4(c) if c.startswith("avg_") else F.col(c))
    return df.select("pk_sensor_device_hour_id", "device_id", _ts("hour_ts", HOUR_FMT), *cols)


def gold_sensor_hourly_metrics_q(spark, sf):
    """AGG-1/4 + PRJ-11/12: hourly avg/min/max per device over silver readings."""
    return _metrics_out(gold.sensor_hourly_metrics(_silver(spark, sf)))


def gold_hourly_occupancy_rate_q(spark, sf):
    """AGG-2: hourly occupancy rate per device over silver readings."""
    g = gold.hourly_occupancy_rate(_silver(spark, sf))
    return g.select("pk_sensor_device_hour_id", "device_id", _ts("hour_ts", HOUR_FMT),
                    _r4("occupancy_rate"))


def gold_hourly_breach_counts_q(spark, sf):
    """AGG-3: alerts per device, hour, severity and rule over silver alerts."""
    g = gold.hourly_breach_counts(_silver_alerts(spark, sf))
    return g.select("pk_alert_hour_id", "device_id", _ts("hour_ts", HOUR_FMT), "severity",
                    "rule", "breach_count")


def latest_config_by_device(spark, sf):
    """JOIN-1 (config side): the newest config per device from the changelog."""
    c = latest_config(testdata.config_updates(spark, sf))
    return c.select("device_id", "user_id", _ts("updated_ts", HOUR_FMT), "seq",
                    "temperature_warning_threshold", "temperature_violation_threshold",
                    "no_occupancy_light_threshold")


def reading_config_join(spark, sf):
    """JOIN-1 + FLT-7: readings joined with their device's latest config."""
    j = joined(spark, sf)
    return j.select("event_id", "device_id", "user_id", _ts("event_ts"), "t", *MEASURES,
                    "occupancy", "temperature_warning_threshold",
                    "temperature_violation_threshold", "no_occupancy_light_threshold")


def _rule_q(i: int):
    def q(spark, sf):
        """FLT-3/4/5: readings on which one rule's condition holds."""
        return rule_matches(joined(spark, sf), DEFAULT_RULES[i])
    return q


def sustained_episodes(spark, sf):
    """STR-4: every reading on which a sustained condition is met (no cooldown)."""
    a = contract_alerts(spark, sf, EPISODE_RULES)
    return a.select(*[c for c in ALERT_COLS if c != "alert_time"])


def threshold_alerts(spark, sf):
    """STR-4..6 with 12 h duration and 24 h cooldown."""
    return contract_alerts(spark, sf)


def threshold_alerts_per_user(spark, sf):
    """config_key=user_device: one config per (user, device), alerts fan out per user."""
    cfg = latest_config(testdata.config_updates(spark, sf), key=("user_id", "device_id"))
    j = join_config(testdata.readings(spark, sf), cfg)
    return detect_breaches(j, CONTRACT_RULES, tie_cols=TIE)


def threshold_alerts_max_gap(spark, sf):
    """Optional max_gap: a silence over 18 h between readings ends an episode."""
    return detect_breaches(joined(spark, sf), CONTRACT_RULES, tie_cols=TIE, max_gap_s=18 * HOUR_S)


def _in_force(spark, sf) -> DataFrame:
    return join_config_in_force(testdata.readings(spark, sf), testdata.config_changes(spark, sf))


def reading_config_in_force(spark, sf):
    """JOIN-1 over history: readings with the config that was in force at each; earlier readings drop (FLT-7)."""
    return _in_force(spark, sf).select("event_id", "device_id", "user_id", _ts("event_ts"), "temperature", "light", "occupancy",
                                       "temperature_warning_threshold", "temperature_violation_threshold",
                                       "no_occupancy_light_threshold")


def replay_alerts(spark, sf):
    """JOIN-2 in batch: alerts over all history, each reading under the config in force at it."""
    return detect_breaches(_in_force(spark, sf), CONTRACT_RULES, key_cols=("device_id",), tie_cols=TIE)


def alert_messages_q(spark, sf):
    """PRJ-7: key, parsed-back value, headers."""
    m = alert_messages(contract_alerts(spark, sf))
    v = F.from_json("value", ALERT_MESSAGE)
    return m.select("key", v.alias("v"), "headers").select(
        "key", "v.*",
        header_value("schema_version").alias("h_schema_version"),
        header_value("event_type").alias("h_event_type"),
        header_value("producer").alias("h_producer"),
        header_value("severity").alias("h_severity"),
        header_value("rule").alias("h_rule"))


def incremental_lookback(spark, sf):
    """FLT-2: look-back slice of an incremental run at a fixed 'now'."""
    s = silver.silver_readings(bronze_readings_rows(spark, sf), now=NOW, incremental=True)
    return s.select("pk_sensor_event_id", _ts("event_ts"), "device_id", "temperature")


def high_water_mark_q(spark, sf):
    """AGG-5: coalesce(max(event_ts), default) - 2 hours, overall and per device."""
    s = _silver(spark, sf)
    per_dev = (s.groupBy("device_id").agg(F.max("event_ts").alias("m"))
                .select("device_id", (F.col("m") - F.expr("INTERVAL 2 HOURS")).alias("hwm")))
    overall = tables.high_water_mark(s, "event_ts", lookback="2 hours") \
        .select(F.lit("*").alias("device_id"), "hwm")
    return overall.unionByName(per_dev).select("device_id", _ts("hwm"))


def silver_upsert(spark, sf):
    """SNK-7 then SNK-5: full build, then an incremental merge of re-delivered rows."""
    path = scratch_path(spark, "silver-upsert")
    first = silver.silver_readings(bronze_readings_rows(spark, sf))
    tables.upsert(spark, path, first, "pk_sensor_event_id", "event_date")
    second = silver.silver_readings(bronze_readings_rows(spark, sf, 1.0), now=NOW, incremental=True)
    tables.upsert(spark, path, second, "pk_sensor_event_id", "event_date")
    t = tables.read_table(spark, path)
    return t.select("pk_sensor_event_id", _ts("event_ts"), _d("event_date"), "device_id",
                    "temperature", "rnk")


def gold_slice_replace(spark, sf):
    """SNK-6: gold built once, then the slice from the cutoff hour replaced."""
    path = scratch_path(spark, "gold-slice")
    first = gold.sensor_hourly_metrics(_silver(spark, sf)).withColumn("hour_date", utc_date("hour_ts"))
    tables.replace_slice(spark, path, first, "hour_ts", CUTOFF)
    second = (gold.sensor_hourly_metrics(_silver(spark, sf, 1.0), now=NOW, incremental=True)
              .withColumn("hour_date", utc_date("hour_ts")))
    tables.replace_slice(spark, path, second, "hour_ts", CUTOFF)
    t = tables.read_table(spark, path)
    return t.select("pk_sensor_device_hour_id", "device_id", _ts("hour_ts", HOUR_FMT),
                    _r4("avg_temperature"), "min_temperature", "max_temperature")


def check_unique_not_null(spark, sf):
    """CHK-1/2 on the five tables' primary keys, each table made once."""
    ensure_checkpoint_dir(spark)
    sr = _silver(spark, sf).checkpoint()
    sa = _silver_alerts(spark, sf).checkpoint()
    roll = gold.hourly_device_rollup(sr).checkpoint()
    return run_checks({
        "silver_iot_sensor_readings": (sr, "pk_sensor_event_id"),
        "silver_threshold_breached_alerts": (sa, "pk_alert_event_id"),
        "gold_sensor_hourly_metrics": (roll, "pk_sensor_device_hour_id"),
        "gold_hourly_occupancy_rate": (roll, "pk_sensor_device_hour_id"),
        "gold_hourly_breach_counts": (gold.hourly_breach_counts(sa), "pk_alert_hour_id"),
    })


def bronze_roundtrip(spark, sf):
    """SNK-2 + SRC-3/5: NDJSON under dt=/hour= and back with an explicit schema."""
    path = scratch_path(spark, "bronze-readings")
    rows = bronze_readings_rows(spark, sf)
    write_bronze(rows, path, bucket_ts=F.to_timestamp("event_time"))
    b = read_bronze_readings(spark, path)
    return b.select("event_time", "device_id", *MEASURES, "occupancy", "eventTimeMillis",
                    "dt", "hour")


def _config_lines(spark, sf) -> DataFrame:
    """The config changelog as JSON lines that carry their changelog position."""
    cfg = testdata.config_updates(spark, sf).select(
        "user_id", "device_id", iso_utc_string("updated_ts").alias("updated_at"), "seq",
        "temperature_warning_threshold", "temperature_violation_threshold",
        "no_occupancy_light_threshold")
    return cfg.select(F.to_json(F.struct(*cfg.columns)).alias("value"))


def stream_alerts_q(spark, sf):
    """JOIN-2, STR-2..6, STR-9: the stateful stream over message files, in two
    runs with a restart between them; equals the batch alerts."""
    from roomlake.streaming.alerts import stream_alerts, union_inputs
    from roomlake.streaming.jobs import config_stream, file_values, reading_stream

    root = scratch_path(spark, "stream-alerts")
    r = testdata.readings(spark, sf)
    bounds = r.agg(F.min("t").alias("lo"), F.max("t").alias("hi")).first()
    split = (bounds.lo + bounds.hi) // 2 if bounds.lo is not None else 0
    _config_lines(spark, sf).write.text(f"{root}/config/0")
    parts = [r.where(F.col("t") <= split), r.where(F.col("t") > split)]
    out = f"{root}/alerts"
    for i, part in enumerate(parts):
        reading_messages(part).select("value").write.text(f"{root}/readings/{i}")
        rv = file_values(spark, f"{root}/readings/*")
        cv = file_values(spark, f"{root}/config/*")
        alerts = stream_alerts(union_inputs(reading_stream(rv), config_stream(cv)),
                               CONTRACT_RULES, alert_time_from="event")
        q = (alerts.writeStream.format("parquet").option("path", out)
                   .option("checkpointLocation", f"{root}/ckpt")
                   .trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(out).select(*ALERT_COLS)


def stream_alerts_split(spark, sf):
    """JOIN-2, STR-2..6, STR-9 for hot devices: config history seeded in the JVM, four micro-batches with restarts
    between them, each folded by ranges of (device, time); equals the batch alerts."""
    from roomlake.streaming.jobs import file_values, reading_stream
    from roomlake.streaming.split import read_alerts, seed_configs, split_alert_query

    root = scratch_path(spark, "stream-split")
    r = testdata.readings(spark, sf)
    seed_configs(spark, f"{root}/job", testdata.config_updates(spark, sf), CONTRACT_RULES)
    bounds = r.agg(F.min("t").alias("lo"), F.max("t").alias("hi")).first()
    lo, hi = (bounds.lo, bounds.hi) if bounds.lo is not None else (0, 0)
    quarter = F.floor((F.col("t") - lo) * 4 / F.lit(hi - lo + 1))
    for i in range(4):
        # a run a delivery, so that its files, one per task, make up one micro-batch
        reading_messages(r.where(quarter == i)).select("value").write.text(f"{root}/in/{i}")
        q = split_alert_query(spark, reading_stream(file_values(spark, f"{root}/in/*")), None, f"{root}/job",
                              f"{root}/ckpt", rules=CONTRACT_RULES, alert_time_from="event", trigger={"availableNow": True})
        q.awaitTermination()
    return read_alerts(spark, f"{root}/job")


def stream_silver_q(spark, sf):
    """STR-7 + WIN-1 + SNK-5: silver merged from three micro-batches with repeated and altered deliveries."""
    from roomlake.streaming.jobs import file_values, reading_stream
    from roomlake.streaming.silver import stream_silver

    root = scratch_path(spark, "stream-silver")
    r = testdata.readings(spark, sf)
    for i, delta in enumerate((0.0, 0.5, 0.0)):               # the second delivery is the greater one
        reading_messages(r.withColumn("temperature", F.col("temperature") + F.lit(delta))).select("value") \
            .write.text(f"{root}/in/{i}")
        # a run a delivery, so that its files, one per task, make up one micro-batch
        q = stream_silver(reading_stream(file_values(spark, f"{root}/in/*")), f"{root}/silver", f"{root}/ckpt",
                          {"availableNow": True})
        q.awaitTermination()
    return _silver_out(tables.read_table(spark, f"{root}/silver"))


def stream_late_readings(spark, sf):
    """STR-1: four micro-batches in event order but for every 97th reading, which comes one batch late."""
    from roomlake.streaming.jobs import file_values, reading_stream
    from roomlake.streaming.late import late_readings_query, read_late

    root = scratch_path(spark, "stream-late")
    r = testdata.readings(spark, sf)
    bounds = r.agg(F.min("t").alias("lo"), F.max("t").alias("hi")).first()
    lo, hi = (bounds.lo, bounds.hi) if bounds.lo is not None else (0, 0)
    due = F.floor((F.col("t") - lo) * 4 / F.lit(hi - lo + 1)) + F.when(F.col("event_id") % 97 == 0, 1).otherwise(0)
    for i in range(4):
        reading_messages(r.where(F.least(due, F.lit(3)) == i)).select("value").write.text(f"{root}/in/{i}")
        q = late_readings_query(reading_stream(file_values(spark, f"{root}/in/*")), f"{root}/late", f"{root}/ckpt",
                                trigger={"availableNow": True})
        q.awaitTermination()
    return read_late(spark, f"{root}/late").select("event_time", "device_id", "temperature", "watermark_ms",
                                                   F.col("batch").cast("int").alias("batch"))


def _landed(late_s=None):
    """When a reading reaches bronze, if deliveries come every six hours."""
    s = F.floor(F.col("eventTimeMillis") / F.lit(1000 * 21600)) * 21600
    return F.timestamp_seconds(s if late_s is None else s + late_s)


def bronze_since(spark, sf):
    """SRC-3 + FLT-2: a look-back scan of bronze by event time, cut to the folders that may hold such readings."""
    from roomlake.sources.bronze_stats import refresh_stats

    path = scratch_path(spark, "bronze-since")
    # folders are processing time: every 50th reading lands two days late
    late = F.when(F.col("eventTimeMillis") % 50 == 0, 2 * 86400).otherwise(0)
    write_bronze(bronze_readings_rows(spark, sf), path, bucket_ts=_landed(late))
    refresh_stats(spark, path)
    b = read_bronze_readings(spark, path, since_ms=int((CUTOFF - _dt.datetime(1970, 1, 1)).total_seconds()) * 1000)
    return b.select("event_time", "device_id", *MEASURES, "occupancy", "dt", "hour")


def stream_state_audit(spark, sf):
    """STR-9: the fold's state after a restart, read through the state data source, per device and rule."""
    from roomlake.streaming.alerts import stream_alerts, union_inputs
    from roomlake.streaming.audit import read_fold_state
    from roomlake.streaming.jobs import config_stream, file_values, reading_stream

    root = scratch_path(spark, "stream-audit")
    r = testdata.readings(spark, sf)
    _config_lines(spark, sf).write.text(f"{root}/c/0")
    for i in range(2):
        half = r.where((F.col("t") < _MIDDLE_MS) if i == 0 else (F.col("t") >= _MIDDLE_MS))
        reading_messages(half).select("value").write.text(f"{root}/r/{i}")
        fold = stream_alerts(union_inputs(reading_stream(file_values(spark, f"{root}/r/*")),
                                          config_stream(file_values(spark, f"{root}/c/*"))), CONTRACT_RULES, "event")
        fold.writeStream.format("noop").option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start() \
            .awaitTermination()
    return read_fold_state(spark, f"{root}/ckpt", CONTRACT_RULES).where(F.col("last_reading_ms").isNotNull()).select(
        "device_id", "rule", "last_reading_ms", F.col("last_alert_ms").alias("last_alert_ms"))


def gold_from_bronze(spark, sf):
    """WIN-1 + AGG-1/2 in one exchange: repeated and altered bronze deliveries straight to the hourly roll-up."""
    b = bronze_readings_rows(spark, sf)
    g = gold.rollup_from_bronze(b.unionByName(b).unionByName(bronze_readings_rows(spark, sf, 0.5)), hot_rows=3)
    return g.select("pk_sensor_device_hour_id", "device_id", _ts("hour_ts", HOUR_FMT), _r4("avg_temperature"),
                    "min_temperature", "max_temperature", _r4("avg_humidity"), _r4("occupancy_rate"))


def check_planted_failures(spark, sf):
    """CHK-1/2 with failures to find: every 97th reading twice, every 101st without key; checked whole, and by
    changed dates after a first look at the clean table."""
    from roomlake.operators.check_state import LAKE_KEYS, check_table

    path, name = scratch_path(spark, "checked"), "silver_iot_sensor_readings"
    clean = silver.silver_readings(bronze_readings_rows(spark, sf))
    tables.upsert(spark, path, clean, "pk_sensor_event_id", "event_date")
    check_table(spark, path, name, LAKE_KEYS[name])
    ms = F.unix_millis("event_ts")
    planted = tables.read_table(spark, path)
    planted = (planted.unionByName(planted.where(ms % 97 == 0))
               .withColumn("pk_sensor_event_id", F.when(ms % 101 != 0, F.col("pk_sensor_event_id"))))
    # the last days only, so that the others keep their result
    (planted.where(F.col("event_date") >= F.lit(_PLANTED_FROM).cast("date")).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path))
    changed = check_table(spark, path, name, LAKE_KEYS[name])
    whole = check_table(spark, path, name, LAKE_KEYS[name], exact=True)
    rows = [(how, check, r[check]) for how, r in (("changed", changed), ("whole", whole)) for check in ("unique", "not_null")]
    return spark.createDataFrame(rows, "how string, check_name string, failures long")


def bronze_compacted(spark, sf):
    """SRC-3 + SNK-2: bronze written as many small files, closed folders compacted and purged, all rows read back."""
    from roomlake.sources.compaction import compact, purge, read_compacted

    path = scratch_path(spark, "bronze-small")
    rows = bronze_readings_rows(spark, sf)
    for i in range(2):                                # two deliveries a folder
        write_bronze(rows.where(F.col("eventTimeMillis") % 2 == i), path, bucket_ts=_landed())
    compact(spark, path, BRONZE_READING, CUTOFF)
    purge(spark, path)
    return read_compacted(spark, path, BRONZE_READING).select("event_time", "device_id", "temperature", "dt", "hour")


def required_fields(spark, sf):
    """FLT-1 + FLT-7 + PRJ-4: bronze with devices and times missing or unparseable, and devices without config."""
    b = bronze_readings_rows(spark, sf)
    ms = F.col("eventTimeMillis")
    torn = (b.withColumn("device_id", F.when(ms % 13 != 0, F.col("device_id")))
             .withColumn("event_time", F.when(ms % 17 == 0, F.lit(None)).when(ms % 19 == 0, F.lit("yesterday noon"))
                         .otherwise(F.col("event_time"))))
    updates = testdata.config_updates(spark, sf).where(~F.col("device_id").endswith("3"))
    s = silver.silver_readings(torn)
    return join_config(s, latest_config(updates)).select("pk_sensor_event_id", "device_id", _ts("event_ts"), "temperature",
                                                         "user_id", "temperature_warning_threshold")


def malformed_messages(spark, sf):
    """PRJ-1/3: readings of which some are not JSON, lack a time, have no offset, hold text, extra keys or no number."""
    r = testdata.readings(spark, sf)
    kind = F.pmod(F.col("event_id"), F.lit(10))
    body = lambda time, temp, more="": F.concat(
        F.lit('{"device_id":"'), F.col("device_id"), F.lit('",'), time, F.lit('"temperature":'), temp, F.lit(more + "}"))
    iso = F.concat(F.lit('"event_time":"'), F.col("event_time"), F.lit('",'))
    temp = F.col("temperature").cast("string")
    value = (F.when(kind == 0, F.lit("not json at all")).when(kind == 1, body(F.lit(""), temp))
              .when(kind == 2, body(F.concat(F.lit('"event_time":"'), F.regexp_replace("event_time", "Z$", ""), F.lit('",')), temp))
              .when(kind == 3, body(F.concat(F.lit('"event_time":"'), F.regexp_replace("event_time", "Z$", "+01:00"), F.lit('",')), temp))
              .when(kind == 4, body(iso, F.concat(F.lit('"'), temp, F.lit('"'))))
              .when(kind == 5, body(iso, F.lit('"warm"'))).when(kind == 6, body(iso, F.lit('"NaN"')))
              .when(kind == 7, body(iso, temp, ',"firmware":"2.1","tags":[1,2]')).otherwise(body(iso, temp)))
    p = parse_readings(r.select("event_id", value.alias("value")))
    return p.select("event_id", F.col("_corrupt").alias("corrupt"),
                    F.when(F.col("_corrupt"), F.lit(-1)).otherwise(F.col("eventTimeMillis")).alias("event_time_ms"),
                    F.when(F.col("_corrupt"), F.lit(-1.0)).otherwise(F.col("temperature")).alias("temperature"))


def silver_upsert_inserts(spark, sf):
    """SNK-5, both branches: a merge that updates the keys it knows and inserts those it does not."""
    path = scratch_path(spark, "silver-inserts")
    b = bronze_readings_rows(spark, sf)
    tables.upsert(spark, path, silver.silver_readings(b.where(F.col("eventTimeMillis") % 3 != 0)), "pk_sensor_event_id", "event_date")
    second = silver.silver_readings(bronze_readings_rows(spark, sf, 1.0).where(F.col("eventTimeMillis") % 3 != 1),
                                    now=NOW, incremental=True)
    tables.upsert(spark, path, second, "pk_sensor_event_id", "event_date")
    return tables.read_table(spark, path).select("pk_sensor_event_id", _ts("event_ts"), "temperature")


def gold_slice_emptied(spark, sf):
    """SNK-6: a slice whose later dates get no rows any more; AGG-5 of what is left, and of an empty table."""
    path = scratch_path(spark, "gold-emptied")
    s = _silver(spark, sf)
    first = gold.sensor_hourly_metrics(s).withColumn("hour_date", utc_date("hour_ts"))
    tables.replace_slice(spark, path, first, "hour_ts", CUTOFF)
    left = s.where(F.col("event_date") <= F.lit(CUTOFF.date().isoformat()).cast("date"))
    second = gold.sensor_hourly_metrics(left, now=NOW, incremental=True).withColumn("hour_date", utc_date("hour_ts"))
    tables.replace_slice(spark, path, second, "hour_ts", CUTOFF)
    t = tables.read_table(spark, path)
    per_day = t.groupBy(F.col("hour_date").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("device_hours"))
    mark = lambda df: tables.high_water_mark(df, "hour_ts", lookback="1 hour").select(_ts("hwm", HOUR_FMT))
    return (per_day.unionByName(mark(t).select(F.concat(F.lit("left until "), "hwm").alias("day"), F.lit(0).cast("long").alias("device_hours")))
            .unionByName(mark(t.where("1 = 0")).select(F.concat(F.lit("empty until "), "hwm").alias("day"),
                                                     F.lit(0).cast("long").alias("device_hours"))))


def custom_rule_alerts(spark, sf):
    """STR-8: a fourth rule of the user's own, with an ``or`` and a number, beside the three."""
    from roomlake.settings import Compare, RuleSpec

    own = RuleSpec("CO2_OR_HEAT", "VIOLATION", "co2",
                   Compare("co2", ">=", 480) | (Compare("temperature", ">", 45.0) & Compare("occupancy", "=", 1)),
                   "co2", "temperature_violation_threshold", 12 * HOUR_S, 24 * HOUR_S)
    return detect_breaches(joined(spark, sf), (*CONTRACT_RULES, own), tie_cols=TIE)


def _lake(spark, sf) -> tuple[str, "DataFrame"]:
    """JOB-2 then JOB-1: messages through the live job to bronze and two sinks, then a lakehouse run over that bronze."""
    from roomlake.plans.lakehouse import LakePaths, run_lakehouse
    from roomlake.streaming.jobs import file_values, message_file_sink, start_alert_job

    root = scratch_path(spark, "lake")
    r = testdata.readings(spark, sf)
    _config_lines(spark, sf).write.text(f"{root}/c/0")
    reading_messages(r).select("value").write.text(f"{root}/r/0")
    seen = f"{root}/second-sink"
    for q in start_alert_job(spark, file_values(spark, f"{root}/r/*"), file_values(spark, f"{root}/c/*"), f"{root}/bronze/readings",
                             f"{root}/bronze/alerts", f"{root}/ck", rules=CONTRACT_RULES, trigger={"availableNow": True},
                             alert_sinks=(message_file_sink(f"{root}/messages"),
                                          lambda a, i: a.drop("dt", "hour", "batch").write.mode("overwrite").json(f"{seen}/{i}")),
                             alert_time_from="event"):
        q.awaitTermination()
    run_lakehouse(spark, LakePaths(f"{root}/bronze/readings", f"{root}/bronze/alerts", f"{root}/lake"), now=NOW)
    return root, seen


def _totals(spark, parts: dict) -> DataFrame:
    """(name, n, total) of each frame's rows and the sum of one of its columns.

    Six million epoch milliseconds already pass 64 bits, so the sums are exact decimals; ``total`` leaves as long
    wherever all of them fit one, as a decimal(38,0) beyond that.
    """
    rows = []
    for name, (df, column) in parts.items():                 # a row each
        got = df.agg(F.count(F.lit(1)).alias("n"), F.sum(column.cast("decimal(20,0)")).cast("decimal(38,0)").alias("total")).first()
        rows.append((name, got.n, got.total))
    if all(total is None or abs(total) < 2 ** 63 for _, _, total in rows):
        return spark.createDataFrame([(name, n, None if total is None else int(total)) for name, n, total in rows],
                                     "name string, n long, total long")
    return spark.createDataFrame(rows, "name string, n long, total decimal(38,0)")


def lakehouse_run(spark, sf):
    """JOB-2, SNK-1 (file twin) / SNK-3 / SRC-4, JOB-1: rows of the five tables, of both sinks, and what they add up to."""
    root, seen = _lake(spark, sf)
    t = lambda name: tables.read_table(spark, f"{root}/lake/{name}")
    return _totals(spark, {
        "silver_readings": (t("silver_iot_sensor_readings"), F.unix_millis("event_ts")),
        "silver_alerts": (t("silver_threshold_breached_alerts"), F.col("window_end_ms")),
        "gold_metrics": (t("gold_sensor_hourly_metrics"), F.unix_seconds("hour_ts")),
        "gold_occupancy": (t("gold_hourly_occupancy_rate"), F.unix_seconds("hour_ts")),
        "gold_breaches": (t("gold_hourly_breach_counts"), F.col("breach_count")),
        "sink_messages": (spark.read.schema("key string, value string").json(f"{root}/messages"),
                          F.get_json_object("value", "$.window_start_ms").cast("long")),
        "sink_rows": (spark.read.schema(ALERT_MESSAGE).json(f"{seen}/*"), F.col("window_start_ms"))})


def stream_hourly_rollup_q(spark, sf):
    """STR-1 + STR-7: watermark de-dup and hourly rollup, complete hours only."""
    from roomlake.streaming.jobs import file_values, reading_stream, stream_hourly_rollup

    root = scratch_path(spark, "stream-rollup")
    b = testdata.readings(spark, sf)
    msgs = reading_messages(b).select("value")
    msgs.unionByName(msgs).write.text(f"{root}/in/0")     # every reading delivered twice
    roll = stream_hourly_rollup(reading_stream(file_values(spark, f"{root}/in/*")))
    q = (roll.writeStream.format("parquet").option("path", f"{root}/out")
             .option("checkpointLocation", f"{root}/ckpt").outputMode("append")
             .trigger(availableNow=True).start())
    q.awaitTermination()
    t = spark.read.parquet(f"{root}/out")
    cols = [_r4(c) if c.startswith("avg_") or c == "occupancy_rate" else F.col(c)
            for c in t.columns if c not in ("device_id", "hour_ts")]
    return t.select("device_id", _ts("hour_ts", HOUR_FMT), *cols)


def _shipped(fn):
    def run(spark, sf):
        ship_package(spark)
        return fn(spark, sf)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


_QUERIES = {
    "readings_projection": readings_projection,
    "reading_json_roundtrip": reading_json_roundtrip,
    "config_json_parse": config_json_parse,
    "silver_readings": silver_readings_q,
    "silver_alerts": silver_alerts_q,
    "gold_sensor_hourly_metrics": gold_sensor_hourly_metrics_q,
    "gold_hourly_occupancy_rate": gold_hourly_occupancy_rate_q,
    "gold_hourly_breach_counts": gold_hourly_breach_counts_q,
    "latest_config_by_device": latest_config_by_device,
    "reading_config_join": reading_config_join,
    "rule_no_occ_light": _rule_q(0),
    "rule_temp_warning": _rule_q(1),
    "rule_temp_violation": _rule_q(2),
    "sustained_episodes": sustained_episodes,
    "threshold_alerts": threshold_alerts,
    "threshold_alerts_per_user": threshold_alerts_per_user,
    "threshold_alerts_max_gap": threshold_alerts_max_gap,
    "reading_config_in_force": reading_config_in_force,
    "replay_alerts": replay_alerts,
    "alert_messages": alert_messages_q,
    "incremental_lookback": incremental_lookback,
    "high_water_mark": high_water_mark_q,
    "silver_upsert": silver_upsert,
    "gold_slice_replace": gold_slice_replace,
    "check_unique_not_null": check_unique_not_null,
    "bronze_roundtrip": bronze_roundtrip,
    "stream_alerts": stream_alerts_q,
    "bronze_since": bronze_since,
    "bronze_compacted": bronze_compacted,
    "gold_from_bronze": gold_from_bronze,
    "gold_slice_emptied": gold_slice_emptied,
    "silver_upsert_inserts": silver_upsert_inserts,
    "check_planted_failures": check_planted_failures,
    "required_fields": required_fields,
    "malformed_messages": malformed_messages,
    "custom_rule_alerts": custom_rule_alerts,
    "lakehouse_run": lakehouse_run,
    "stream_state_audit": stream_state_audit,
    "stream_silver": stream_silver_q,
    "stream_late_readings": stream_late_readings,
    "stream_alerts_split": stream_alerts_split,
    "stream_hourly_rollup": stream_hourly_rollup_q,
}

QUERIES = {name: _shipped(fn) for name, fn in _QUERIES.items()}
