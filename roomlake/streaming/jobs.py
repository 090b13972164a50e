"""Stream sources, sinks and the wiring of the live job (SRC-1/2, SNK-1..4,
STR-1, STR-7, JOB-2).

Readings are consumed by two independent queries with separate
checkpoints -- the bronze copy and the alerting fold -- so a failure of one
does not stall the other.  The config stream is read from the earliest
offset (all history), the readings stream from the latest, as the source
does.  Kafka needs the ``spark-sql-kafka`` package on the classpath; it is
not in this environment, so the Kafka wrappers are exercised only through
their file-stream twins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roomlake.functions.columns import iso_instant, iso_utc_string, utc_date, utc_hour
from roomlake.functions.messages import alert_messages, parse_configs, parse_readings, quarantine
from roomlake.operators import gold
from roomlake.schemas import BRONZE_READING
from roomlake.streaming.alerts import stream_alerts, union_inputs


# --- sources -------------------------------------------------------------

# Rate limit of the *readings* source: a device's rows of one micro-batch are
# folded in one Python call, so this bounds that call's memory.  It delays
# readings, it drops none.  The config source must have no limit: the first
# micro-batch then holds the whole config history, and a reading whose device's config came
# later would be dropped as unknown (FLT-7).
DEFAULT_MAX_OFFSETS_PER_TRIGGER = 2_000_000


def kafka_values(spark: SparkSession, servers: str, topic: str, starting: str,
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """SRC-1/2: topic -> (key, value) strings; no rate limit unless one is given."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return (r.load()
            .select(F.col("key").cast("string").alias("key"),
                    F.col("value").cast("string").alias("value")))


def file_values(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """File-stream twin of a topic: one JSON message per line."""
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def reading_stream(values: DataFrame, mode: str = "quarantine") -> DataFrame:
    """Parsed readings with ``event_ts``; malformed lines are dropped here and
    kept by ``corrupt_messages``, or fail the query (``mode="failfast"``)."""
    good, _ = quarantine(parse_readings(values), mode)
    return good.withColumn("event_ts", iso_instant("event_time"))


def config_stream(values: DataFrame, mode: str = "quarantine", thresholds=()) -> DataFrame:
    return quarantine(parse_configs(values, thresholds=thresholds), mode)[0]


def corrupt_messages(readings: DataFrame, configs: DataFrame | None = None) -> DataFrame:
    """The raw lines that ``reading_stream`` / ``config_stream`` reject: value, kind, received_at."""
    def bad(values: DataFrame, parse, kind: str) -> DataFrame:
        parsed = parse(values.withColumn("raw", F.col("value")))
        return quarantine(parsed)[1].select(
            F.col("raw").alias("value"), F.lit(kind).alias("kind"),
            iso_utc_string(F.current_timestamp(), fractional=True).alias("received_at"))

    out = bad(readings, parse_readings, "reading")
    return out if configs is None else out.unionByName(bad(configs, parse_configs, "config"))


# --- sinks ---------------------------------------------------------------

def bronze_query(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                 name: str | None = None) -> StreamingQuery:
    """SNK-2/3: NDJSON under dt=YYYY-MM-DD/hour=HH of the processing time (UTC).

    Spark's file sink commits through its metadata log: exactly once.
    """
    out = (df.withColumn("_now", F.current_timestamp())
             .withColumn("dt", utc_date("_now").cast("string"))
             .withColumn("hour", F.lpad(utc_hour("_now").cast("string"), 2, "0")).drop("_now"))
    w = (out.writeStream.format("json").partitionBy("dt", "hour")
            .option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append"))
    if name:
        w = w.queryName(name)
    return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


# Alert sinks are functions of one micro-batch: (alerts, batch_id) -> None.

def kafka_alert_sink(servers: str, topic: str):
    """SNK-1: keyed alert messages with headers, at least once."""
    def write(alerts: DataFrame, batch_id: int) -> None:
        (alert_messages(alerts).write.format("kafka")
             .option("kafka.bootstrap.servers", servers).option("topic", topic)
             .option("includeHeaders", "true").save())
    return write


def message_file_sink(path: str):
    """File twin of ``kafka_alert_sink``: key and value as NDJSON, one folder per micro-batch,
    written anew when a batch is retried."""
    def write(alerts: DataFrame, batch_id: int) -> None:
        (alert_messages(alerts).select("key", "value").write.mode("overwrite")
             .json(f"{path.rstrip('/')}/batch={batch_id}"))
    return write


def console_sink(alerts: DataFrame, batch_id: int) -> None:
    """SNK-4: debug print of the first rows."""
    alerts.show(truncate=False)


def console_query(df: DataFrame, checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """SNK-4: debug print of any stream; its state lives in ``checkpoint``."""
    w = df.writeStream.format("console").option("truncate", False)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def alert_query(alerts: DataFrame, bronze_path: str, checkpoint: str, sinks=(),
                trigger: dict | None = None) -> StreamingQuery:
    """One alert stream for all sinks: the fold runs once per micro-batch, and its rows go to the
    bronze table and to every sink, so all hold the same alerts with the same ``alert_time``.

    Bronze files sit under dt / hour / batch (query and batch id): a batch that is retried
    replaces its own files.
    """
    stamped = (alerts.withColumn("_now", F.current_timestamp())
                     .withColumn("dt", utc_date("_now").cast("string"))
                     .withColumn("hour", F.lpad(utc_hour("_now").cast("string"), 2, "0")).drop("_now"))

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "query"
        batch = batch.persist()
        try:
            (batch.withColumn("batch", F.lit(f"{query}-{batch_id}")).write.mode("overwrite")
                  .option("partitionOverwriteMode", "dynamic").partitionBy("dt", "hour", "batch").json(bronze_path))
            for sink in sinks:
                sink(batch.drop("dt", "hour"), batch_id)
        finally:
            batch.unpersist()

    return (stamped.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
                   .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


# --- the live job --------------------------------------------------------

def start_alert_job(spark: SparkSession, readings_values: DataFrame, config_values: DataFrame,
                    bronze_readings: str, bronze_alerts: str, checkpoint_root: str,
                    rules=None, trigger: dict | None = None, alert_sinks=(),
                    alert_time_from: str = "batch",
                    quarantine_path: str | None = None,
                    max_gap_s: int | None = None, malformed: str = "quarantine") -> list[StreamingQuery]:
    """Start the bronze-readings copy and the alerting query.

    ``alert_sinks`` get every micro-batch of alerts besides the bronze alerts table
    (``kafka_alert_sink`` in production).  With
    ``quarantine_path`` a third query keeps the malformed reading and config lines;
    ``malformed="failfast"`` stops the queries at the first one instead.
    """
    from roomlake.settings import DEFAULT_RULES, threshold_columns

    rules = tuple(rules or DEFAULT_RULES)
    root = checkpoint_root.rstrip("/")
    readings = reading_stream(readings_values, malformed)
    bronze = readings.select(*[f.name for f in BRONZE_READING.fields])
    queries = [bronze_query(bronze, bronze_readings, f"{root}/bronze_readings", trigger)]
    thresholds = threshold_columns(rules)
    configs = config_stream(config_values, malformed, thresholds)
    alerts = stream_alerts(union_inputs(readings, configs, thresholds), rules, alert_time_from,
                           max_gap_s=max_gap_s, thresholds=thresholds)
    queries.append(alert_query(alerts, bronze_alerts, f"{root}/alerts", alert_sinks, trigger))
    if quarantine_path:
        queries.append(bronze_query(corrupt_messages(readings_values, config_values), quarantine_path,
                                    f"{root}/quarantine", trigger))
    return queries


# --- STR-7: streaming silver / gold ------------------------------------

def stream_hourly_rollup(readings: DataFrame, delay: str = "30 seconds") -> DataFrame:
    """Watermarked de-dup and hourly device rollup; append mode emits an hour
    once the watermark passes its end, later rows for it are dropped."""
    dedup = (readings.withWatermark("event_ts", delay)
                     .dropDuplicatesWithinWatermark(["device_id", "event_ts"]))
    aggs = []
    for m in gold.METRIC_MEASURES:
        aggs += [F.avg(m).alias(f"avg_{m}"), F.min(m).alias(f"min_{m}"),
                 F.max(m).alias(f"max_{m}")]
    aggs += [F.avg("humidity_ratio").alias("avg_humidity_ratio"),
             F.avg(F.col("occupancy").cast("double")).alias("occupancy_rate"),
             F.count(F.lit(1)).alias("readings")]
    return (dedup.groupBy(F.window("event_ts", "1 hour").alias("w"), "device_id").agg(*aggs)
                 .select("device_id", F.col("w.start").alias("hour_ts"),
                         *[a for a in [f"{x}_{m}" for m in gold.METRIC_MEASURES
                                       for x in ("avg", "min", "max")]],
                         "avg_humidity_ratio", "occupancy_rate", "readings"))
