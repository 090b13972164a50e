"""The live alert job for hot devices (JOIN-2, STR-2..6, STR-9): micro-batches folded by the batch detector.

``alerts.py`` folds all of a device's rows of one micro-batch in one Python call.  Here a micro-batch is split by
(device, time) ranges instead, as history is: a device that sends a third of all readings spans several tasks, and a task
holds one Arrow batch, whatever the device.  Each device's run starts from the state row it left behind, so the alerts
equal those of one fold over all micro-batches.

Configs never reach Python.  They are a changelog table, reduced to the latest per device by an aggregation and joined with the
readings (adaptive: broadcast if its measured bytes allow).  ``seed_configs`` puts a whole history in before the stream
starts; devices that only have a config cost a row of that table.

Both logs live under ``root`` in one folder per micro-batch, which a retried batch writes anew and earlier batches never
touch: configs and states are read as of the batch, so a retry gives the same rows.  Every ``compact_every`` batches a
log is reduced to one row a key, and the folders that this replaces go once the next batch has begun.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roomlake.functions.columns import epoch_millis, iso_instant, iso_utc_string, utc_string
from roomlake.operators.breaches import detect_breaches
from roomlake.operators.config import join_config, latest_config
from roomlake.operators.tables import _fs
from roomlake.schemas import ALERT_MESSAGE
from roomlake.settings import DEFAULT_RULES, MEASURES, threshold_columns

STATE = T.StructType([T.StructField("device_id", T.StringType()), T.StructField("_state", T.ArrayType(T.LongType())),
                      T.StructField("batch", T.LongType())])


class KeyedLog:
    """A changelog in Parquet: ``delta/<batch>`` folders, and ``base/<batch>`` ones that hold all up to that batch."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, reduce: Callable[[DataFrame], DataFrame]):
        self.spark, self.root, self.schema, self.reduce = spark, root.rstrip("/"), schema, reduce

    def _batches(self, kind: str) -> list[int]:
        fs, p = _fs(self.spark, f"{self.root}/{kind}")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        # a folder counts once its job has committed
        return sorted(int(x) for x in names if fs.exists(_fs(self.spark, f"{self.root}/{kind}/{x}/_SUCCESS")[1]))

    def append(self, rows: DataFrame, batch: int) -> None:
        rows.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self.root}/delta/{batch}")

    def latest(self, below: int) -> DataFrame:
        """The reduced rows of all batches before ``below``."""
        base = [b for b in self._batches("base") if b < below]
        start = base[-1] if base else None
        paths = [f"{self.root}/base/{start}"] if base else []
        paths += [f"{self.root}/delta/{b}" for b in self._batches("delta") if b < below and (start is None or b > start)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.reduce(self.spark.read.schema(self.schema).parquet(*paths)).select(*self.schema.fieldNames())

    def compact(self, batch: int) -> None:
        """Write the base of all up to ``batch``, and drop what the base before it already replaced."""
        older = [b for b in self._batches("base") if b < batch]
        self.latest(batch + 1).write.mode("overwrite").parquet(f"{self.root}/base/{batch}")
        for kind in ("base", "delta"):
            for b in self._batches(kind):
                if older and (b < older[-1] or kind == "delta" and b == older[-1]):
                    fs, p = _fs(self.spark, f"{self.root}/{kind}/{b}")
                    fs.delete(p, True)


def _config_schema(thresholds) -> T.StructType:
    return T.StructType([T.StructField("device_id", T.StringType()), T.StructField("user_id", T.StringType()),
                         T.StructField("updatedAtMillis", T.LongType()), T.StructField("seq", T.LongType()),
                         *[T.StructField(c, T.DoubleType()) for c in thresholds]])


def config_log(spark: SparkSession, root: str, thresholds) -> KeyedLog:
    return KeyedLog(spark, f"{root.rstrip('/')}/configs", _config_schema(thresholds),
                    lambda rows: latest_config(rows, order=("updatedAtMillis", "seq", "user_id")))


def state_log(spark: SparkSession, root: str) -> KeyedLog:
    """The fold state per device, as the newest batch that had one of its readings left it."""
    newest = F.max_by("_state", "batch").alias("_state"), F.max("batch").alias("batch")
    return KeyedLog(spark, f"{root.rstrip('/')}/states", STATE, lambda rows: rows.groupBy("device_id").agg(*newest))


def _configs(configs: DataFrame, thresholds) -> DataFrame:
    ms = (F.col("updatedAtMillis") if "updatedAtMillis" in configs.columns
          else epoch_millis("updated_ts") if "updated_ts" in configs.columns else epoch_millis(iso_instant("updated_at")))
    seq = F.col("seq").cast("long") if "seq" in configs.columns else F.lit(None).cast("long")
    return configs.where(F.col("device_id").isNotNull()).select(
        "device_id", F.col("user_id").cast("string").alias("user_id"), ms.alias("updatedAtMillis"), seq.alias("seq"),
        *[F.col(c).cast("double").alias(c) for c in thresholds])


def seed_configs(spark: SparkSession, root: str, configs: DataFrame, rules=DEFAULT_RULES) -> None:
    """The config history before the stream starts, reduced to the latest per device."""
    thresholds = threshold_columns(tuple(rules))
    log = config_log(spark, root, thresholds)
    log.append(log.reduce(_configs(configs, thresholds)), -1)


def _one_stream(readings: DataFrame, configs: DataFrame | None, thresholds) -> DataFrame:
    ts = F.col("event_ts") if "event_ts" in readings.columns else iso_instant("event_time")
    t = F.col("t") if "t" in readings.columns else epoch_millis(ts)
    batch = epoch_millis(F.current_timestamp()).alias("batch_ms")     # a retried batch has the same
    out = (readings.where(F.col("device_id").isNotNull())
                   .select(F.lit(True).alias("reading"), "device_id", t.cast("long").alias("t"), F.unix_micros(ts).alias("tie"),
                           *[F.col(c).cast("double").alias(c) for c in MEASURES], batch)
                   .where(F.col("t").isNotNull()))
    if configs is not None:
        out = out.unionByName(_configs(configs, thresholds).select(F.lit(False).alias("reading"), "*", batch),
                              allowMissingColumns=True)
    return out


def _alert_rows(raw: DataFrame, batch_ms: int, alert_time_from: str) -> DataFrame:
    """ALERT_MESSAGE rows.  ``batch`` times: the micro-batch's plus the alert's rank in its device and rule, in
    microseconds, so that no two share a silver key and a retried batch repeats them."""
    alerts = raw.where(F.col("rule").isNotNull())
    if alert_time_from == "event":
        time = iso_utc_string(F.timestamp_millis("window_end_ms"), fractional=True)
    else:
        rank = F.row_number().over(Window.partitionBy("device_id", "rule").orderBy("window_end_ms")) - 1
        micros = F.lit(batch_ms * 1000).cast("long") + rank
        time = F.concat(utc_string(F.timestamp_micros(micros), "T", 6), F.lit("Z"))
    return alerts.select(time.alias("alert_time"), *[f.name for f in ALERT_MESSAGE.fields if f.name != "alert_time"])


def split_alert_query(spark: SparkSession, readings: DataFrame, configs: DataFrame | None, root: str, checkpoint: str,
                      sinks=(), rules=DEFAULT_RULES, trigger: dict | None = None, alert_time_from: str = "batch",
                      null_as_zero: bool = True, max_gap_s: int | None = None, num_partitions: int | None = None,
                      compact_every: int = 50) -> StreamingQuery:
    """Start the job: alerts of every micro-batch go to ``root/alerts`` (a folder per batch) and to every sink,
    a function of (alerts, batch id).

    A micro-batch's configs apply to its readings and all later ones, whichever is newest by (updated, seq);
    readings of a device without config drop and leave no state (FLT-7); readings are taken in event order within
    a micro-batch and in arrival order across them.
    """
    rules = tuple(rules)
    thresholds = threshold_columns(rules)
    root = root.rstrip("/")

    def process(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        known, states = config_log(session, root, thresholds), state_log(session, root)
        batch = batch.persist()
        try:
            rows, batch_ms = batch.agg(F.count_if("reading"), F.max("batch_ms")).first()
            if configs is not None:
                known.append(batch.where(~F.col("reading")), batch_id)
            if not rows:
                return
            own = batch.where("reading")
            joined = join_config(own.select("device_id", "t", "tie", *MEASURES), known.latest(batch_id + 1))
            before = states.latest(batch_id).join(own.select("device_id").distinct(), "device_id", "left_semi")
            raw = detect_breaches(joined, rules, ("device_id",), tie_cols=("tie",), num_partitions=num_partitions,
                                  null_as_zero=null_as_zero, max_gap_s=max_gap_s, initial=before)
            raw.write.mode("overwrite").parquet(f"{root}/raw/{batch_id}")
        finally:
            batch.unpersist()
        raw = session.read.schema(raw.schema).parquet(f"{root}/raw/{batch_id}")
        states.append(raw.where(F.col("rule").isNull()).select("device_id", "_state", F.lit(batch_id).cast("long").alias("batch")),
                      batch_id)
        _alert_rows(raw, batch_ms, alert_time_from).write.mode("overwrite").json(f"{root}/alerts/batch={batch_id}")
        for sink in sinks:
            sink(session.read.schema(ALERT_MESSAGE).json(f"{root}/alerts/batch={batch_id}"), batch_id)
        fs, p = _fs(session, f"{root}/raw/{batch_id}")
        fs.delete(p, True)
        if batch_id and batch_id % compact_every == 0:
            states.compact(batch_id)
            if configs is not None:
                known.compact(batch_id)

    return (_one_stream(readings, configs, thresholds).writeStream.foreachBatch(process)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "30 seconds"})).start())


def read_alerts(spark: SparkSession, root: str) -> DataFrame:
    """All alerts so far (ALERT_MESSAGE columns)."""
    fs, p = _fs(spark, f"{root.rstrip('/')}/alerts")
    if not fs.exists(p):
        return spark.createDataFrame([], ALERT_MESSAGE)
    return spark.read.schema(ALERT_MESSAGE).json(f"{root.rstrip('/')}/alerts").select(*ALERT_MESSAGE.fieldNames())


def read_states(spark: SparkSession, root: str, rules=DEFAULT_RULES) -> DataFrame:
    """The state now, one row per device and rule: last_reading_ms, episode_start_ms, last_alert_ms."""
    n = len(tuple(rules))
    rows = state_log(spark, root).latest(1 << 62)
    each = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.get("_state", F.lit(1 + i)).alias("episode_start_ms"),
                              F.get("_state", F.lit(1 + n + i)).alias("last_alert_ms")) for i, r in enumerate(rules)])
    return (rows.select("device_id", F.get("_state", F.lit(0)).alias("last_reading_ms"), F.explode(each).alias("r"))
                .select("device_id", "r.rule", "last_reading_ms", "r.episode_start_ms", "r.last_alert_ms"))
