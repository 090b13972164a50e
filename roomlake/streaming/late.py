"""STR-1: readings behind the watermark, counted and kept.

A watermarked rollup drops readings that come later than its delay allows.  This query says which: per micro-batch it
holds the readings against the greatest event time of the batches before it less the delay, writes those
behind it to ``rows/batch=<id>`` and the counts to ``counts/batch=<id>``.  Counts come from the same pass as the rows
(``observe``).  Each batch has its own folders, and the mark it is held against is that of earlier batches only, so a
retried batch writes the same again.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roomlake.functions.columns import epoch_millis
from roomlake.operators.tables import _fs, _read_small, _write_small

COUNTS = T.StructType([T.StructField(c, T.LongType()) for c in
                       ("batch", "readings", "late", "watermark_ms", "high_ms", "most_late_ms")])


def _high_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The greatest event time of all batches before this one."""
    fs, p = _fs(spark, f"{path}/marks")
    ids = [int(s.getPath().getName()) for s in fs.listStatus(p)] if fs.exists(p) else []
    ids = [i for i in ids if i < batch_id]
    return json.loads(_read_small(spark, f"{path}/marks/{max(ids)}"))["high_ms"] if ids else None


def account_batch(batch: DataFrame, batch_id: int, path: str, delay_ms: int) -> dict:
    """Write a micro-batch's late readings and counts; returns the counts."""
    spark, path = batch.sparkSession, path.rstrip("/")
    high = _high_before(spark, path, batch_id)
    mark = None if high is None else high - delay_ms
    t = epoch_millis("event_ts")
    # never a constant, so that the rows and their metrics stay in the plan
    late = t < F.lit(-(1 << 62) if mark is None else mark)
    seen = Observation()
    rows = (batch.where(F.col("event_ts").isNotNull())
                 .observe(seen, F.count(F.lit(1)).alias("readings"), F.count_if(late).alias("late"), F.max(t).alias("high_ms"),
                          F.max(F.when(late, F.lit(mark or 0) - t)).alias("most_late_ms"))
                 .where(late).withColumn("watermark_ms", F.lit(mark).cast("long")))
    rows.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
    got = seen.get
    highs = [h for h in (high, got["high_ms"]) if h is not None]
    counts = {"batch": batch_id, "readings": got["readings"], "late": got["late"], "watermark_ms": mark,
              "high_ms": max(highs) if highs else None, "most_late_ms": got["most_late_ms"]}
    spark.createDataFrame([tuple(counts[f] for f in COUNTS.fieldNames())], COUNTS).coalesce(1).write.mode("overwrite").json(
        f"{path}/counts/batch={batch_id}")
    _write_small(spark, f"{path}/marks/{batch_id}", json.dumps({"high_ms": counts["high_ms"]}))
    fs, old = _fs(spark, f"{path}/marks/{batch_id - 10}")       # only the newest is read
    fs.delete(old, False)
    return counts


def late_readings_query(readings: DataFrame, path: str, checkpoint: str, delay_s: int = 30,
                        trigger: dict | None = None) -> StreamingQuery:
    """Start the query over parsed readings (with ``event_ts``)."""
    def account(batch: DataFrame, batch_id: int) -> None:
        account_batch(batch, batch_id, path, delay_s * 1000)

    return (readings.writeStream.foreachBatch(account).option("checkpointLocation", checkpoint)
                    .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row per micro-batch: readings, late ones, the watermark held against, the greatest event time so far."""
    return spark.read.schema(COUNTS).json(f"{path.rstrip('/')}/counts").select(*COUNTS.fieldNames())


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """All late readings, with the watermark that they were behind."""
    return spark.read.parquet(f"{path.rstrip('/')}/rows")
