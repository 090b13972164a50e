"""STR-7: silver readings kept up to date by the live stream, replay-safe.

Each micro-batch is keyed and de-duplicated as the batch job does it, then merged into the table: of two deliveries of
one reading the greater one stays, whichever came first, so the table is that of a full build over all that has
arrived, in any order and however often a batch is repeated.

A merge is written whole to ``_staged/<batch>`` and then swapped in, one date after another.  A crash while it is
written leaves the table as it was; a crash while it is swapped leaves the rest staged, and the retried batch swaps
in what is left instead of reading a table that is half changed.  One writer per table; a file system with
rename.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roomlake.operators import silver
from roomlake.operators.tables import _fs, _write_schema, read_table, table_exists
from roomlake.schemas import MEASURES


def _swap(spark: SparkSession, path: str, staged: str, partition_col: str) -> None:
    """Move every staged partition into the table in place of its old one."""
    fs, p = _fs(spark, staged)
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if s.isDirectory() and name.startswith(f"{partition_col}="):
            target = _fs(spark, f"{path}/{name}")[1]
            fs.delete(target, True)
            if not fs.rename(s.getPath(), target):
                raise OSError(f"could not move {s.getPath()} to {target}")
    fs.delete(p, True)


def merge_batch(spark: SparkSession, path: str, rows: DataFrame, batch_id: int, key: list[str], order: list[str],
                partition_col: str) -> str:
    """Merge ``rows`` into the table at ``path``, keeping the greatest of each ``key`` by ``order``.

    Returns "merged", or "resumed" where a staged merge of this batch was found and swapped in.
    """
    path = path.rstrip("/")
    staged = f"{path}/_staged/{batch_id}"
    fs, done = _fs(spark, f"{staged}/_SUCCESS")
    state = "resumed"
    if not fs.exists(done):
        state = "merged"
        if not table_exists(spark, path):
            _write_schema(rows, path)
        rows = rows.persist()
        try:
            touched = [r[0] for r in rows.select(partition_col).distinct().collect()]      # dates of one batch
            target = read_table(spark, path).where(F.col(partition_col).isin(touched) if touched else F.lit(False))
            both = target.drop("rnk").unionByName(rows.drop("rnk"))
            merged = silver._keep_first(both, key, order).select(*target.columns)
            merged.write.mode("overwrite").partitionBy(partition_col).parquet(staged)
        finally:
            rows.unpersist()
    _swap(spark, path, staged, partition_col)
    return state


def stream_silver(readings: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start the query that merges parsed readings (event_time or event_ts, device_id, measures) into silver readings."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch.sparkSession, path, silver.silver_readings(batch), batch_id, silver.READING_KEY,
                    [*MEASURES, "occupancy"], "event_date")

    return (readings.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
                    .trigger(**(trigger or {"processingTime": "1 minute"})).start())
