"""STR-9: what the alert fold's state store holds, and whether it is what the inputs give.

``read_fold_state`` reads the state of the last committed micro-batch through Spark's state data source, one row per
device and rule.  ``audit_states`` folds all inputs anew with the batch detector, which splits hot devices, and returns the
devices and rules whose stored state differs (none, if readings came in event order and configs before them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomlake.operators.breaches import detect_breaches
from roomlake.settings import DEFAULT_RULES
from roomlake.streaming.alerts import state_fields
from roomlake.streaming.split import STATE

COLUMNS = ["device_id", "rule", "last_reading_ms", "episode_start_ms", "last_alert_ms"]


def read_fold_state(spark: SparkSession, checkpoint: str, rules=DEFAULT_RULES, batch_id: int | None = None) -> DataFrame:
    """(device_id, rule, last_reading_ms, episode_start_ms, last_alert_ms) of the fold with this checkpoint.

    ``batch_id`` reads the state as an earlier micro-batch left it, while the store still keeps it.
    """
    r = spark.read.format("statestore")
    if batch_id is not None:
        r = r.option("batchId", batch_id)
    fields = state_fields(len(tuple(rules)))
    # a state row holds a bucket of devices, their numbers one after another
    one = r.load(checkpoint).select("value.groupState.*").select("nums", F.size("device_id").alias("n"),
                                                                 F.posexplode("device_id").alias("at", "device_id"))

    def number(name: str) -> Column:
        v = F.get("nums", (F.col("at") * F.size("nums") / F.col("n")).cast("int") + fields.index(name))
        return F.when(~F.isnan(v), v.cast("long"))

    each = F.array(*[F.struct(F.lit(rule.name).alias("rule"), number("t_last").alias("last_reading_ms"),
                              number(f"s{i}").alias("episode_start_ms"), number(f"x{i}").alias("last_alert_ms"))
                     for i, rule in enumerate(rules)])
    return one.select("device_id", F.explode(each).alias("r")).select("device_id", "r.*")


def expected_states(joined: DataFrame, rules=DEFAULT_RULES, tie_cols=(), **detector) -> DataFrame:
    """The state that readings joined with their configs leave, one row per device and rule."""
    rules = tuple(rules)
    n = len(rules)
    nothing = joined.sparkSession.createDataFrame([], STATE)
    left = detect_breaches(joined, rules, ("device_id",), tie_cols=tie_cols, initial=nothing, **detector).where("rule IS NULL")
    each = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.get("_state", F.lit(0)).alias("last_reading_ms"),
                              F.get("_state", F.lit(1 + i)).alias("episode_start_ms"),
                              F.get("_state", F.lit(1 + n + i)).alias("last_alert_ms")) for i, r in enumerate(rules)])
    return left.select("device_id", F.explode(each).alias("r")).select("device_id", "r.*")


def audit_states(stored: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, ``side`` telling which; devices that never had a reading are left out."""
    stored = stored.where(F.col("last_reading_ms").isNotNull()).select(*COLUMNS)
    expected = expected.select(*COLUMNS)
    return (stored.exceptAll(expected).withColumn("side", F.lit("stored"))
                  .unionByName(expected.exceptAll(stored).withColumn("side", F.lit("expected"))))
