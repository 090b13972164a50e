"""One rule language for batch and stream."""
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from roomlake.operators.breaches import detect_breaches
from roomlake.operators.config import join_config, latest_config
from roomlake.functions.messages import parse_configs, parse_readings
from roomlake.settings import DEFAULT_RULES, Compare, RuleSpec, threshold_columns, with_timing
from roomlake.sources.files import read_bronze_alerts
from roomlake.streaming.jobs import file_values, start_alert_job
from test_streaming import config_msg, reading_msg
from traces import CFG, every

HUMID = RuleSpec("HUMID", "WARNING", "humidity",
                 (Compare("humidity", ">=", "humidity_threshold") & Compare("temperature", "<>", 0)) | Compare("co2", ">", 5000),
                 "humidity", "humidity_threshold", 300, 600)


def test_conditions_mean_the_same_in_batch_and_stream(spark):
    rows = [(float(a), b) for a in (0, 1, 2) for b in (None, 0.0, 1.0, 2.0)] + [(None, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    cols = {k: np.array([np.nan if r[i] is None else r[i] for r in rows]) for i, k in enumerate("ab")}
    for op in ("=", "<>", "<", "<=", ">", ">="):
        for c in (Compare("a", op, "b"), Compare("a", op, 1), Compare("a", op, "b") & Compare("b", ">", 0),
                  Compare("a", op, "b") | Compare("b", "=", 0)):
            assert [r[0] for r in df.select(c.column()).collect()] == c.mask(cols).tolist(), c


@pytest.mark.parametrize("make", [lambda: Compare("a", "LIKE", 1), lambda: Compare("a b", "=", 1), lambda: Compare("a", "=", None),
                                  lambda: RuleSpec("r", "s", "m", "a > 1", "a", "b", 1, 1),
                                  lambda: RuleSpec("r", "s", "m", Compare("a", ">", 1), "a + 1", "b", 1, 1)])
def test_rules_are_checked_when_made(make):
    with pytest.raises((TypeError, ValueError)):
        make()


def test_rule_with_a_threshold_of_its_own(spark, tmp_path):
    root = str(tmp_path)
    rules = with_timing(DEFAULT_RULES) + (HUMID,)
    assert threshold_columns(rules)[-1] == "humidity_threshold"
    os.makedirs(f"{root}/r")
    os.makedirs(f"{root}/c")
    cfg = config_msg(dict(CFG, humidity_threshold=40.0), 0)
    lines = [reading_msg(dict(r, humidity=45.0)) for r in every(0, 1800, temp=31)]
    for sub, text in (("c", cfg), ("r", "\n".join(lines))):
        with open(f"{root}/{sub}/0.json", "w") as f:
            f.write(text + "\n")
    for q in start_alert_job(spark, file_values(spark, f"{root}/r"), file_values(spark, f"{root}/c"), f"{root}/br", f"{root}/ba",
                             f"{root}/ck", rules, trigger={"availableNow": True}, alert_time_from="event"):
        q.awaitTermination()
    key = ["device_id", "rule", "window_start_ms", "window_end_ms", "observed_value", "threshold_value"]
    live = sorted(tuple(r) for r in read_bronze_alerts(spark, f"{root}/ba").select(key).collect())
    readings = parse_readings(spark.read.text(f"{root}/r")).withColumn("t", F.col("eventTimeMillis"))
    configs = latest_config(parse_configs(spark.read.text(f"{root}/c"), thresholds=("humidity_threshold",)))
    batch = sorted(tuple(r) for r in detect_breaches(join_config(readings, configs), rules, tie_cols=()).select(key).collect())
    assert live == batch and {"HUMID", "TEMP_WARNING"} <= {r[1] for r in live}


def test_nan_meets_no_condition(spark):
    """Batch and stream agree on missing values: neither NULL nor NaN is above or below anything."""
    import numpy as np

    nan = float("nan")
    rows = [(29.0, 1.0), (nan, 1.0), (None, 1.0), (29.0, nan), (27.0, 1.0)]
    df = spark.createDataFrame(rows, "temperature double, occupancy double")
    for cond in (Compare("temperature", ">", 28.0), Compare("temperature", "<>", 1.0), Compare("temperature", ">", "occupancy"),
                 Compare("temperature", "<", 28) | Compare("occupancy", "=", 1)):
        cols = {c: np.array([nan if r[i] is None else r[i] for r in rows]) for i, c in enumerate(("temperature", "occupancy"))}
        assert [r[0] for r in df.select(cond.column()).collect()] == cond.mask(cols).tolist()
