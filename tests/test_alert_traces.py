import pytest
from pyspark.sql import types as T

from brute import brute_alerts
from roomlake.operators.breaches import detect_breaches
from roomlake.operators.config import join_config, latest_config
from roomlake.settings import DEFAULT_RULES
from traces import T0, TRACES

READ_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("device_id", T.StringType()),
    T.StructField("t", T.LongType()), T.StructField("temperature", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()), T.StructField("light", T.DoubleType()),
    T.StructField("co2", T.DoubleType()), T.StructField("humidity_ratio", T.DoubleType()),
    T.StructField("occupancy", T.IntegerType())])
CFG_SCHEMA = T.StructType([
    T.StructField("device_id", T.StringType()), T.StructField("user_id", T.StringType()),
    T.StructField("updated_ts", T.LongType()), T.StructField("seq", T.LongType()),
    T.StructField("temperature_warning_threshold", T.DoubleType()),
    T.StructField("temperature_violation_threshold", T.DoubleType()),
    T.StructField("no_occupancy_light_threshold", T.DoubleType())])


def frames(spark, configs, readings):
    rows = [dict(r, event_id=i) for i, r in enumerate(readings)]
    rd = spark.createDataFrame([[r[f.name] for f in READ_SCHEMA.fields] for r in rows], READ_SCHEMA)
    cf = spark.createDataFrame(
        [[c["device_id"], c["user_id"], 0, i, c["temperature_warning_threshold"],
          c["temperature_violation_threshold"], c["no_occupancy_light_threshold"]]
         for i, c in enumerate(configs)], CFG_SCHEMA)
    return rd, cf


def run_batch(spark, configs, readings, **kw):
    rd, cf = frames(spark, configs, readings)
    joined = join_config(rd, latest_config(cf))
    out = detect_breaches(joined, DEFAULT_RULES, **kw)
    return sorted((r.user_id, r.rule, r.window_end_ms, r.window_start_ms) for r in out.collect())


@pytest.mark.parametrize("num", sorted(TRACES))
def test_golden_trace_batch(spark, num):
    configs, readings, expected = TRACES[num]
    base = 0 if num == 11 else T0
    got = run_batch(spark, configs, readings, num_partitions=3)
    user = "user_002" if num == 12 else "user_001"
    want = sorted((user, r, base + e * 1000, base + s * 1000) for r, e, s in expected)
    assert got == want


@pytest.mark.parametrize("num", sorted(TRACES))
def test_brute_force_agrees_with_traces(num):
    configs, readings, expected = TRACES[num]
    base = 0 if num == 11 else T0
    events = [("config", c) for c in configs]
    events += [("reading", r) for r in sorted(readings, key=lambda r: r["t"])]
    got = sorted((a[2], a[4], a[3]) for a in brute_alerts(events, DEFAULT_RULES))
    want = sorted((r, base + e * 1000, base + s * 1000) for r, e, s in expected)
    assert got == want


def test_user_device_config_key_fans_out(spark):
    """config_key=user_device: each user keeps a config and gets own alerts."""
    from traces import CFG, every
    u2 = {**CFG, "user_id": "user_002", "temperature_warning_threshold": 26.0,
          "temperature_violation_threshold": 28.0, "no_occupancy_light_threshold": 30.0}
    rd, cf = frames(spark, [CFG, u2], every(0, 1200, temp=29))
    cfg = latest_config(cf, key=("user_id", "device_id"))
    out = detect_breaches(join_config(rd, cfg), DEFAULT_RULES)
    got = sorted((r.user_id, r.rule, (r.window_end_ms - T0) // 1000) for r in out.collect())
    assert got == [("user_001", "TEMP_WARNING", 1200), ("user_002", "TEMP_VIOLATION", 600),
                   ("user_002", "TEMP_VIOLATION", 1200), ("user_002", "TEMP_WARNING", 1200)]
