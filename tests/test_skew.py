"""One device holds a third of all readings: the range shuffle still spreads
the work evenly, and the alerts equal the sequential rule."""
from pyspark.sql import functions as F

from brute import brute_alerts
from paths import SF01
from roomlake.operators.breaches import detect_breaches
from roomlake.operators.config import join_config, latest_config
from roomlake.settings import DEFAULT_RULES, with_timing
from roomlake.sources import testdata


def test_hot_device_is_split_evenly(spark):
    r = testdata.readings(spark, SF01)
    # stand-in input: a third of the readings come from one device
    hot = r.withColumn("device_id", F.when(F.col("event_id") % 3 == 0, F.lit("dev_0"))
                       .otherwise(F.col("device_id")))
    cfg = latest_config(testdata.config_updates(spark, SF01))
    rules = with_timing(DEFAULT_RULES, 6 * 3600, 12 * 3600)
    alerts, plan = detect_breaches(join_config(hot, cfg), rules, num_partitions=16,
                                   tie_cols=("event_ts", "event_id"), return_plan=True)
    rows = plan.rows_per_partition
    mean = sum(rows) / len(rows)
    assert max(rows) <= 2 * mean                       # no partition carries the hot device
    assert plan.crossing_partitions >= 4
    got = sorted((a.device_id, a.rule, a.window_start_ms, a.window_end_ms) for a in alerts.collect())

    j = join_config(hot, cfg).select("event_id", "device_id", "user_id", "t", "event_ts",
                                     "temperature", "humidity", "light", "co2",
                                     "humidity_ratio", "occupancy",
                                     "temperature_warning_threshold",
                                     "temperature_violation_threshold",
                                     "no_occupancy_light_threshold")
    pdf = j.toPandas().sort_values(["device_id", "event_ts", "event_id"])
    events = []
    for rec in pdf.to_dict("records"):
        c = {k: rec[k] for k in ["user_id", "device_id", "temperature_warning_threshold",
                                 "temperature_violation_threshold", "no_occupancy_light_threshold"]}
        events.append(("config", c))
        events.append(("reading", rec))
    want = sorted((a[1], a[2], a[3], a[4]) for a in brute_alerts(events, rules))
    assert got == want
