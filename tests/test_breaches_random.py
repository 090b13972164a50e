"""Partition-crossing keys: the range-partitioned engine equals the
sequential rule on random data, whatever the number of partitions."""
import random

import pytest

from brute import brute_alerts
from roomlake.operators.breaches import (ChainTransfer, apply_transfer, detect_breaches,
                                         emit_chain)
from roomlake.operators.config import join_config, latest_config
from roomlake.settings import DEFAULT_RULES, with_timing
from test_alert_traces import frames
from traces import T0


def random_case(seed, n_hot=400, n_cold=30):
    rnd = random.Random(seed)
    configs, readings = [], []
    for d in range(4):
        dev = f"dev_{d}"
        configs.append({"user_id": f"user_{d}", "device_id": dev,
                        "temperature_warning_threshold": 25.0,
                        "temperature_violation_threshold": 27.0,
                        "no_occupancy_light_threshold": 40.0})
        t = T0
        for _ in range(n_hot if d == 0 else n_cold):
            t += rnd.choice([0, 30, 60, 60, 60, 120, 600]) * 1000
            hot = rnd.random() < 0.85
            readings.append({"device_id": dev, "t": t,
                             "temperature": rnd.uniform(26, 30) if hot else rnd.uniform(20, 26),
                             "humidity": 30.0, "light": rnd.choice([0.0, 50.0]),
                             "co2": 500.0, "humidity_ratio": 0.004,
                             "occupancy": rnd.choice([0, 1])})
    return configs, readings


@pytest.mark.parametrize("seed,parts,dur,cd,gap", [(1, 9, 300, 600, None), (2, 17, 120, 900, None),
                                                   (3, 5, 0, 0, None), (4, 23, 600, 60, None),
                                                   (6, 11, 300, 600, 150), (7, 19, 120, 300, 90)])
def test_engine_equals_sequential_rule(spark, seed, parts, dur, cd, gap):
    rules = with_timing(DEFAULT_RULES, dur, cd)
    configs, readings = random_case(seed)
    rd, cf = frames(spark, configs, readings)
    alerts, plan = detect_breaches(join_config(rd, latest_config(cf)), rules,
                                   num_partitions=parts, return_plan=True, max_gap_s=gap)
    got = sorted((a.user_id, a.device_id, a.rule, a.window_start_ms, a.window_end_ms,
                  a.observed_value, a.threshold_value) for a in alerts.collect())
    # event_id is the tie-break: same order as the list
    ordered = sorted(enumerate(readings), key=lambda p: (p[1]["device_id"], p[1]["t"], p[0]))
    events = [("config", c) for c in configs] + [("reading", r) for _, r in ordered]
    assert plan.crossing_partitions >= 2     # the hot device really was split
    assert got == brute_alerts(events, rules, None if gap is None else gap * 1000)


def test_cooldown_transfer_matches_replay():
    rnd = random.Random(7)
    for _ in range(400):
        ct = sorted(rnd.randrange(0, 5000) for _ in range(rnd.randrange(1, 40)))
        cd = rnd.choice([0, 1, 50, 300, 1000])
        t_first = ct[0] - rnd.randrange(0, 100)
        xf = ChainTransfer(t_first, cd)
        i = 0
        while i < len(ct):                      # random chunking, as Arrow batches
            k = rnd.randrange(1, 6)
            xf.feed(ct[i:i + k])
            i += k
        thr, ends = xf.result()
        for x in range(t_first - 2 * max(cd, 1), t_first + 1, max(1, cd // 7)):
            assert apply_transfer(thr, ends, x, cd) == emit_chain(ct, x, cd)[1]


def test_tiny_arrow_batches(spark):
    """Runs spanning many Arrow batches carry their state across batches."""
    rules = with_timing(DEFAULT_RULES, 300, 600)
    configs, readings = random_case(5)
    rd, cf = frames(spark, configs, readings)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        alerts = detect_breaches(join_config(rd, latest_config(cf)), rules, num_partitions=6)
        got = sorted((a.user_id, a.device_id, a.rule, a.window_start_ms, a.window_end_ms,
                      a.observed_value, a.threshold_value) for a in alerts.collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    ordered = sorted(enumerate(readings), key=lambda p: (p[1]["device_id"], p[1]["t"], p[0]))
    events = [("config", c) for c in configs] + [("reading", r) for _, r in ordered]
    assert got == brute_alerts(events, rules)


def test_union_of_alerts_with_itself_is_stable(spark):
    """Carries are keyed by a stamped partition column, not by task index,
    so a plan that unions the alerts with themselves stays exact."""
    rules = with_timing(DEFAULT_RULES, 300, 600)
    configs, readings = random_case(11)
    rd, cf = frames(spark, configs, readings)
    alerts = detect_breaches(join_config(rd, latest_config(cf)), rules, num_partitions=13)
    once = sorted(tuple(r) for r in alerts.collect())
    twice = sorted(tuple(r) for r in alerts.unionByName(alerts).collect())
    assert twice == sorted(once + once)
