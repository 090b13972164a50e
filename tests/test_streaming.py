"""Streaming fold: golden traces fed in micro-batches, one availableNow run
per batch on one checkpoint (so every batch is also a restart)."""
import datetime as dt
import json
import os
import uuid

import pytest

from roomlake.settings import DEFAULT_RULES
from roomlake.streaming.alerts import stream_alerts, union_inputs
from roomlake.streaming.jobs import config_stream, file_values, reading_stream
from traces import CFG, T0, TRACES, every, reading


def iso(ms):
    return dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"


def reading_msg(r):
    m = {k: r[k] for k in ["device_id", "temperature", "humidity", "light", "co2",
                           "humidity_ratio", "occupancy"]}
    m["event_time"] = iso(r["t"])
    return json.dumps(m)


def config_msg(c, updated_ms, seq=None):
    m = dict(c, updated_at=iso(updated_ms))
    if seq is not None:
        m["seq"] = seq
    return json.dumps(m)


def run_batches(spark, tmp_path, batches, rules=DEFAULT_RULES, max_gap_s=None):
    """batches: list of (config lines, reading lines); returns alert rows."""
    root = str(tmp_path / uuid.uuid4().hex)
    os.makedirs(f"{root}/r")
    os.makedirs(f"{root}/c")
    for i, (cfgs, rds) in enumerate(batches):
        for sub, lines in (("c", cfgs), ("r", rds)):
            if lines:
                with open(f"{root}/{sub}/{i:04d}.json", "w") as f:
                    f.write("\n".join(lines) + "\n")
        alerts = stream_alerts(union_inputs(reading_stream(file_values(spark, f"{root}/r")),
                                            config_stream(file_values(spark, f"{root}/c"))),
                               rules, alert_time_from="event", max_gap_s=max_gap_s)
        q = (alerts.writeStream.format("parquet").option("path", f"{root}/out")
                   .option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start())
        q.awaitTermination()
    if not os.path.exists(f"{root}/out"):
        return []
    return sorted((r.user_id, r.rule, r.window_end_ms, r.window_start_ms)
                  for r in spark.read.parquet(f"{root}/out").collect())


def ms(off):
    return T0 + off * 1000


def test_trace9_arrival_order(spark, tmp_path):
    batches = [([config_msg(CFG, 0)], [reading_msg(reading(600, temp=31))]),
               ([], [reading_msg(reading(0, temp=31))]),
               ([], [reading_msg(reading(1200, temp=31))])]
    assert run_batches(spark, tmp_path, batches) == [("user_001", "TEMP_VIOLATION", ms(1200), ms(600))]


def test_trace10_config_change_resets_episode(spark, tmp_path):
    warn30 = dict(CFG, temperature_warning_threshold=30.0)
    b1 = [reading_msg(r) for r in every(0, 900, temp=29)]
    b2 = [reading_msg(r) for r in every(960, 2400, temp=29)]
    batches = [([config_msg(CFG, 0)], b1), ([config_msg(warn30, 1000)], b2)]
    assert run_batches(spark, tmp_path, batches) == []


def test_trace12_last_config_wins_per_device(spark, tmp_path):
    u2 = dict(CFG, user_id="user_002", temperature_warning_threshold=26.0,
              temperature_violation_threshold=28.0, no_occupancy_light_threshold=30.0)
    rows = [reading_msg(r) for r in every(0, 1200, temp=27)]
    got = run_batches(spark, tmp_path, [([config_msg(CFG, 0), config_msg(u2, 0, seq=1)], rows)])
    assert got == [("user_002", "TEMP_WARNING", ms(1200), ms(0))]


def test_old_config_arriving_late_does_not_override(spark, tmp_path):
    newer = dict(CFG, temperature_warning_threshold=26.0)
    rows = [reading_msg(r) for r in every(0, 1200, temp=27)]
    batches = [([config_msg(newer, 5000)], []), ([config_msg(CFG, 1000)], rows)]
    assert run_batches(spark, tmp_path, batches) == [("user_001", "TEMP_WARNING", ms(1200), ms(0))]


@pytest.mark.parametrize("num", [2, 3, 5, 6, 7, 8, 11, 13])
def test_traces_split_over_restarts(spark, tmp_path, num):
    """Event-ordered readings cut into three micro-batches equal the batch trace."""
    configs, readings, expected = TRACES[num]
    rs = sorted(readings, key=lambda r: r["t"])
    k = max(1, len(rs) // 3)
    parts = [rs[:k], rs[k:2 * k], rs[2 * k:]]
    batches = [([config_msg(c, 0, seq=i) for i, c in enumerate(configs)] if j == 0 else [],
                [reading_msg(r) for r in p]) for j, p in enumerate(parts)]
    base = 0 if num == 11 else T0          # trace 11 starts at the epoch
    want = sorted(("user_001", r, base + e * 1000, base + s * 1000) for r, e, s in expected)
    assert run_batches(spark, tmp_path, batches) == want


def test_late_older_reading_with_zero_cooldown(spark, tmp_path):
    """cooldown 0: a late reading older than the last alert fails t - last >= 0."""
    from roomlake.settings import with_timing
    rules = with_timing(DEFAULT_RULES, 60, 0)
    b1 = [reading_msg(r) for r in every(0, 600, temp=31)]          # alerts 60..600
    b2 = [reading_msg(reading(300, temp=31)), reading_msg(reading(660, temp=31))]
    got = run_batches(spark, tmp_path, [([config_msg(CFG, 0)], b1), ([], b2)], rules)
    late = [g for g in got if g[2] == ms(300) and g[1] == "TEMP_VIOLATION"]
    assert len(late) == 1                     # only the in-order one from batch 1
    assert ("user_001", "TEMP_VIOLATION", ms(660), ms(0)) in got


def test_max_gap_ends_episode_across_batches(spark, tmp_path):
    """Trace 13 with max_gap 30 min: the hour of silence ends the episode."""
    batches = [([config_msg(CFG, 0)], [reading_msg(reading(0, temp=31))]),
               ([], [reading_msg(reading(3600, temp=31))]),
               ([], [reading_msg(reading(3660 + 600, temp=31))])]
    assert run_batches(spark, tmp_path, batches, max_gap_s=1800) == \
        [("user_001", "TEMP_VIOLATION", ms(4260), ms(3600))]
    assert len(run_batches(spark, tmp_path, batches)) == 4     # off: silence keeps it open


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_arrival_order_equals_sequential_rule(spark, tmp_path, seed):
    """Out-of-order readings over three micro-batches: the fold equals the
    literal rule run in processing order (configs first within a batch,
    readings by event time within a batch, batches in arrival order)."""
    import random

    from brute import brute_alerts
    from roomlake.settings import with_timing

    rnd = random.Random(seed)
    rules = with_timing(DEFAULT_RULES, 120, 300)
    cfgs = [dict(CFG, device_id=f"dev_{d}", user_id=f"user_{d}") for d in range(2)]
    batches, events = [], []
    for b in range(3):
        rows = [reading(rnd.randrange(0, 60) * 30, temp=rnd.choice([27, 29, 31]),
                        occ=rnd.choice([0, 1]), light=rnd.choice([0.0, 50.0]),
                        device=rnd.choice(["dev_0", "dev_1"])) for _ in range(12)]
        # distinct times per device so event order inside a batch is unambiguous
        seen, uniq = set(), []
        for r in rows:
            if (r["device_id"], r["t"]) not in seen:
                seen.add((r["device_id"], r["t"]))
                uniq.append(r)
        c = cfgs if b == 0 else []
        batches.append(([config_msg(x, 0, seq=i) for i, x in enumerate(c)],
                        [reading_msg(r) for r in uniq]))
        events += [("config", x) for x in c]
        events += [("reading", r) for r in sorted(uniq, key=lambda r: (r["t"], r["device_id"]))]
    got = run_batches(spark, tmp_path, batches, rules)
    want = sorted((a[0], a[2], a[4], a[3]) for a in brute_alerts(events, rules))
    assert got == want


def test_devices_share_calls_and_state_rows(spark, tmp_path):
    """Calls and state rows follow the buckets, not the devices; each device keeps its own config, episodes and cooldowns."""
    import random

    from brute import brute_alerts
    from roomlake.settings import with_timing

    rnd, root = random.Random(7), str(tmp_path)
    rules = with_timing(DEFAULT_RULES, 120, 300)
    cfgs = [dict(CFG, device_id=f"dev_{d}", user_id=f"user_{d}", temperature_warning_threshold=26.0 + d % 3) for d in range(40)]
    events = [("config", c) for c in cfgs]
    for sub in "rc":
        os.makedirs(f"{root}/{sub}")
    with open(f"{root}/c/0.json", "w") as f:
        f.write("\n".join(config_msg(c, 0) for c in cfgs) + "\n")
    for i in range(2):                                  # a restart between; devices without config (dev_40..) drop
        rows = [reading(900 * i + 30 * k, temp=rnd.choice([25, 27, 29, 31]), occ=rnd.choice([0, 1]),
                        light=rnd.choice([0.0, 50.0]), device=f"dev_{d}") for k in range(30) for d in range(0, 44, 3)]
        events += [("reading", r) for r in rows]
        rnd.shuffle(rows)
        with open(f"{root}/r/{i}.json", "w") as f:
            f.write("\n".join(reading_msg(r) for r in rows) + "\n")
        alerts = stream_alerts(union_inputs(reading_stream(file_values(spark, f"{root}/r")),
                                            config_stream(file_values(spark, f"{root}/c"))), rules, "event", buckets=3)
        (alerts.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ck")
               .trigger(availableNow=True).start().awaitTermination())
    got = sorted((r.user_id, r.rule, r.window_end_ms, r.window_start_ms) for r in spark.read.parquet(f"{root}/out").collect())
    want = sorted((a[0], a[2], a[4], a[3]) for a in brute_alerts(events, rules))
    assert want and got == want
    assert spark.read.format("statestore").load(f"{root}/ck").count() == 3
