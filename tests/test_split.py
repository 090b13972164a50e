"""The split alert job: equal to the sequential rule over micro-batches, hot devices, restarts, retries, compaction."""
import json
import os
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import roomlake.operators.breaches as B
from brute import brute_alerts
from roomlake.settings import DEFAULT_RULES
from roomlake.streaming.jobs import config_stream, file_values, reading_stream
from roomlake.streaming.split import config_log, read_alerts, read_states, seed_configs, split_alert_query, state_log
from test_streaming import config_msg, iso, reading_msg
from traces import CFG, T0, every, reading


def drop(root, sub, name, lines):
    os.makedirs(f"{root}/{sub}", exist_ok=True)
    with open(f"{root}/{sub}/{name}", "w") as f:
        f.write("".join(x + "\n" for x in lines))


def run(spark, root, with_configs=True, sinks=(), **kw):
    os.makedirs(f"{root}/c", exist_ok=True)
    os.makedirs(f"{root}/r", exist_ok=True)
    configs = config_stream(file_values(spark, f"{root}/c")) if with_configs else None
    split_alert_query(spark, reading_stream(file_values(spark, f"{root}/r")), configs, f"{root}/job", f"{root}/ck", sinks=sinks,
                      trigger={"availableNow": True}, **{"alert_time_from": "event", **kw}).awaitTermination()
    return sorted((r.device_id, r.rule, r.window_end_ms, r.window_start_ms) for r in read_alerts(spark, f"{root}/job").collect())


def device(i, n, rnd):
    """Readings of one device, one a minute, warm spells of random length."""
    rows, warm = [], False
    for k in range(n):
        warm = warm if rnd.random() < 0.95 else not warm
        rows.append(dict(reading(k * 60, temp=rnd.choice([29, 31, 33]) if warm else 20), device_id=f"d{i}"))
    return rows


def literal(rows, cfg=CFG):
    """The rule, read row by row."""
    events = [("config", dict(cfg, device_id=d)) for d in {r["device_id"] for r in rows}] + [("reading", r) for r in rows]
    return sorted((d, rule, end, start) for _, d, rule, start, end, _, _ in brute_alerts(events, DEFAULT_RULES))


@pytest.mark.parametrize("parts", [1, 9])
def test_hot_device_over_micro_batches(spark, tmp_path, parts):
    rnd, root = random.Random(parts), str(tmp_path)
    rows = device(0, 900, rnd) + [r for i in range(1, 7) for r in device(i, 300, rnd)]
    seed_configs(spark, f"{root}/job", spark.createDataFrame(
        [dict(CFG, device_id=f"d{i}", updated_at=iso(0), seq=1) for i in range(7)]), DEFAULT_RULES)
    rows.sort(key=lambda r: r["t"])
    for i in range(0, len(rows), 700):                       # every run is a restart
        drop(root, "r", f"{i:05d}", [reading_msg(r) for r in rows[i:i + 700]])
        got = run(spark, root, with_configs=False, num_partitions=parts, compact_every=2)
    assert got == literal(rows) and len(got) > 40
    states = {(r.device_id, r.rule): r for r in read_states(spark, f"{root}/job").collect()}
    assert len(states) == 21
    for d in range(7):
        last = max((a for a in got if a[0] == f"d{d}" and a[1] == "TEMP_VIOLATION"), key=lambda a: a[2], default=None)
        assert states[f"d{d}", "TEMP_VIOLATION"].last_alert_ms == (last[2] if last else 0)
        assert states[f"d{d}", "TEMP_VIOLATION"].last_reading_ms == max(r["t"] for r in rows if r["device_id"] == f"d{d}")


def test_config_only_devices_leave_no_state(spark, tmp_path):
    root = str(tmp_path)
    seed_configs(spark, f"{root}/job", spark.range(15000).select(
        F.concat(F.lit("x"), "id").alias("device_id"), F.lit("u").alias("user_id"), F.lit(iso(0)).alias("updated_at"),
        *[F.lit(v).alias(k) for k, v in CFG.items() if k.endswith("threshold")]), DEFAULT_RULES)
    drop(root, "c", "0", [config_msg(CFG, 0)] + [config_msg(dict(CFG, device_id=f"y{i}"), 0) for i in range(50)])
    drop(root, "r", "0", [reading_msg(r) for r in every(0, 1200, temp=29)])
    assert [(a[1], a[2]) for a in run(spark, root)] == [("TEMP_WARNING", T0 + 1_200_000)]
    assert state_log(spark, f"{root}/job").latest(99).count() == 1
    assert config_log(spark, f"{root}/job", [k for k in CFG if k.endswith("threshold")]).latest(99).count() == 15051


def test_configs_change_and_unknown_devices_drop(spark, tmp_path):
    root = str(tmp_path)
    drop(root, "r", "0", [reading_msg(r) for r in every(0, 900, temp=29)])
    assert run(spark, root) == []                            # no config yet: no state either
    drop(root, "c", "1", [config_msg(CFG, 1000, seq=1)])
    drop(root, "r", "1", [reading_msg(r) for r in every(960, 1800, temp=29)])
    run(spark, root)
    drop(root, "c", "2", [config_msg(dict(CFG, temperature_warning_threshold=50.0), 0, seq=9)])     # older: no effect
    drop(root, "r", "2", [reading_msg(r) for r in every(1860, 2220, temp=29)])
    assert [(a[2] - T0) // 1000 for a in run(spark, root)] == [2160]
    drop(root, "c", "3", [config_msg(dict(CFG, user_id="user_9", temperature_warning_threshold=30.0), 2000)])
    drop(root, "r", "3", [reading_msg(r) for r in every(2280, 9000, temp=29)])
    assert len(run(spark, root)) == 1


def test_trace9_arrival_order(spark, tmp_path):
    root = str(tmp_path)
    drop(root, "c", "0", [config_msg(CFG, 0)])
    for i, at in enumerate((600, 0, 1200)):
        drop(root, "r", str(i), [reading_msg(reading(at, temp=31))])
        got = run(spark, root)
    assert [(a[1], a[2], a[3]) for a in got] == [("TEMP_VIOLATION", T0 + 1_200_000, T0 + 600_000)]


def test_a_retried_batch_repeats_itself(spark, tmp_path):
    root, fail, seen = str(tmp_path), [True], []

    def sink(alerts, batch_id):
        seen.append((batch_id, sorted((r.alert_time, r.window_end_ms) for r in alerts.collect())))
        if fail[0] and batch_id == 1:
            raise RuntimeError("sink is down")

    drop(root, "c", "0", [config_msg(CFG, 0)])
    drop(root, "r", "0", [reading_msg(r) for r in every(0, 900, temp=31)])
    run(spark, root, sinks=[sink], alert_time_from="batch")
    drop(root, "r", "1", [reading_msg(r) for r in every(960, 3000, temp=31)])
    with pytest.raises(Exception, match="sink is down"):
        run(spark, root, sinks=[sink], alert_time_from="batch")
    fail[0] = False
    got = run(spark, root, sinks=[sink], alert_time_from="batch")
    assert seen[1] == seen[2] and seen[1][1]
    assert got == literal([dict(r, device_id=r["device_id"]) for r in every(0, 3000, temp=31)])
    assert len({r.alert_time for r in read_alerts(spark, f"{root}/job").where("rule = 'TEMP_VIOLATION'").collect()}) == \
        sum(a[1] == "TEMP_VIOLATION" for a in got)


def fold_peak(n):
    """Peak Python memory of pass C over one device's ``n`` rows in batches of 10,000."""
    def batches():
        for a in range(0, n, 10_000):
            t = np.arange(a, min(n, a + 10_000), dtype=np.int64) * 60_000 + T0
            warm = (np.arange(a, min(n, a + 10_000)) // 37) % 2 == 0
            yield pd.DataFrame({"_pid": 0, "_k": "hot", "t": t, "user_id": "u", "device_id": "hot", "_in": None,
                                **{f"c{i}": warm for i in range(3)}, **{f"{c}{i}": 1.0 for c in "oh" for i in range(3)}})

    tracemalloc.start()
    alerts = sum(len(f) for f in B._pass_c(DEFAULT_RULES, {}, None, set())(batches()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return alerts, peak


def test_fold_memory_is_flat():
    (few, small), (many, large) = fold_peak(100_000), fold_peak(1_000_000)
    assert many > 9 * few and large < 1.2 * small


def test_split_deliveries_are_written_by_all_tasks(spark, monkeypatch, tmp_path):
    """Four micro-batches, each of a whole quarter, which no single task wrote."""
    from paths import SF001
    from roomlake.plans import contract

    rows = contract.testdata.readings
    monkeypatch.setattr(contract.testdata, "readings", lambda s, sf: rows(s, sf).repartition(3))
    monkeypatch.setattr(contract, "scratch_path", lambda s, name: str(tmp_path / name))
    got = sorted(map(tuple, contract.QUERIES["stream_alerts_split"](spark, SF001).collect()))
    root = tmp_path / "stream-split"
    assert [len(list((root / "in" / str(i)).glob("part-*"))) for i in range(4)] == [3] * 4
    assert sorted(int(p.name) for p in (root / "ckpt" / "commits").iterdir() if p.name.isdigit()) == [0, 1, 2, 3]
    assert got == sorted(map(tuple, contract.QUERIES["threshold_alerts"](spark, SF001).collect()))
