"""JOB-2 end to end: message files -> live job (bronze copy + alert fold) ->
bronze NDJSON -> JOB-1 lakehouse run -> silver / gold with passing checks."""
import datetime as dt
import json
import os

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from roomlake.operators import tables
from roomlake.plans.lakehouse import LakePaths, run_lakehouse
from roomlake.settings import DEFAULT_RULES, with_timing
from roomlake.sources.files import read_bronze_alerts
from roomlake.streaming.jobs import file_values, message_file_sink, start_alert_job
from test_streaming import config_msg, reading_msg
from traces import CFG, T0, every


def test_live_job_feeds_the_lakehouse(spark, tmp_path):
    root = str(tmp_path)
    os.makedirs(f"{root}/in_r")
    os.makedirs(f"{root}/in_c")
    with open(f"{root}/in_c/0.json", "w") as f:
        f.write(config_msg(CFG, 0) + "\n")
    rows = every(0, 1800, temp=31) + every(2400, 3300, occ=0, light=41)
    with open(f"{root}/in_r/0.json", "w") as f:
        f.write("\n".join(reading_msg(r) for r in rows) + "\nnot json\n")
    rules = with_timing(DEFAULT_RULES)
    qs = start_alert_job(spark, file_values(spark, f"{root}/in_r"), file_values(spark, f"{root}/in_c"),
                         f"{root}/bronze_r", f"{root}/bronze_a", f"{root}/ck", rules,
                         trigger={"availableNow": True}, quarantine_path=f"{root}/quarantine")
    for q in qs:
        q.awaitTermination()
    paths = LakePaths(f"{root}/bronze_r", f"{root}/bronze_a", f"{root}/lake")
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rep = run_lakehouse(spark, paths, now=now)
    assert all(r.failures == 0 for r in rep.checks)
    sr = tables.read_table(spark, paths.table("silver_iot_sensor_readings"))
    assert sr.count() == len(rows)                        # the bad line is not in silver
    sa = tables.read_table(spark, paths.table("silver_threshold_breached_alerts"))
    got = sorted((r.rule, (r.window_end_ms - T0) // 1000, (r.window_start_ms - T0) // 1000)
                 for r in sa.collect())
    assert got == [("NO_OCC_LIGHT", 2700, 2400), ("NO_OCC_LIGHT", 3300, 2400),
                   ("TEMP_VIOLATION", 600, 0), ("TEMP_VIOLATION", 1200, 0),
                   ("TEMP_VIOLATION", 1800, 0), ("TEMP_WARNING", 1200, 0),
                   ("TEMP_WARNING", 1800, 0)]
    bc = tables.read_table(spark, paths.table("gold_hourly_breach_counts"))
    assert bc.agg(F.sum("breach_count")).first()[0] == len(got)
    bad = spark.read.json(f"{root}/quarantine").collect()
    assert [r.value for r in bad] == ["not json"]


def _alert_inputs(root, n_files=4):
    """Readings of several devices in many files; each device's config in a file of its own."""
    os.makedirs(f"{root}/in_r")
    os.makedirs(f"{root}/in_c")
    for d in range(n_files):
        cfg = dict(CFG, device_id=f"dev_{d}")
        with open(f"{root}/in_c/{d}.json", "w") as f:
            f.write(config_msg(cfg, 0) + "\n")
    for k in range(n_files):
        with open(f"{root}/in_r/{k}.json", "w") as f:
            for d in range(n_files):
                f.write("\n".join(reading_msg(dict(r, device_id=f"dev_{d}")) for r in every(k * 900, k * 900 + 840, temp=31)) + "\n")
        os.utime(f"{root}/in_r/{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))


def _run_alerts(spark, root, tag, max_files=None, sinks=()):
    qs = start_alert_job(spark, file_values(spark, f"{root}/in_r", max_files), file_values(spark, f"{root}/in_c"),
                         f"{root}/{tag}_r", f"{root}/{tag}_a", f"{root}/{tag}_ck", with_timing(DEFAULT_RULES),
                         trigger={"availableNow": True}, alert_sinks=sinks, alert_time_from="event")
    for q in qs:
        q.awaitTermination()
    return sorted(tuple(r) for r in read_bronze_alerts(spark, f"{root}/{tag}_a").drop("dt", "hour").collect())


def test_rate_limited_readings_lose_no_alert(spark, tmp_path):
    root = str(tmp_path)
    _alert_inputs(root)
    whole = _run_alerts(spark, root, "whole")
    assert whole and _run_alerts(spark, root, "limited", max_files=1) == whole


def test_all_sinks_hold_the_same_alerts_also_after_a_retry(spark, tmp_path):
    root = str(tmp_path)
    _alert_inputs(root)
    failed = []

    def fails_once(alerts, batch_id):
        if not failed:
            failed.append(batch_id)
            raise RuntimeError("sink down")

    sinks = [message_file_sink(f"{root}/messages"), fails_once]
    try:
        _run_alerts(spark, root, "two", max_files=2, sinks=sinks)
        raise AssertionError("the first batch should have failed")
    except StreamingQueryException:
        pass
    bronze = _run_alerts(spark, root, "two", max_files=2, sinks=sinks)
    messages = [json.loads(r.value) for r in spark.read.json(f"{root}/messages").collect()]
    names = read_bronze_alerts(spark, f"{root}/two_a").drop("dt", "hour").columns
    assert bronze and sorted(tuple(m[c] for c in names) for m in messages) == bronze
    assert bronze == _run_alerts(spark, root, "plain")
