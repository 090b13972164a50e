import datetime as dt
import uuid

from pyspark.sql import functions as F

from roomlake.functions.columns import ts_literal
from roomlake.operators import tables
from roomlake.operators.breaches import detect_breaches
from roomlake.operators.checks import assert_checks, run_checks, unique_violations
from roomlake.operators.config import join_config, latest_config
from roomlake.plans.contract import CONTRACT_RULES, bronze_readings_rows
from roomlake.plans.lakehouse import LakePaths, lake_checks, run_lakehouse
from roomlake.sources import testdata
from roomlake.sources.files import write_bronze
from paths import SF001


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_replace_slice_deletes_partitions_without_new_rows(spark, tmp_path):
    path = str(tmp_path / "g")
    rows = [("a", dt.datetime(2024, 1, 1, 5)), ("a", dt.datetime(2024, 1, 1, 23)),
            ("a", dt.datetime(2024, 1, 2, 3))]
    df = spark.createDataFrame(rows, "k string, hour_ts timestamp").withColumn(
        "hour_date", F.to_date("hour_ts"))
    tables.replace_slice(spark, path, df, "hour_ts", dt.datetime(2024, 1, 1, 20))
    new = spark.createDataFrame([("b", dt.datetime(2024, 1, 1, 21))], "k string, hour_ts timestamp") \
        .withColumn("hour_date", F.to_date("hour_ts"))
    tables.replace_slice(spark, path, new, "hour_ts", dt.datetime(2024, 1, 1, 20))
    got = _rows(tables.read_table(spark, path), ["k", "hour_ts"])
    assert got == [("a", dt.datetime(2024, 1, 1, 5)), ("b", dt.datetime(2024, 1, 1, 21))]


def test_upsert_merges_by_key_in_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "s")
    a = spark.createDataFrame([("k1", "2024-01-01", 1.0), ("k2", "2024-01-02", 2.0)],
                              "pk string, d string, v double")
    assert tables.upsert(spark, path, a, "pk", "d") == "created"
    b = spark.createDataFrame([("k2", "2024-01-02", 20.0), ("k3", "2024-01-02", 3.0)],
                              "pk string, d string, v double")
    assert tables.upsert(spark, path, b, "pk", "d") == "merged"
    got = _rows(tables.read_table(spark, path), ["pk", "v"])
    assert got == [("k1", 1.0), ("k2", 20.0), ("k3", 3.0)]


def test_checks_flag_duplicates_and_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "pk string")
    res = {(r.check_name): r.failures for r in run_checks({"t": (df, "pk")}).collect()}
    assert res == {"unique": 1, "not_null": 1}
    assert unique_violations(df, "pk").count() == 1


def _bronze(spark, root, sf, upto=None, since=None):
    rows = bronze_readings_rows(spark, sf)
    ts = F.to_timestamp("event_time")
    if since is not None:
        rows = rows.where(ts >= ts_literal(since))
    if upto is not None:
        rows = rows.where(ts < ts_literal(upto))
    write_bronze(rows, f"{root}/bronze_r", bucket_ts=ts)
    alerts = detect_breaches(join_config(testdata.readings(spark, sf),
                                         latest_config(testdata.config_updates(spark, sf))),
                             CONTRACT_RULES, tie_cols=("event_ts", "event_id"))
    at = F.to_timestamp("alert_time")
    if since is not None:
        alerts = alerts.where(at >= ts_literal(since))
    if upto is not None:
        alerts = alerts.where(at < ts_literal(upto))
    write_bronze(alerts, f"{root}/bronze_a", bucket_ts=at)


def test_incremental_runs_equal_full_build(spark, tmp_path):
    sf = SF001
    full = str(tmp_path / uuid.uuid4().hex)
    inc = str(tmp_path / uuid.uuid4().hex)
    end = dt.datetime(2024, 2, 1)
    _bronze(spark, full, sf)
    pf = LakePaths(f"{full}/bronze_r", f"{full}/bronze_a", f"{full}/lake")
    run_lakehouse(spark, pf, now=end, full_refresh=True)

    pi = LakePaths(f"{inc}/bronze_r", f"{inc}/bronze_a", f"{inc}/lake")
    cuts = [dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21), end]
    prev = None
    look = 12 * 24              # each run re-processes at least the span since the last one
    for c in cuts:
        _bronze(spark, inc, sf, upto=c, since=prev)
        rep = run_lakehouse(spark, pi, now=c + dt.timedelta(hours=1), lookback_hours=look)
        prev = c
    assert rep.actions["silver_iot_sensor_readings"] == "merged"
    # a re-run of the last step changes nothing
    run_lakehouse(spark, pi, now=cuts[-1] + dt.timedelta(hours=1), lookback_hours=look)
    for name in ["silver_iot_sensor_readings", "silver_threshold_breached_alerts",
                 "gold_sensor_hourly_metrics", "gold_hourly_occupancy_rate",
                 "gold_hourly_breach_counts"]:
        a = tables.read_table(spark, pf.table(name))
        b = tables.read_table(spark, pi.table(name))
        cols = sorted(a.columns)
        ra = _rows(a, cols)
        rb = _rows(b, cols)
        assert len(ra) == len(rb), name
        if name.startswith("gold_sensor") or name.startswith("gold_hourly_occ"):
            pk = cols.index([c for c in cols if c.startswith("pk_")][0])
            assert [r[pk] for r in ra] == [r[pk] for r in rb], name
        else:
            assert ra == rb, name
    assert_checks(lake_checks(spark, pi))


def test_high_water_mark_cutoff_picks_up_late_replays(spark, tmp_path):
    """A replay of old readings after the clock look-back is missed by the
    clock cutoff (as the source) but merged with the high-water-mark cutoff."""
    sf = SF001
    root = str(tmp_path / uuid.uuid4().hex)
    late = dt.datetime(2024, 1, 25)
    _bronze(spark, root, sf, upto=late)
    paths = LakePaths(f"{root}/bronze_r", f"{root}/bronze_a", f"{root}/lake")
    run_lakehouse(spark, paths, now=late, full_refresh=True)
    n0 = tables.read_table(spark, paths.table("silver_iot_sensor_readings")).count()
    _bronze(spark, root, sf, since=late)           # arrives later, old event times
    run_lakehouse(spark, paths, now=dt.datetime(2024, 3, 1))
    n_clock = tables.read_table(spark, paths.table("silver_iot_sensor_readings")).count()
    run_lakehouse(spark, paths, now=dt.datetime(2024, 3, 1), cutoff_from="high_water_mark",
                  lookback_hours=2)
    n_hwm = tables.read_table(spark, paths.table("silver_iot_sensor_readings")).count()
    total = testdata.readings(spark, sf).count()
    assert n_clock == n0 < total
    assert n_hwm == total


def test_first_run_without_any_alert(spark, tmp_path):
    """No bronze alerts yet: silver alerts and breach counts start empty, and
    the next run fills them."""
    root = str(tmp_path / uuid.uuid4().hex)
    rows = bronze_readings_rows(spark, SF001)
    write_bronze(rows, f"{root}/bronze_r", bucket_ts=F.to_timestamp("event_time"))
    paths = LakePaths(f"{root}/bronze_r", f"{root}/bronze_a", f"{root}/lake")
    rep = run_lakehouse(spark, paths, now=dt.datetime(2024, 2, 1))
    assert all(r.failures == 0 for r in rep.checks)
    assert tables.read_table(spark, paths.table("gold_hourly_breach_counts")).count() == 0
    _bronze(spark, root, SF001, since=dt.datetime(2024, 1, 25))      # alerts arrive later
    run_lakehouse(spark, paths, now=dt.datetime(2024, 2, 1), lookback_hours=8 * 24)
    assert tables.read_table(spark, paths.table("silver_threshold_breached_alerts")).count() > 0
