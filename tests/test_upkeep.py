"""One-exchange roll-up, checks by changed dates, compaction of bronze, audit of the fold's state."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from paths import SF001
from roomlake.operators import gold, silver, tables
from roomlake.operators.check_state import LAKE_KEYS, check_table
from roomlake.operators.checks import check_frame
from roomlake.plans.contract import bronze_readings_rows
from roomlake.schemas import BRONZE_READING
from roomlake.settings import DEFAULT_RULES
from roomlake.sources.compaction import compact, compacted_folders, pack_folders, purge, read_compacted
from roomlake.sources.files import read_bronze_readings
from roomlake.streaming.alerts import stream_alerts, union_inputs
from roomlake.streaming.audit import audit_states, expected_states, read_fold_state
from roomlake.streaming.jobs import bronze_query, config_stream, file_values, reading_stream
from test_split import device, drop
from test_streaming import config_msg, reading_msg
from traces import CFG, every

NAME = "silver_iot_sensor_readings"


def bronze(spark):
    b = bronze_readings_rows(spark, SF001)
    return b.unionByName(b).unionByName(bronze_readings_rows(spark, SF001, 0.5))


def rounded(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.mark.parametrize("hot", [None, 0, 5, 10 ** 6])
def test_rollup_from_bronze(spark, hot):
    want = gold.hourly_device_rollup(silver.silver_readings(bronze(spark)))
    got = gold.rollup_from_bronze(bronze(spark), hot_rows=hot, parts=3).select(*want.columns)
    assert rounded(got) == rounded(want)


def test_rollup_has_one_exchange(spark):
    plan = gold.rollup_from_bronze(bronze(spark), hot_rows=None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_rollup_tasks_follow_the_rows(spark, monkeypatch):
    """A task's share is bounded, and many hot device-hours are not brought together by a join."""
    want = rounded(gold.hourly_device_rollup(silver.silver_readings(bronze(spark))))
    monkeypatch.setattr(gold, "ROWS_PER_TASK", 100, raising=False)
    monkeypatch.setattr(gold, "FEW_HOT", 5, raising=False)
    least = bronze(spark).count() // 100
    for hot in (0, 10 ** 6):
        got = gold.rollup_from_bronze(bronze(spark), hot_rows=hot, parts=3)
        assert got.rdd.getNumPartitions() >= least > 8
        assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
        assert rounded(got.select(*gold.hourly_device_rollup(silver.silver_readings(bronze(spark))).columns)) == want


def table(spark, path):
    tables.upsert(spark, path, silver.silver_readings(bronze(spark)), "pk_sensor_event_id", "event_date")


def rewrite(spark, path, change, since):
    df = tables.read_table(spark, path).where(F.col("event_date") >= F.lit(since).cast("date"))
    (change(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path))


def failures(spark, path):
    return {r.check_name: r.failures for r in check_frame(NAME, tables.read_table(spark, path), "pk_sensor_event_id").collect()}


def test_checks_read_changed_dates_only(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path)
    days = len([d for d in os.listdir(path) if d.startswith("event_date=")])
    first = check_table(spark, path, NAME, LAKE_KEYS[NAME])
    assert (first["unique"], first["not_null"], len(first["checked"]), first["whole"]) == (0, 0, days, False)
    assert check_table(spark, path, NAME, LAKE_KEYS[NAME])["checked"] == []
    ms = F.unix_millis("event_ts")
    rewrite(spark, path, lambda d: d.unionByName(d.where(ms % 7 == 0)).withColumn(
        "pk_sensor_event_id", F.when(ms % 11 != 0, F.col("pk_sensor_event_id"))), "2024-01-25")
    got = check_table(spark, path, NAME, LAKE_KEYS[NAME])
    assert {k: got[k] for k in ("unique", "not_null")} == failures(spark, path) and got["unique"] and got["not_null"]
    assert 0 < len(got["checked"]) < 10 and not got["whole"]


def test_a_key_in_two_dates_is_found(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path)
    check_table(spark, path, NAME, LAKE_KEYS[NAME])
    # copies of old rows land in a later date: their date is not the one that their time gives
    old = tables.read_table(spark, path).where("event_date = '2024-01-05'").withColumn("event_date", F.lit("2024-02-20").cast("date"))
    n = old.count()
    old.write.mode("append").partitionBy("event_date").parquet(path)
    got = check_table(spark, path, NAME, LAKE_KEYS[NAME])
    assert got["whole"] and got["checked"] == ["2024-02-20"] and n > 0
    assert {k: got[k] for k in ("unique", "not_null")} == failures(spark, path) == {"unique": n, "not_null": 0}


def test_pack_folders():
    bins = pack_folders({("d", f"{i}"): s for i, s in enumerate([70, 60, 40, 30, 30, 200])}, 100)
    assert sorted(len(b) for b in bins) == [1, 1, 2, 2] and sum(map(len, bins)) == 6


def read_rows(df):
    return sorted(map(tuple, df.select("device_id", "event_time", "temperature", "dt", "hour").collect()))


def test_compaction_of_a_streaming_sink(spark, tmp_path):
    root = str(tmp_path)
    path = f"{root}/bronze"
    for i in range(3):                                        # three micro-batches: three file sets in one hour
        drop(root, "r", str(i), [reading_msg(r) for r in every(i * 600, i * 600 + 540)])
        q = bronze_query(reading_stream(file_values(spark, f"{root}/r")).select(*BRONZE_READING.names), path, f"{root}/ck",
                         {"availableNow": True})
        q.awaitTermination()
    before = read_rows(read_bronze_readings(spark, path))
    assert read_rows(read_compacted(spark, path, BRONZE_READING)) == before and len(before) == 30
    open_now = read_compacted(spark, path, BRONZE_READING)    # a reader that began before
    assert compact(spark, path, BRONZE_READING, dt.datetime(2000, 1, 1)) == []
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=2)
    folders = compact(spark, path, BRONZE_READING, later)
    assert folders and read_rows(open_now) == before
    after = read_compacted(spark, path, BRONZE_READING)
    assert read_rows(after) == before
    small = sum(len([f for f in fs if f.startswith("part-")]) for _, _, fs in os.walk(path))
    large = sum(len([f for f in fs if f.startswith("part-")]) for _, _, fs in os.walk(f"{path}_compact"))
    assert large <= len(folders) < small
    assert compact(spark, path, BRONZE_READING, later) == []
    assert purge(spark, path) == len(folders) and purge(spark, path) == 0
    assert read_rows(read_compacted(spark, path, BRONZE_READING)) == before
    assert compact(spark, path, BRONZE_READING, later) == [] and all(s is None for s in compacted_folders(spark, path).values())


def test_a_file_added_after_the_copy(spark, tmp_path):
    from roomlake.sources.files import write_bronze

    path = str(tmp_path / "b")
    b = bronze_readings_rows(spark, SF001).withColumn("at", F.timestamp_millis("eventTimeMillis")).where("at < '2024-01-02'")
    for i in range(2):
        write_bronze(b.where(F.col("eventTimeMillis") % 2 == i).drop("at"), path, bucket_ts=F.to_timestamp("event_time"))
    compact(spark, path, BRONZE_READING, dt.datetime(2024, 2, 1))
    write_bronze(b.drop("at"), path, bucket_ts=F.to_timestamp("event_time"))
    assert read_rows(read_compacted(spark, path, BRONZE_READING)) == read_rows(read_bronze_readings(spark, path))
    assert compact(spark, path, BRONZE_READING, dt.datetime(2024, 2, 1))
    assert read_rows(read_compacted(spark, path, BRONZE_READING)) == read_rows(read_bronze_readings(spark, path))


def test_state_audit(spark, tmp_path):
    import random

    root, rnd = str(tmp_path), random.Random(5)
    rows = sorted((r for i in range(4) for r in device(i, 200, rnd)), key=lambda r: r["t"])
    drop(root, "c", "0", [config_msg(dict(CFG, device_id=f"d{i}"), 0) for i in range(6)])
    for i in range(0, len(rows), 300):                        # restarts between
        drop(root, "r", f"{i:04d}", [reading_msg(r) for r in rows[i:i + 300]])
        (stream_alerts(union_inputs(reading_stream(file_values(spark, f"{root}/r")), config_stream(file_values(spark, f"{root}/c"))))
         .writeStream.format("noop").option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start().awaitTermination())
    stored = read_fold_state(spark, f"{root}/ck")
    joined = spark.createDataFrame([dict(r, **{k: v for k, v in CFG.items() if k != "device_id"}) for r in rows])
    want = expected_states(joined, DEFAULT_RULES, num_partitions=5)
    assert want.count() == 12 and stored.count() == 18        # two devices with a config only
    assert audit_states(stored, want).count() == 0
    broken = stored.withColumn("last_alert_ms", F.when((F.col("device_id") == "d1") & (F.col("rule") == "TEMP_WARNING"), -1)
                               .otherwise(F.col("last_alert_ms")))
    found = audit_states(broken, want).collect()
    assert sorted((r.device_id, r.rule, r.side) for r in found) == [("d1", "TEMP_WARNING", "expected"), ("d1", "TEMP_WARNING", "stored")]
