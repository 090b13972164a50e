"""Streaming silver, late readings, and pruned bronze scans."""
import json
import os

import pytest
from pyspark.sql import functions as F

import roomlake.streaming.silver as S
from roomlake.operators import silver
from roomlake.operators.tables import read_table
from roomlake.sources.bronze_stats import folders_since, refresh_stats
from roomlake.sources.files import read_bronze_readings, write_bronze
from roomlake.streaming.jobs import file_values, reading_stream, stream_hourly_rollup
from roomlake.streaming.late import late_readings_query, read_counts, read_late
from test_split import drop
from test_streaming import iso, reading_msg
from traces import T0, every, reading

DAY = 86_400


def silver_rows(df):
    return sorted(map(tuple, df.drop("rnk").collect()))


def all_readings(spark, root):
    return silver.silver_readings(reading_stream(spark.read.text(f"{root}/r")))


def start(spark, root, **kw):
    return S.stream_silver(reading_stream(file_values(spark, f"{root}/r", max_files=1)), f"{root}/silver", f"{root}/ck",
                           {"availableNow": True})


def deliveries():
    first = every(0, 3 * DAY, step=3600, temp=20)
    again = [dict(r, temperature=25.0) for r in first[::3]]
    lower = [dict(r, temperature=15.0) for r in first[::2]]
    other = [dict(r, device_id="dev_9") for r in first[10:30]]
    return [first[:40], again + other, lower + first[40:], first]


def test_streaming_silver_equals_a_full_build(spark, tmp_path):
    root = str(tmp_path)
    for i, rows in enumerate(deliveries()):
        drop(root, "r", f"{i}", [reading_msg(r) for r in rows])
        start(spark, root).awaitTermination()
    got = read_table(spark, f"{root}/silver")
    assert silver_rows(got) == silver_rows(all_readings(spark, root).select(*got.columns))
    assert not os.path.exists(f"{root}/silver/_staged/0")


@pytest.mark.parametrize("moved", [0, 1, 2])
def test_a_crash_while_swapping(spark, tmp_path, monkeypatch, moved):
    """The driver dies after some dates are swapped in; the retried batch leaves the table of a full build."""
    root, swap, runs = str(tmp_path), S._swap, []

    def dying(spark_, path, staged, col):
        runs.append(staged)
        if len(runs) == 2:
            names = sorted(n for n in os.listdir(staged) if n.startswith(col))
            for n in names[:moved]:
                os.system(f"rm -r {path}/{n}; mv {staged}/{n} {path}/{n}")
            if moved < len(names):
                os.system(f"rm -rf {path}/{names[moved]}")          # deleted, not yet replaced
            raise RuntimeError("driver died")
        return swap(spark_, path, staged, col)

    monkeypatch.setattr(S, "_swap", dying)
    rows = deliveries()
    drop(root, "r", "0", [reading_msg(r) for r in rows[0]])
    start(spark, root).awaitTermination()
    drop(root, "r", "1", [reading_msg(r) for r in rows[1]])
    with pytest.raises(Exception, match="driver died"):
        start(spark, root).awaitTermination()
    start(spark, root).awaitTermination()
    got = read_table(spark, f"{root}/silver")
    assert silver_rows(got) == silver_rows(all_readings(spark, root).select(*got.columns))


def test_merging_a_batch_twice(spark, tmp_path):
    path, rows = str(tmp_path / "t"), spark.createDataFrame(deliveries()[1])
    sil = silver.silver_readings(rows.withColumn("event_ts", F.timestamp_millis("t")).drop("t"))
    args = (silver.READING_KEY, [*silver.MEASURES, "occupancy"], "event_date")
    for batch in (0, 0, 1):
        assert S.merge_batch(spark, path, sil, batch, *args) == "merged"
    assert silver_rows(read_table(spark, path)) == silver_rows(sil.select(*read_table(spark, path).columns))
    assert S.merge_batch(spark, path, sil.limit(0), 2, *args) == "merged"
    assert read_table(spark, path).count() == sil.count()


def test_late_readings_are_counted_and_kept(spark, tmp_path):
    root = str(tmp_path)
    batches = [every(0, 600), every(660, 7800), [reading(60, device="late_dev")] + every(7860, 9000), []]
    rollup = []
    for i, rows in enumerate(batches):
        drop(root, "r", str(i), [reading_msg(r) for r in rows])
        values = reading_stream(file_values(spark, f"{root}/r"))
        late_readings_query(values, f"{root}/late", f"{root}/ck", trigger={"availableNow": True}).awaitTermination()
        q = (stream_hourly_rollup(values).writeStream.format("parquet").option("path", f"{root}/gold")
             .option("checkpointLocation", f"{root}/ck2").outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
        rollup += [op.numRowsDroppedByWatermark for p in q.recentProgress for op in p.stateOperators]
    counts = {r.batch: r for r in read_counts(spark, f"{root}/late").collect()}
    assert [counts[i].late for i in range(3)] == [0, 0, 1] and sum(r.readings for r in counts.values()) == sum(map(len, batches))
    assert counts[2].watermark_ms == T0 + 7_800_000 - 30_000 and counts[2].most_late_ms == 7_800_000 - 30_000 - 60_000
    late = read_late(spark, f"{root}/late").collect()
    assert [(r.device_id, r.event_time) for r in late] == [("late_dev", iso(T0 + 60_000))]
    assert sum(rollup) == 1                                   # what the rollup dropped is what was kept
    assert spark.read.parquet(f"{root}/gold").where("device_id = 'late_dev'").count() == 0


def bronze(spark, path, days):
    rows = [dict(reading(d * DAY + h * 3600), event_time=iso(T0 + (d * DAY + h * 3600) * 1000), eventTimeMillis=T0 + (d * DAY + h * 3600) * 1000)
            for d in days for h in range(0, 24, 6)]
    df = spark.createDataFrame(rows).drop("t")
    write_bronze(df, path, bucket_ts=F.timestamp_millis("eventTimeMillis"))
    return df


def test_pruned_scan(spark, tmp_path):
    path = str(tmp_path / "bronze")
    bronze(spark, path, range(10))
    assert refresh_stats(spark, path) == 40 and refresh_stats(spark, path) == 0
    since = T0 + 8 * DAY * 1000
    got = read_bronze_readings(spark, path, since_ms=since)
    assert got.count() == 8
    assert len(got.inputFiles()) == 40                        # of the relation; the plan reads fewer:
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThanOrEqual(eventTimeMillis" in plan and "PartitionFilters: [" in plan
    got.collect()
    scan = got._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == len(folders_since(spark, path, since)) == 8
    assert read_bronze_readings(spark, path, since_ms=T0 + 99 * DAY * 1000).count() == 0


def test_folders_that_changed_or_lack_times_are_read(spark, tmp_path):
    path = str(tmp_path / "bronze")
    bronze(spark, path, range(4))
    since = T0 + 3 * DAY * 1000
    assert len(folders_since(spark, path, since)) == 16       # no bounds yet
    refresh_stats(spark, path)
    assert len(folders_since(spark, path, since)) == 4
    old = f"{path}/dt=2023-11-14/hour=22"
    with open(f"{old}/new.json", "w") as f:                   # a late file with a new reading, and one without a time
        f.write(json.dumps({"device_id": "x", "event_time": iso(since), "eventTimeMillis": since}) + "\n")
    assert read_bronze_readings(spark, path, since_ms=since).where("device_id = 'x'").count() == 1
    assert refresh_stats(spark, path) == 1
    with open(f"{old}/newer.json", "w") as f:
        f.write(json.dumps({"device_id": "y", "event_time": iso(T0)}) + "\n")
    refresh_stats(spark, path)
    assert read_bronze_readings(spark, path, since_ms=since).where("device_id = 'y'").count() == 1
    assert refresh_stats(spark, str(tmp_path / "nothing")) == 0


def test_silver_deliveries_are_written_by_all_tasks(spark, monkeypatch, tmp_path):
    """Three micro-batches, each of a whole delivery, which no single task wrote."""
    from paths import SF001
    from roomlake.plans import contract

    rows = contract.testdata.readings
    monkeypatch.setattr(contract.testdata, "readings", lambda s, sf: rows(s, sf).repartition(3))
    monkeypatch.setattr(contract, "scratch_path", lambda s, name: str(tmp_path / name))
    got = sorted(map(tuple, contract.QUERIES["stream_silver"](spark, SF001).collect()))
    root = tmp_path / "stream-silver"
    assert [len(list((root / "in" / str(i)).glob("part-*"))) for i in range(3)] == [3] * 3
    assert sorted(int(p.name) for p in (root / "ckpt" / "commits").iterdir() if p.name.isdigit()) == [0, 1, 2]
    assert got == sorted(map(tuple, contract.QUERIES["silver_readings"](spark, SF001).collect()))
