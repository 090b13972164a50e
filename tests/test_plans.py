"""Plan shapes the scale design relies on (checked on the physical plan)."""
from pyspark.sql import functions as F

from paths import SF001
from roomlake.operators import gold, silver
from roomlake.operators.breaches import rule_columns
from roomlake.operators.config import join_config, latest_config
from roomlake.plans import contract as C
from roomlake.sources import testdata


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_config_join_is_decided_at_run_time_and_scan_is_pruned(spark):
    j = join_config(testdata.readings(spark, SF001), latest_config(testdata.config_updates(spark, SF001)))
    wide, _ = rule_columns(j, C.CONTRACT_RULES)
    wide.write.format("noop").mode("overwrite").save()
    p = plan(wide)
    # only the six columns the readings view needs leave the events scan
    assert ("ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,"
            "event_type:string,value:double,props:string>") in p
    assert "InMemoryRelation" not in p
    j.collect()
    assert "BroadcastHashJoin" in plan(j)            # measured small: adaptive execution broadcasts it


def test_config_join_reads_configs_anew(spark, tmp_path):
    path = str(tmp_path / "cfg.json")
    line = ('{"device_id": "d", "user_id": "u", "updated_at": "2024-01-01T00:00:00Z", "temperature_warning_threshold": %s,'
            ' "temperature_violation_threshold": 50.0, "no_occupancy_light_threshold": 30.0}')
    readings = spark.createDataFrame([("d", 1)], "device_id string, t long")
    for value in (10.0, 99.0):
        with open(path, "w") as f:
            f.write(line % value + "\n")
        cfg = latest_config(spark.read.json(path))
        assert join_config(readings, cfg).first()["temperature_warning_threshold"] == value
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_large_config_side_is_not_broadcast(spark):
    j = join_config(testdata.readings(spark, SF001), latest_config(testdata.config_updates(spark, SF001)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j.collect()
        assert "BroadcastHashJoin" not in plan(j)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_gold_aggregates_partially_before_the_shuffle(spark):
    p = plan(gold.hourly_device_rollup(C._silver(spark, SF001)))
    assert "partial_avg" in p and "partial_min" in p


def test_silver_dedup_limits_before_the_shuffle(spark):
    p = plan(silver.silver_readings(C.bronze_readings_rows(spark, SF001)))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_detector_stages_with_one_range_exchange(spark):
    j = C.joined(spark, SF001)
    wide, ties = rule_columns(j, C.CONTRACT_RULES, tie_cols=C.TIE)
    staged = wide.repartitionByRange(4, "_k", "t", *ties).sortWithinPartitions("_k", "t", *ties) \
        .withColumn("_pid", F.spark_partition_id())
    p = plan(staged)
    assert p.count("Exchange rangepartitioning") == 1
    # a single range shuffle of the joined rows; which join side is shipped is decided from measured sizes
    assert "FileScan parquet [event_id" in p


def test_incremental_reads_prune_partitions(spark, tmp_path):
    import datetime as dt

    from roomlake.operators import tables
    from roomlake.sources.files import read_bronze_readings, write_bronze

    rows = C.bronze_readings_rows(spark, SF001)
    write_bronze(rows, str(tmp_path / "b"), bucket_ts=F.to_timestamp("event_time"))
    b = read_bronze_readings(spark, str(tmp_path / "b"), since_date=dt.date(2024, 1, 20))
    assert "PartitionFilters: [isnotnull(dt" in plan(b) and "2024-01-20" in plan(b)
    tables.upsert(spark, str(tmp_path / "s"), silver.silver_readings(rows), "pk_sensor_event_id",
                  "event_date")
    s = tables.read_table(spark, str(tmp_path / "s")).where(F.col("event_date") >= F.lit("2024-01-20").cast("date"))
    assert "PartitionFilters: [isnotnull(event_date" in plan(s)


def test_console_sink_runs(spark, tmp_path):
    from roomlake.streaming.jobs import console_query, file_values, reading_stream

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(
        '{"event_time":"2024-01-01T00:00:00Z","device_id":"d","temperature":1.0}\n')
    q = console_query(reading_stream(file_values(spark, str(tmp_path / "in"))),
                      trigger={"availableNow": True})
    q.awaitTermination()
    assert q.lastProgress["numInputRows"] == 1


def test_time_expressions_are_not_repeated(spark):
    """Parsing binds its argument once: filters stay short even where the argument is an expression itself."""
    from roomlake.plans.contract import QUERIES

    plan = QUERIES["silver_readings"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    longest = max(len(line) for line in plan.splitlines() if "Filter" in line)
    assert longest < 5000 and plan.count("unix_seconds") < 40


def test_nan_and_infinity_are_no_measures(spark):
    from roomlake.functions.messages import parse_readings

    line = '{"device_id":"d","event_time":"2024-01-01T00:00:00Z","temperature":%s}'
    df = spark.createDataFrame([(line % v,) for v in ('"NaN"', '"Infinity"', '"-Infinity"', '21.5')], "value string")
    got = [(r._corrupt, r.temperature) for r in parse_readings(df).collect()]
    assert got == [(True, None)] * 3 + [(False, 21.5)]
