import json

from pyspark.sql import functions as F

from roomlake.functions.messages import (alert_messages, header_value, parse_configs, parse_readings,
                                         quarantine, reading_messages)
from roomlake.operators.silver import silver_readings
from roomlake.schemas import ALERT_MESSAGE
from roomlake.operators.checks import require_columns

import pytest

GOOD = {"event_time": "2015-02-04T17:51:00Z", "device_id": "dev_123", "temperature": 23.18,
        "humidity": 27.27, "light": 426.0, "co2": 721.25, "humidity_ratio": 0.0048,
        "occupancy": 1}


def _lines(spark, items):
    return spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in items],
                                 "value string")


def test_bad_inputs(spark):
    items = [
        GOOD,
        "not json at all",
        {k: v for k, v in GOOD.items() if k != "event_time"},
        {k: v for k, v in GOOD.items() if k != "occupancy"},
        dict(GOOD, temperature="23.1x"),
        dict(GOOD, event_time="2015-02-04T18:51:00+01:00"),
        dict(GOOD, event_time="2015-02-04T17:51:00"),
        dict(GOOD, extra_key=5),
        dict(GOOD, device_id=None),
        dict(GOOD, occupancy=1.0, temperature="35.5"),
        dict(GOOD, occupancy="x"),
        dict(GOOD, light=None, co2=""),
        dict(GOOD, temperature=True),
    ]
    parsed = parse_readings(_lines(spark, items)).collect()
    corrupt = [r._corrupt for r in parsed]
    assert corrupt == [False, True, True, False, True, False, True, False, False, False, True, False, True]
    assert parsed[5].eventTimeMillis == parsed[0].eventTimeMillis   # +01:00 is the same instant
    assert parsed[3].occupancy is None
    assert (parsed[9].occupancy, parsed[9].temperature) == (1, 35.5)
    assert parsed[11].light is None and parsed[11].co2 is None
    good, bad = quarantine(parse_readings(_lines(spark, items)))
    assert bad.count() == 6
    s = silver_readings(good.select("event_time", "device_id", "temperature", "humidity", "light",
                                    "co2", "humidity_ratio", "occupancy"))
    # null device dropped; GOOD, +01:00 and extra_key are one reading -> one row,
    # the others differ in their measures only and have the same key
    assert s.count() == 1


def test_failfast(spark):
    with pytest.raises(ValueError):
        quarantine(parse_readings(_lines(spark, ["{bad"])), mode="failfast")


def test_message_shapes(spark):
    df = spark.createDataFrame([GOOD])
    m = reading_messages(df).select("key", "value", header_value("producer").alias("p"),
                                    header_value("content_type").alias("ct")).first()
    assert m.key == "dev_123" and m.p == "iot-producer" and m.ct == "application/json"
    assert json.loads(m.value)["co2"] == 721.25
    alert = spark.createDataFrame([("2024-01-01T00:00:00.000Z", "u", "d", "TEMP_WARNING", "WARNING",
                                    "temperature", 29.0, 28.0, 1, 2)],
                                  "alert_time string, user_id string, device_id string, rule string, "
                                  "severity string, metric string, observed_value double, "
                                  "threshold_value double, window_start_ms long, window_end_ms long")
    a = alert_messages(alert).select("key", F.size("headers").alias("n"),
                                     header_value("rule").alias("r")).first()
    assert (a.key, a.n, a.r) == ("u:d:TEMP_WARNING", 5, "TEMP_WARNING")


def test_required_columns():
    with pytest.raises(RuntimeError, match="missing columns"):
        require_columns(["date", "Temperature"], ["date", "Temperature", "CO2"], "iot csv")


def test_latest_config_from_parsed_messages(spark):
    from roomlake.functions.messages import config_messages, parse_configs
    from roomlake.operators.config import latest_config
    rows = [("2024-01-01T00:00:00Z", "user_001", "dev_123", 28.0, 30.0, 40.0),
            ("2024-01-02T00:00:00+01:00", "user_002", "dev_123", 26.0, 28.0, 30.0),
            ("2023-12-31T00:00:00Z", "user_003", "dev_123", 20.0, 22.0, 10.0)]
    cfg = spark.createDataFrame(rows, "updated_at string, user_id string, device_id string, "
                                "temperature_warning_threshold double, "
                                "temperature_violation_threshold double, "
                                "no_occupancy_light_threshold double")
    parsed = parse_configs(config_messages(cfg))
    assert latest_config(parsed).first().user_id == "user_002"
    assert latest_config(cfg).first().user_id == "user_002"     # ISO string only


def test_csv_missing_required_column_raises(spark, tmp_path):
    from roomlake.sources.files import read_sensor_csv, read_threshold_csv
    (tmp_path / "s.csv").write_text("date,Temperature,Humidity,Light,CO2,Occupancy\n"
                                    "2015-02-04 17:51:00,23.1,27.2,426.0,721.2,1\n")
    with pytest.raises(RuntimeError, match=r"missing columns: \['HumidityRatio'\]"):
        read_sensor_csv(spark, str(tmp_path / "s.csv"))
    (tmp_path / "t.csv").write_text("user_id,device_id,temperature_warning_threshold,"
                                    "temperature_violation_threshold,light_threshold,extra\n"
                                    "u,d,28,30,40,x\n")
    assert read_threshold_csv(spark, str(tmp_path / "t.csv")).count() == 1   # extras allowed


def test_silver_parses_leniently_and_skips_unparseable(spark):
    rows = [("2015-02-04T17:51:00", "d", 1.0), ("2015-02-04T18:51:00+01:00", "d", 2.0),
            ("not a time", "d", 3.0), ("2015-02-04T17:52:00Z", "d", 4.0)]
    b = spark.createDataFrame(rows, "event_time string, device_id string, temperature double") \
        .select("*", *[F.lit(0.0).alias(c) for c in ["humidity", "light", "co2", "humidity_ratio"]],
                F.lit(1).alias("occupancy"))
    got = sorted((r.event_ts.isoformat(), r.temperature) for r in silver_readings(b).collect())
    # offset-less reads as UTC and equals the +01:00 reading: one key, greatest measures kept
    assert got == [("2015-02-04T17:51:00", 2.0), ("2015-02-04T17:52:00", 4.0)]


def test_absent_threshold_is_zero_and_bad_ones_are_flagged(spark):
    base = {"updated_at": "2024-01-01T00:00:00Z", "user_id": "u", "device_id": "d", "temperature_warning_threshold": "21.5"}
    got = parse_configs(_lines(spark, [base, dict(base, no_occupancy_light_threshold="many")])).collect()
    assert [r._corrupt for r in got] == [False, True]
    assert (got[0].temperature_warning_threshold, got[0].temperature_violation_threshold) == (21.5, 0.0)


def test_null_parts_keep_their_place(spark):
    alert = spark.createDataFrame([("2024-01-01T00:00:00.000Z", None, "d", "R", "WARNING", "m", 1.0, 2.0, 3, 4)], ALERT_MESSAGE)
    m = alert_messages(alert).first()
    assert m.key == "null:d:R" and json.loads(m.value)["user_id"] is None
