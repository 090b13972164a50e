"""Dates, hours, keys and slices are in UTC, whatever the session zone."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from roomlake.functions.columns import (hour_ts, iso_utc_string, lookback_cutoff, surrogate_key, ts_literal, utc_date,
                                        utc_hour, utc_string)
from roomlake.operators import tables
from roomlake.plans import contract as C
from paths import SF001

ZONES = ["UTC", "America/New_York", "Asia/Tokyo", "Asia/Kolkata"]
TIMES = [dt.datetime(2024, 3, 10, 7, 30, 1, 5), dt.datetime(2024, 1, 15, 23, 59, 59, 999999), dt.datetime(1969, 12, 31, 22, 0, 0, 1),
         dt.datetime(2024, 11, 3, 6, 15)]


@pytest.fixture(params=ZONES[1:])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def test_parts_and_keys(spark, zone):
    for t in TIMES:
        df = spark.range(1).select(ts_literal(t).alias("ts"))
        r = df.select(utc_date("ts").cast("string"), utc_hour("ts"), utc_string("ts", " ", 6),
                      iso_utc_string("ts", True), utc_string(hour_ts("ts")), surrogate_key(df, ["ts"])).first()
        assert r[0] == t.strftime("%Y-%m-%d") and r[1] == t.hour
        assert r[2] == t.strftime("%Y-%m-%d %H:%M:%S.%f")
        assert r[3] == t.strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"
        assert r[4] == t.strftime("%Y-%m-%d %H:00:00")
        import hashlib
        assert r[5] == hashlib.md5(r[2].encode()).hexdigest()


def test_slice_replace_keeps_rows_before_the_cutoff(spark, zone, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *xs: spark.createDataFrame([(n, int(t.replace(tzinfo=dt.timezone.utc).timestamp())) for n, t in xs],
                                             "name string, s long").select(
        "name", F.timestamp_seconds("s").alias("hour_ts"), utc_date(F.timestamp_seconds("s")).alias("hour_date"))
    day = lambda d, h: dt.datetime(2024, 1, d, h)
    tables.replace_slice(spark, path, rows(("keep", day(15, 12)), ("keep2", day(15, 20)), ("old", day(16, 3)), ("gone", day(17, 1))),
                         "hour_ts", day(1, 0))
    cutoff = day(16, 2).replace(tzinfo=dt.timezone.utc).astimezone(dt.timezone(dt.timedelta(hours=-5)))
    tables.replace_slice(spark, path, rows(("new", day(16, 4))), "hour_ts", cutoff)
    assert sorted(r["name"] for r in tables.read_table(spark, path).collect()) == ["keep", "keep2", "new"]


def test_cutoff_takes_aware_times():
    aware = dt.datetime(2024, 1, 16, 0, 30, tzinfo=dt.timezone(dt.timedelta(hours=9)))
    assert lookback_cutoff(aware, 2) == dt.datetime(2024, 1, 15, 13)


@pytest.mark.parametrize("name", ["silver_readings", "gold_hourly_breach_counts", "gold_slice_replace", "threshold_alerts",
                                  "readings_projection", "incremental_lookback"])
def test_contract_rows_do_not_depend_on_the_zone(spark, name):
    found = []
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            found.append(sorted(map(repr, C.QUERIES[name](spark, SF001).collect())))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found[0] == found[1]
