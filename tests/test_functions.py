"""Column functions: ISO-8601 parsing (strict for messages, lenient for
silver), independent of the session time zone; detector partition sizing."""
import pytest
from pyspark.sql import functions as F

from paths import SF01
from roomlake.functions.columns import iso_instant, iso_timestamp, naive_as_utc

MS = 1423072260000          # 2015-02-04T17:51:00Z

CASES = [  # value, strict (messages), lenient (silver)
    ("2015-02-04T17:51:00Z", MS, MS),
    ("2015-02-04T17:51:00.123456789Z", MS + 123, MS + 123),
    ("2015-02-04T17:51Z", MS, MS),
    ("2015-02-04T18:51:00+01:00", MS, MS),
    ("2015-02-04T16:51:00-01:00", MS, MS),
    ("2015-02-04T17:51:00z", MS, MS),
    ("2015-02-04T17:51:00", None, MS),
    ("2015-02-04", None, MS - (17 * 60 + 51) * 60_000),
    ("2015-02-04 17:51:00Z", None, None),
    ("garbage", None, None),
    (None, None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_iso_parsing(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(v,) for v, _, _ in CASES], "s string")
        got = df.select(F.unix_millis(iso_instant("s")).alias("a"),
                        F.unix_millis(iso_timestamp("s")).alias("b")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [(r.a, r.b) for r in got] == [(a, b) for _, a, b in CASES]


def test_naive_csv_dates_are_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.createDataFrame([("2015-02-04 17:51:00",), ("2015-02-04 17:51:00Z",)], "d string")
        got = [r[0] for r in df.select(F.unix_millis(naive_as_utc("d"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [MS, MS]


def test_detector_partitions_follow_input_size(spark):
    from roomlake.operators.breaches import _estimate_partitions, rule_columns
    from roomlake.plans import contract as C

    wide, _ = rule_columns(C.joined(spark, SF01), C.CONTRACT_RULES)
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert _estimate_partitions(wide, 2_000_000) == base              # small input
    assert _estimate_partitions(wide, 2_000_000, 10_000) > base        # 10 kB per partition
