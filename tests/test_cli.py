"""The command line runs the reference's flow: CSV -> messages -> live job ->
bronze -> lakehouse."""
import datetime as dt

from roomlake.__main__ import main
from roomlake.operators import tables

# The sample threshold file of the source (fixed values): two users, one device.
THRESHOLDS = """user_id,device_id,temperature_warning_threshold,temperature_violation_threshold,light_threshold
user_001,dev_123,28,30,40
user_002,dev_123,26,28,30
"""


def test_cli_end_to_end(spark, tmp_path):
    root = tmp_path
    (root / "thr.csv").write_text(THRESHOLDS)
    start = dt.datetime(2015, 2, 4, 17, 0)
    lines = ["date,Temperature,Humidity,Light,CO2,HumidityRatio,Occupancy,extra"]
    for m in range(0, 31):                     # 30 minutes at 27 degrees, one per minute
        ts = (start + dt.timedelta(minutes=m)).strftime("%Y-%m-%d %H:%M:%S")
        lines.append(f"{ts},27.0,27.2,0.0,720.0,0.0048,1,x")
    (root / "sensor.csv").write_text("\n".join(lines) + "\n")
    assert main(["publish-csv", "--kind", "threshold", "--csv", str(root / "thr.csv"),
                 "--out", str(root / "cfg")]) == 0
    assert main(["publish-csv", "--kind", "sensor", "--csv", str(root / "sensor.csv"),
                 "--out", str(root / "rd")]) == 0
    assert main(["alerts", "--source", "files", "--readings", str(root / "rd"),
                 "--configs", str(root / "cfg"), "--bronze-readings", str(root / "b_r"),
                 "--bronze-alerts", str(root / "b_a"), "--checkpoint-root", str(root / "ck"),
                 "--once"]) == 0
    assert main(["lakehouse", "--bronze-readings", str(root / "b_r"), "--bronze-alerts",
                 str(root / "b_a"), "--lake-root", str(root / "lake")]) == 0
    sa = tables.read_table(spark, str(root / "lake/silver_threshold_breached_alerts")).collect()
    # configs in one batch: the newest wins, on ties the changelog order, then user;
    # user_002 (26) warns at minute 20 and 30 (cooldown 10 min), user_001 would not
    got = sorted((r.user_id, r.rule, r.window_end_ms - r.window_start_ms) for r in sa)
    assert got == [("user_002", "TEMP_WARNING", 1_200_000), ("user_002", "TEMP_WARNING", 1_800_000)]
    sr = tables.read_table(spark, str(root / "lake/silver_iot_sensor_readings"))
    assert sr.count() == 31
