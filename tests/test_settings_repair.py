import json
import os

import pytest

from roomlake.settings import DEFAULT_RULES, StreamSettings, rules_from_env, setting
from roomlake.sources.files import read_bronze


def test_env_overrides_and_blank_defaults():
    env = {"NO_OCC_LIGHT_DURATION_SECONDS": "120", "TEMP_WARNING_COOLDOWN_SECONDS": " "}
    r = {x.name: x for x in rules_from_env(env)}
    assert r["NO_OCC_LIGHT"].duration_s == 120
    assert r["TEMP_WARNING"].cooldown_s == DEFAULT_RULES[1].cooldown_s
    with pytest.raises(RuntimeError, match="KAFKA_BOOTSTRAP_SERVERS"):
        StreamSettings.from_env({})
    assert setting("X", "d", {"X": ""}) == "d"


def test_repair_table_sees_new_partitions(spark, tmp_path):
    from roomlake.schemas import BRONZE_READING
    path = str(tmp_path / "bronze")
    os.makedirs(f"{path}/dt=2024-01-01/hour=00")
    with open(f"{path}/dt=2024-01-01/hour=00/a.json", "w") as f:
        f.write(json.dumps({"event_time": "2024-01-01T00:00:00Z", "device_id": "d"}) + "\n")
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BRONZE_READING.fields)
    spark.sql("DROP TABLE IF EXISTS bronze_readings_t")
    spark.sql(f"CREATE TABLE bronze_readings_t ({cols}, dt STRING, hour STRING) USING json "
              f"PARTITIONED BY (dt, hour) LOCATION '{path}'")
    os.makedirs(f"{path}/dt=2024-01-02/hour=05")
    with open(f"{path}/dt=2024-01-02/hour=05/b.json", "w") as f:
        f.write(json.dumps({"event_time": "2024-01-02T05:00:00Z", "device_id": "d"}) + "\n")
    df = read_bronze(spark, path, BRONZE_READING, repair_table="bronze_readings_t")
    assert sorted(r.dt for r in df.collect()) == ["2024-01-01", "2024-01-02"]
    spark.sql("DROP TABLE IF EXISTS bronze_readings_t")
