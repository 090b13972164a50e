"""DuckDB SQL twins of the contract queries (correctness oracle).

Written independently of the Spark code: window functions for islands, a
recursive CTE for the cooldown fold, ``md5`` over '-'-joined strings for
keys.  Epoch milliseconds are ``epoch_us(ts) // 1000`` (``epoch_ms`` would
round where Spark floors).
"""

from __future__ import annotations

from roomlake.functions.columns import KEY_NULL
from roomlake.sources.testdata import CHANGES_SQL, CONFIG_SQL, READINGS_SQL

DUR_MS = 12 * 3600 * 1000
CD_MS = 24 * 3600 * 1000
CUTOFF = "TIMESTAMP '2024-01-15 22:00:00'"
NOW_ISO = "2024-01-16T00:30:00.000000Z"
NOW_MS = 1705365000000

TS = "'%Y-%m-%d %H:%M:%S.%f'"
HOUR = "'%Y-%m-%d %H:%M:%S'"
MEAS = "temperature, humidity, light, co2, humidity_ratio"
THR = "temperature_warning_threshold, temperature_violation_threshold, no_occupancy_light_threshold"


def r4(x: str) -> str:
    return f"floor(({x}) * 10000.0 + 0.5) / 10000.0"


def key(*parts: str) -> str:
    return "md5(" + " || '-' || ".join(f"coalesce({p}, '{KEY_NULL}')" for p in parts) + ")"


def base(config_key: str = "device_id") -> str:
    return f"""
r AS ({READINGS_SQL}),
c AS ({CONFIG_SQL}),
latest AS (SELECT * FROM c QUALIFY row_number() OVER (
           PARTITION BY {config_key} ORDER BY updated_ts DESC, seq DESC) = 1),
j AS (SELECT r.*, l.user_id, l.temperature_warning_threshold,
             l.temperature_violation_threshold, l.no_occupancy_light_threshold
      FROM r JOIN latest l USING (device_id))
"""


BASE = base()

#: readings with the config in force at each
IN_FORCE = f"""
r AS ({READINGS_SQL}),
c AS (SELECT * FROM ({CHANGES_SQL}) QUALIFY row_number() OVER (PARTITION BY device_id, updated_ts ORDER BY seq DESC) = 1),
j AS (SELECT r.*, c.user_id, c.temperature_warning_threshold,
             c.temperature_violation_threshold, c.no_occupancy_light_threshold
      FROM r ASOF JOIN c ON r.device_id = c.device_id AND r.ts >= c.updated_ts)
"""

RULES = [
    ("NO_OCC_LIGHT", "VIOLATION", "light",
     "occupancy = 0 AND light > no_occupancy_light_threshold", "light",
     "no_occupancy_light_threshold"),
    ("TEMP_WARNING", "WARNING", "temperature", "temperature > temperature_warning_threshold",
     "temperature", "temperature_warning_threshold"),
    ("TEMP_VIOLATION", "VIOLATION", "temperature",
     "temperature > temperature_violation_threshold", "temperature",
     "temperature_violation_threshold"),
]


#: a rule of the user's own beside the three
OWN_RULE = ("CO2_OR_HEAT", "VIOLATION", "co2", "(co2 >= 480 OR (temperature > 45.0 AND occupancy = 1))", "co2",
            "temperature_violation_threshold")


def _rules_union(rules) -> str:
    parts = []
    for name, sev, metric, cond, obs, thr in rules:
        parts.append(
            f"SELECT user_id, device_id, event_id, ts, t, '{name}' AS rule, '{sev}' AS severity, "
            f"'{metric}' AS metric, coalesce({cond}, false) AS cond, "
            f"CAST({obs} AS DOUBLE) AS observed_value, CAST({thr} AS DOUBLE) AS threshold_value FROM j")
    return "\nUNION ALL\n".join(parts)


def _candidates(dur_ms: int, gap_ms: int | None = None, keys: str = "user_id, device_id", rules=tuple(RULES)) -> str:
    silence = "false" if gap_ms is None else f"t - prev_t > {gap_ms}"
    return f"""
ru0 AS ({_rules_union(rules)}),
ru AS (SELECT *, lag(t) OVER (PARTITION BY {keys}, rule ORDER BY ts, event_id)
                 AS prev_t FROM ru0),
isl AS (SELECT *,
          sum(CASE WHEN cond AND NOT coalesce({silence}, false) THEN 0 ELSE 1 END)
            OVER w AS island,
          row_number() OVER w AS ord
        FROM ru
        WINDOW w AS (PARTITION BY {keys}, rule ORDER BY ts, event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
st AS (SELECT *,
          min(CASE WHEN cond AND t <> 0 THEN ord END)
            OVER (PARTITION BY {keys}, rule, island) AS s_ord,
          min(CASE WHEN cond AND t <> 0 THEN t END)
            OVER (PARTITION BY {keys}, rule, island) AS s_t
       FROM isl),
cand AS (SELECT * FROM st
         WHERE cond AND s_ord IS NOT NULL AND ord > s_ord AND t - s_t >= {dur_ms})
"""


def _alerts_ctes(dur_ms: int = DUR_MS, cd_ms: int = CD_MS, config_key: str = "device_id",
                 gap_ms: int | None = None, joined: str | None = None, keys: str = "user_id, device_id",
                 rules=tuple(RULES)) -> str:
    same = " AND ".join(f"n.{k} = rec.{k}" for k in keys.split(", "))
    return f"""WITH RECURSIVE {joined or base(config_key)},
{_candidates(dur_ms, gap_ms, keys, rules)},
cn AS (SELECT *, row_number() OVER (PARTITION BY {keys}, rule
                                    ORDER BY ts, event_id) AS k FROM cand),
rec AS (
  SELECT {keys}, rule, k,
         CASE WHEN t >= {cd_ms} THEN t ELSE 0 END AS last_ms,
         t >= {cd_ms} AS emitted
  FROM cn WHERE k = 1
  UNION ALL
  SELECT {", ".join(f"n.{k}" for k in keys.split(", "))}, n.rule, n.k,
         CASE WHEN n.t - rec.last_ms >= {cd_ms} THEN n.t ELSE rec.last_ms END,
         n.t - rec.last_ms >= {cd_ms}
  FROM rec JOIN cn n ON {same} AND n.rule = rec.rule AND n.k = rec.k + 1),
alerts AS (
  SELECT strftime(make_timestamp(cn.t * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS alert_time,
         cn.user_id, cn.device_id, cn.rule, cn.severity, cn.metric, cn.observed_value,
         cn.threshold_value, cn.s_t AS window_start_ms, cn.t AS window_end_ms
  FROM rec JOIN cn USING ({keys}, rule, k) WHERE rec.emitted)"""


ALERT_COLS = ("alert_time, user_id, device_id, rule, severity, metric, observed_value, "
              "threshold_value, window_start_ms, window_end_ms")


def _silver_alerts_ctes() -> str:
    return _alerts_ctes() + f""",
b AS (SELECT * FROM alerts UNION ALL SELECT * FROM alerts),
sa AS (SELECT *, make_timestamp(window_end_ms * 1000) AS alert_ts FROM b),
sk AS (SELECT {key('user_id', 'device_id', 'rule', 'severity', f'strftime(alert_ts, {TS})')}
                 AS pk_alert_event_id, *,
              row_number() OVER (PARTITION BY user_id, device_id, rule, severity, alert_ts
                                 ORDER BY window_end_ms DESC, window_start_ms DESC,
                                          observed_value DESC, threshold_value DESC,
                                          metric DESC) AS rnk
       FROM sa),
silver_a AS (SELECT * FROM sk WHERE rnk = 1)"""


def _gold_metrics(src: str) -> str:
    aggs = []
    for m in ["temperature", "humidity", "light", "co2"]:
        aggs += [f"{r4(f'avg({m})')} AS avg_{m}", f"min({m}) AS min_{m}", f"max({m}) AS max_{m}"]
    aggs.append(f"{r4('avg(humidity_ratio)')} AS avg_humidity_ratio")
    h = "date_trunc('hour', ts)"
    return (f"SELECT {key('device_id', f'strftime({h}, {TS})')} AS pk_sensor_device_hour_id, "
            f"device_id, strftime({h}, {HOUR}) AS hour_ts, {', '.join(aggs)} "
            f"FROM {src} GROUP BY device_id, {h}")


def _check_rows() -> str:
    rk = key("device_id", f"strftime(ts, {TS})")
    hk = key("device_id", f"strftime(date_trunc('hour', ts), {TS})")
    bk = key("device_id", f"strftime(date_trunc('hour', alert_ts), {TS})", "severity", "rule")
    rows = [
        ("silver_iot_sensor_readings", "pk_sensor_event_id",
         f"SELECT {rk} AS k, count(*) AS n FROM r GROUP BY 1", f"SELECT {rk} AS k FROM r"),
        ("silver_threshold_breached_alerts", "pk_alert_event_id",
         "SELECT pk_alert_event_id AS k, count(*) AS n FROM silver_a GROUP BY 1",
         "SELECT pk_alert_event_id AS k FROM silver_a"),
        ("gold_sensor_hourly_metrics", "pk_sensor_device_hour_id",
         f"SELECT k, count(*) AS n FROM (SELECT {hk} AS k FROM r GROUP BY device_id, "
         f"date_trunc('hour', ts)) GROUP BY k",
         f"SELECT {hk} AS k FROM r GROUP BY device_id, date_trunc('hour', ts)"),
        ("gold_hourly_occupancy_rate", "pk_sensor_device_hour_id",
         f"SELECT k, count(*) AS n FROM (SELECT {hk} AS k FROM r GROUP BY device_id, "
         f"date_trunc('hour', ts)) GROUP BY k",
         f"SELECT {hk} AS k FROM r GROUP BY device_id, date_trunc('hour', ts)"),
        ("gold_hourly_breach_counts", "pk_alert_hour_id",
         f"SELECT k, count(*) AS n FROM (SELECT {bk} AS k FROM silver_a GROUP BY device_id, "
         f"date_trunc('hour', alert_ts), severity, rule) GROUP BY k",
         f"SELECT {bk} AS k FROM silver_a GROUP BY device_id, date_trunc('hour', alert_ts), "
         f"severity, rule"),
    ]
    out = []
    for table, col, grouped, plain in rows:
        out.append(f"SELECT '{table}' AS table_name, '{col}' AS column_name, 'unique' AS check_name, "
                   f"(SELECT count(*) FROM ({grouped}) g WHERE n > 1 AND k IS NOT NULL) AS failures")
        out.append(f"SELECT '{table}', '{col}', 'not_null', "
                   f"(SELECT count(*) FROM ({plain}) p WHERE k IS NULL)")
    return "\nUNION ALL\n".join(out)


def oracle_sql() -> dict[str, str]:
    sil = (f"{key('device_id', f'strftime(ts, {TS})')} AS pk_sensor_event_id, "
           f"strftime(ts, {TS}) AS event_ts, strftime(ts, '%Y-%m-%d') AS event_date, "
           f"CAST(hour(ts) AS INTEGER) AS event_hour, device_id, {MEAS}, occupancy, "
           f"CAST(1 AS BIGINT) AS rnk")
    q = {}
    q["readings_projection"] = f"""WITH {BASE}
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS event_time, 'dev_123' AS device_id, {MEAS},
       occupancy, strftime(ts, '%Y-%m-%d') AS event_date, CAST(hour(ts) AS INTEGER) AS event_hour
FROM r"""
    q["reading_json_roundtrip"] = f"""WITH {BASE}
SELECT device_id AS key, device_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time,
       t AS event_time_ms, {MEAS}, occupancy, 'iot_reading' AS event_type,
       '1' AS schema_version, false AS corrupt
FROM r"""
    q["config_json_parse"] = f"""WITH {BASE}
SELECT user_id || ':' || device_id AS key, user_id, device_id, '{NOW_ISO}' AS updated_at,
       CAST({NOW_MS} AS BIGINT) AS updated_at_ms, user_id || ':' || device_id AS user_device_key,
       {THR}, 'config-producer' AS producer
FROM c"""
    q["silver_readings"] = f"""WITH {BASE},
b AS (SELECT device_id, ts, {MEAS}, occupancy FROM r
      UNION ALL SELECT device_id, ts, {MEAS}, occupancy FROM r
      UNION ALL SELECT device_id, ts, temperature + 0.5, humidity, light, co2, humidity_ratio,
                       occupancy FROM r),
d AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY device_id, ts
        ORDER BY temperature DESC NULLS LAST, humidity DESC NULLS LAST, light DESC NULLS LAST,
                 co2 DESC NULLS LAST, humidity_ratio DESC NULLS LAST,
                 occupancy DESC NULLS LAST) = 1)
SELECT {sil} FROM d"""
    q["silver_alerts"] = _silver_alerts_ctes() + f"""
SELECT pk_alert_event_id, strftime(alert_ts, {TS}) AS alert_ts,
       strftime(alert_ts, '%Y-%m-%d') AS alert_date, CAST(hour(alert_ts) AS INTEGER) AS alert_hour,
       user_id, device_id, rule, severity, metric, observed_value, threshold_value,
       window_start_ms, window_end_ms, rnk
FROM silver_a"""
    q["gold_sensor_hourly_metrics"] = f"WITH {BASE}\n{_gold_metrics('r')}"
    h = "date_trunc('hour', ts)"
    q["gold_hourly_occupancy_rate"] = f"""WITH {BASE}
SELECT {key('device_id', f'strftime({h}, {TS})')} AS pk_sensor_device_hour_id, device_id,
       strftime({h}, {HOUR}) AS hour_ts, {r4('avg(CAST(occupancy AS DOUBLE))')} AS occupancy_rate
FROM r GROUP BY device_id, {h}"""
    ha = "date_trunc('hour', alert_ts)"
    q["gold_hourly_breach_counts"] = _silver_alerts_ctes() + f"""
SELECT {key('device_id', f'strftime({ha}, {TS})', 'severity', 'rule')} AS pk_alert_hour_id,
       device_id, strftime({ha}, {HOUR}) AS hour_ts, severity, rule, count(*) AS breach_count
FROM silver_a GROUP BY device_id, {ha}, severity, rule"""
    q["latest_config_by_device"] = f"""WITH {BASE}
SELECT device_id, user_id, strftime(updated_ts, {HOUR}) AS updated_ts, seq, {THR} FROM latest"""
    q["reading_config_join"] = f"""WITH {BASE}
SELECT event_id, device_id, user_id, strftime(ts, {TS}) AS event_ts, t, {MEAS}, occupancy, {THR}
FROM j"""
    for (name, sev, _metric, cond, obs, thr), qname in zip(
            RULES, ["rule_no_occ_light", "rule_temp_warning", "rule_temp_violation"]):
        q[qname] = f"""WITH {BASE}
SELECT event_id, user_id, device_id, t, '{name}' AS rule, '{sev}' AS severity,
       CAST({obs} AS DOUBLE) AS observed_value, CAST({thr} AS DOUBLE) AS threshold_value
FROM j WHERE coalesce({cond}, false)"""
    q["sustained_episodes"] = f"""WITH {BASE},
{_candidates(DUR_MS)}
SELECT user_id, device_id, rule, severity, metric, observed_value, threshold_value,
       s_t AS window_start_ms, t AS window_end_ms
FROM cand"""
    q["threshold_alerts"] = _alerts_ctes() + f"\nSELECT {ALERT_COLS} FROM alerts"
    q["threshold_alerts_per_user"] = (_alerts_ctes(config_key="device_id, user_id")
                                      + f"\nSELECT {ALERT_COLS} FROM alerts")
    q["threshold_alerts_max_gap"] = (_alerts_ctes(gap_ms=18 * 3600 * 1000)
                                     + f"\nSELECT {ALERT_COLS} FROM alerts")
    q["reading_config_in_force"] = f"""WITH {IN_FORCE}
SELECT event_id, device_id, user_id, strftime(ts, {TS}) AS event_ts, temperature, light, occupancy, {THR} FROM j"""
    q["replay_alerts"] = (_alerts_ctes(joined=IN_FORCE, keys="device_id") + f"\nSELECT {ALERT_COLS} FROM alerts")
    q["alert_messages"] = _alerts_ctes() + f"""
SELECT user_id || ':' || device_id || ':' || rule AS key, {ALERT_COLS},
       '1' AS h_schema_version, 'threshold_breached_alert' AS h_event_type,
       'flink-alerting-job' AS h_producer, severity AS h_severity, rule AS h_rule
FROM alerts"""
    q["incremental_lookback"] = f"""WITH {BASE}
SELECT {key('device_id', f'strftime(ts, {TS})')} AS pk_sensor_event_id,
       strftime(ts, {TS}) AS event_ts, device_id, temperature
FROM r WHERE ts >= {CUTOFF}"""
    q["high_water_mark"] = f"""WITH {BASE}
SELECT '*' AS device_id, strftime(max(ts) - INTERVAL 2 HOUR, {TS}) AS hwm FROM r
UNION ALL
SELECT device_id, strftime(max(ts) - INTERVAL 2 HOUR, {TS}) FROM r GROUP BY device_id"""
    q["silver_upsert"] = f"""WITH {BASE}
SELECT {key('device_id', f'strftime(ts, {TS})')} AS pk_sensor_event_id,
       strftime(ts, {TS}) AS event_ts, strftime(ts, '%Y-%m-%d') AS event_date, device_id,
       CASE WHEN ts >= {CUTOFF} THEN temperature + 1.0 ELSE temperature END AS temperature,
       CAST(1 AS BIGINT) AS rnk
FROM r"""
    q["gold_slice_replace"] = f"""WITH {BASE},
s AS (SELECT device_id, ts,
             CASE WHEN ts >= {CUTOFF} THEN temperature + 1.0 ELSE temperature END AS temperature
      FROM r)
SELECT {key('device_id', f'strftime({h}, {TS})')} AS pk_sensor_device_hour_id, device_id,
       strftime({h}, {HOUR}) AS hour_ts, {r4('avg(temperature)')} AS avg_temperature,
       min(temperature) AS min_temperature, max(temperature) AS max_temperature
FROM s GROUP BY device_id, {h}"""
    q["check_unique_not_null"] = _silver_alerts_ctes() + "\n" + _check_rows()
    q["bronze_roundtrip"] = f"""WITH {BASE}
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time, device_id, {MEAS}, occupancy,
       t AS eventTimeMillis, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hour
FROM r"""
    q["gold_from_bronze"] = f"""WITH {BASE},
d AS (SELECT * REPLACE (temperature + 0.5 AS temperature) FROM r)
SELECT {key('device_id', f'strftime({h}, {TS})')} AS pk_sensor_device_hour_id, device_id, strftime({h}, {HOUR}) AS hour_ts,
       {r4('avg(temperature)')} AS avg_temperature, min(temperature) AS min_temperature, max(temperature) AS max_temperature,
       {r4('avg(humidity)')} AS avg_humidity, {r4('avg(CAST(occupancy AS DOUBLE))')} AS occupancy_rate
FROM d GROUP BY device_id, {h}"""
    q["check_planted_failures"] = f"""WITH {BASE},
p AS (SELECT count(*) FILTER (WHERE t % 97 = 0 AND t % 101 <> 0) AS u,
             count(*) FILTER (WHERE t % 101 = 0) + count(*) FILTER (WHERE t % 97 = 0 AND t % 101 = 0) AS n
      FROM r WHERE ts >= TIMESTAMP '2024-01-20')
SELECT how, check_name, CAST(CASE WHEN check_name = 'unique' THEN u ELSE n END AS BIGINT) AS failures
FROM p, (VALUES ('changed'), ('whole')) a(how), (VALUES ('unique'), ('not_null')) b(check_name)"""
    q["bronze_compacted"] = f"""WITH {BASE}
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time, device_id, temperature,
       strftime(l, '%Y-%m-%d') AS dt, strftime(l, '%H') AS hour
FROM (SELECT *, make_timestamp((t // 21600000) * 21600000000) AS l FROM r)"""
    q["required_fields"] = f"""WITH {BASE}
SELECT {key('device_id', f'strftime(ts, {TS})')} AS pk_sensor_event_id, device_id, strftime(ts, {TS}) AS event_ts, temperature,
       user_id, temperature_warning_threshold
FROM j WHERE t % 13 <> 0 AND t % 17 <> 0 AND t % 19 <> 0 AND NOT ends_with(device_id, '3')"""
    q["malformed_messages"] = f"""WITH {BASE},
k AS (SELECT *, event_id % 10 AS kind FROM r)
SELECT event_id, kind IN (0, 1, 2, 5, 6) AS corrupt,
       CAST(CASE WHEN kind NOT IN (0, 1, 2, 5, 6) THEN t - CASE WHEN kind = 3 THEN 3600000 ELSE 0 END ELSE -1 END AS BIGINT) AS event_time_ms,
       CASE WHEN kind NOT IN (0, 1, 2, 5, 6) THEN temperature ELSE -1.0 END AS temperature
FROM k"""
    q["silver_upsert_inserts"] = f"""WITH {BASE}
SELECT {key('device_id', f'strftime(ts, {TS})')} AS pk_sensor_event_id, strftime(ts, {TS}) AS event_ts,
       CASE WHEN ts >= {CUTOFF} AND t % 3 <> 1 THEN temperature + 1.0 ELSE temperature END AS temperature
FROM r WHERE t % 3 <> 0 OR ts >= {CUTOFF}"""
    q["gold_slice_emptied"] = f"""WITH {BASE},
g AS (SELECT DISTINCT device_id, {h} AS hour_ts FROM r WHERE ts < TIMESTAMP '2024-01-16')
SELECT strftime(hour_ts, '%Y-%m-%d') AS day, count(*) AS device_hours FROM g GROUP BY 1
UNION ALL SELECT 'left until ' || strftime(max(hour_ts) - INTERVAL 1 HOUR, {HOUR}), 0 FROM g
UNION ALL SELECT 'empty until 2009-12-31 23:00:00', 0"""
    q["custom_rule_alerts"] = _alerts_ctes(rules=(*RULES, OWN_RULE)) + f"\nSELECT {ALERT_COLS} FROM alerts"
    q["lakehouse_run"] = _alerts_ctes() + f""",
hours AS (SELECT DISTINCT device_id, {h} AS hour_ts FROM r),
al AS (SELECT *, date_trunc('hour', make_timestamp(window_end_ms * 1000)) AS hour_ts FROM alerts),
rows AS (
  SELECT 'silver_readings' AS name, count(*) AS n, sum(t) AS total FROM r
  UNION ALL SELECT 'silver_alerts', count(*), sum(window_end_ms) FROM alerts
  UNION ALL SELECT 'gold_metrics', count(*), sum(epoch_us(hour_ts) // 1000000) FROM hours
  UNION ALL SELECT 'gold_occupancy', count(*), sum(epoch_us(hour_ts) // 1000000) FROM hours
  UNION ALL SELECT 'gold_breaches', count(*), sum(b)
            FROM (SELECT count(*) AS b FROM al GROUP BY device_id, hour_ts, severity, rule)
  UNION ALL SELECT 'sink_messages', count(*), sum(window_start_ms) FROM alerts
  UNION ALL SELECT 'sink_rows', count(*), sum(window_start_ms) FROM alerts)
SELECT name, CAST(n AS BIGINT) AS n, CAST(total AS BIGINT) AS total FROM rows"""
    q["stream_state_audit"] = _alerts_ctes() + f""",
d AS (SELECT device_id, max(t) AS last_reading_ms FROM j GROUP BY device_id),
x AS (SELECT device_id, rule, max(window_end_ms) AS last FROM alerts GROUP BY device_id, rule)
SELECT d.device_id, v.rule, last_reading_ms, coalesce(x.last, 0)::BIGINT AS last_alert_ms
FROM d CROSS JOIN (VALUES {", ".join(f"('{r[0]}')" for r in RULES)}) v(rule)
LEFT JOIN x ON x.device_id = d.device_id AND x.rule = v.rule"""
    q["stream_silver"] = q["silver_readings"]
    q["stream_late_readings"] = f"""WITH {BASE},
b AS (SELECT min(t) AS lo, max(t) AS hi FROM r),
d AS (SELECT r.*, least(CAST(floor((t - lo) * 4 / (hi - lo + 1)) AS INTEGER) + CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END, 3) AS batch
      FROM r, b),
m AS (SELECT batch, max(max(t)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 30000 AS mark
      FROM d GROUP BY batch)
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time, device_id, temperature, mark AS watermark_ms, d.batch
FROM d JOIN m ON d.batch = m.batch WHERE t < mark"""
    q["bronze_since"] = f"""WITH {BASE},
l AS (SELECT *, make_timestamp((t // 21600000) * 21600000000 + CASE WHEN t % 50 = 0 THEN 172800000000 ELSE 0 END) AS landed
      FROM r)
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time, device_id, {MEAS}, occupancy,
       strftime(landed, '%Y-%m-%d') AS dt, strftime(landed, '%H') AS hour
FROM l WHERE ts >= {CUTOFF}"""
    q["stream_alerts"] = q["threshold_alerts"]
    q["stream_alerts_split"] = q["threshold_alerts"]
    roll = []
    for m in ["temperature", "humidity", "light", "co2"]:
        roll += [f"{r4(f'avg({m})')} AS avg_{m}", f"min({m}) AS min_{m}", f"max({m}) AS max_{m}"]
    q["stream_hourly_rollup"] = f"""WITH {BASE},
wm AS (SELECT max(ts) - INTERVAL 30 SECOND AS w FROM r)
SELECT device_id, strftime({h}, {HOUR}) AS hour_ts, {', '.join(roll)},
       {r4('avg(humidity_ratio)')} AS avg_humidity_ratio,
       {r4('avg(CAST(occupancy AS DOUBLE))')} AS occupancy_rate, count(*) AS readings
FROM r, wm WHERE {h} + INTERVAL 1 HOUR <= wm.w
GROUP BY device_id, {h}"""
    return q
