"""Golden traces of the alert rule (hand-computed, see FIXTURES.md section 3).

Each trace: readings (offset seconds, fields), configs, and expected alerts
(rule, end offset, start offset) in event-time (batch) order.
"""

T0 = 1_700_000_000_000  # a real date, epoch ms

CFG = {"user_id": "user_001", "device_id": "dev_123", "temperature_warning_threshold": 28.0,
       "temperature_violation_threshold": 30.0, "no_occupancy_light_threshold": 40.0}


def reading(off_s, temp=20.0, occ=1, light=0.0, base=T0, device="dev_123"):
    return {"device_id": device, "t": base + off_s * 1000, "temperature": float(temp),
            "humidity": 30.0, "light": float(light), "co2": 500.0, "humidity_ratio": 0.004,
            "occupancy": occ}


def every(start, end, step=60, **kw):
    return [reading(s, **kw) for s in range(start, end + 1, step)]


def _t5():
    rs = every(0, 1860, temp=29)
    for r in rs:
        if r["t"] == T0 + 600_000:
            r["temperature"] = 27.0
    return rs


def _t8():
    rs = every(0, 900, occ=0, light=41)
    for r in rs:
        if r["t"] == T0 + 360_000:
            r["light"] = 0.0
    return rs


def _t11():
    return [reading(s, temp=31, base=0) for s in range(0, 661, 60)]


TRACES = {
    1: ([], every(0, 3600, temp=35), []),
    2: ([CFG], every(0, 1200, temp=29), [("TEMP_WARNING", 1200, 0)]),
    3: ([CFG], every(0, 1800, temp=29), [("TEMP_WARNING", 1200, 0), ("TEMP_WARNING", 1800, 0)]),
    4: ([CFG], every(0, 3600, temp=28), []),
    5: ([CFG], _t5(), [("TEMP_WARNING", 1860, 660)]),
    6: ([CFG], every(0, 1800, temp=31),
        [("TEMP_VIOLATION", 600, 0), ("TEMP_VIOLATION", 1200, 0), ("TEMP_VIOLATION", 1800, 0),
         ("TEMP_WARNING", 1200, 0), ("TEMP_WARNING", 1800, 0)]),
    7: ([CFG], every(0, 900, occ=0, light=41),
        [("NO_OCC_LIGHT", 300, 0), ("NO_OCC_LIGHT", 900, 0)]),
    8: ([CFG], _t8(), [("NO_OCC_LIGHT", 300, 0), ("NO_OCC_LIGHT", 900, 420)]),
    9: ([CFG], [reading(600, temp=31), reading(0, temp=31), reading(1200, temp=31)],
        [("TEMP_VIOLATION", 600, 0), ("TEMP_VIOLATION", 1200, 0), ("TEMP_WARNING", 1200, 0)]),
    11: ([CFG], _t11(), [("TEMP_VIOLATION", 660, 60)]),
    12: ([CFG, {**CFG, "user_id": "user_002", "temperature_warning_threshold": 26.0,
                "temperature_violation_threshold": 28.0, "no_occupancy_light_threshold": 30.0}],
         every(0, 1200, temp=27), [("TEMP_WARNING", 1200, 0)]),
    13: ([CFG], [reading(0, temp=31), reading(3600, temp=31)],
         [("TEMP_VIOLATION", 3600, 0), ("TEMP_WARNING", 3600, 0)]),
}
