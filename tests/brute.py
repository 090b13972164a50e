"""Literal, sequential reading of the alert rule, for tests only.

Rows are processed one at a time in the given order with the per-(key, rule)
state (start, last) exactly as the rule describes it.
"""

DEFAULT_CONDS = {
    "NO_OCC_LIGHT": lambda r, c: r["occupancy"] == 0 and r["light"] > c["no_occupancy_light_threshold"],
    "TEMP_WARNING": lambda r, c: r["temperature"] > c["temperature_warning_threshold"],
    "TEMP_VIOLATION": lambda r, c: r["temperature"] > c["temperature_violation_threshold"],
}
OBS = {"NO_OCC_LIGHT": ("light", "no_occupancy_light_threshold"),
       "TEMP_WARNING": ("temperature", "temperature_warning_threshold"),
       "TEMP_VIOLATION": ("temperature", "temperature_violation_threshold")}


def brute_alerts(events, rules, max_gap_ms=None):
    """events: ordered list of ("config", cfg) / ("reading", r) items.

    Configs are kept per device, last one wins.  Returns alert tuples
    (user_id, device_id, rule, window_start_ms, window_end_ms, observed, threshold).
    """
    cfg_by_dev = {}
    state = {}
    last_t = {}
    out = []
    for kind, item in events:
        if kind == "config":
            cfg_by_dev[item["device_id"]] = item
            continue
        r = item
        cfg = cfg_by_dev.get(r["device_id"])
        if cfg is None:
            continue
        t = r["t"]
        prev = last_t.get(r["device_id"])
        last_t[r["device_id"]] = t
        silence = max_gap_ms is not None and prev is not None and t - prev > max_gap_ms
        for rule in rules:
            cond = DEFAULT_CONDS[rule.name](r, cfg)
            st = state.setdefault((r["device_id"], rule.name), {"start": None, "last": 0})
            if silence:
                st["start"] = None
            if cond:
                if st["start"] is None or st["start"] == 0:
                    st["start"] = t
                    continue
                if t - st["start"] >= rule.duration_ms and t - st["last"] >= rule.cooldown_ms:
                    o, h = OBS[rule.name]
                    out.append((cfg["user_id"], r["device_id"], rule.name, st["start"], t,
                                float(r[o]), float(cfg[h])))
                    st["last"] = t
            else:
                st["start"] = None
    return sorted(out)
