"""Property: the detector equals the sequential rule on arbitrary small
inputs -- equal timestamps, a reading at epoch 0, several devices, any
partition count, durations and cooldowns including 0."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from brute import brute_alerts
from roomlake.operators.breaches import detect_breaches
from roomlake.operators.config import join_config, latest_config
from roomlake.settings import DEFAULT_RULES, with_timing
from test_alert_traces import frames

CFGS = [{"user_id": f"u{d}", "device_id": f"d{d}", "temperature_warning_threshold": 25.0,
         "temperature_violation_threshold": 27.0, "no_occupancy_light_threshold": 40.0}
        for d in range(3)]

reading = st.fixed_dictionaries({
    "device_id": st.sampled_from(["d0", "d0", "d0", "d1", "d2", "dx"]),
    "t": st.integers(0, 40) .map(lambda k: k * 30_000),
    "temperature": st.sampled_from([20.0, 26.0, 28.0]),
    "humidity": st.just(30.0), "light": st.sampled_from([0.0, 50.0]),
    "co2": st.just(500.0), "humidity_ratio": st.just(0.004),
    "occupancy": st.sampled_from([0, 1]),
})


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(readings=st.lists(reading, min_size=1, max_size=60),
       parts=st.integers(1, 9),
       dur=st.sampled_from([0, 60, 300]), cd=st.sampled_from([0, 30, 120, 600]),
       gap=st.sampled_from([None, None, 45, 90]))
def test_detector_equals_sequential_rule(spark, readings, parts, dur, cd, gap):
    rules = with_timing(DEFAULT_RULES, dur, cd)
    rd, cf = frames(spark, CFGS, readings)
    out = detect_breaches(join_config(rd, latest_config(cf)), rules, num_partitions=parts,
                          max_gap_s=gap)
    got = sorted((a.user_id, a.device_id, a.rule, a.window_start_ms, a.window_end_ms,
                  a.observed_value, a.threshold_value) for a in out.collect())
    ordered = sorted(enumerate(readings), key=lambda p: (p[1]["device_id"], p[1]["t"], p[0]))
    events = [("config", c) for c in CFGS] + [("reading", r) for _, r in ordered]
    assert got == brute_alerts(events, rules, None if gap is None else gap * 1000)
