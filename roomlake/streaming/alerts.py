"""JOB-2 / JOIN-2 / STR-2..6, STR-9: the live alerting job.

Readings and threshold configs are unioned into one stream keyed by
device_id (one hash shuffle, STR-2) and folded by ``applyInPandasWithState``,
a bucket of devices a call.  Per device the state holds the latest config and, per rule, the episode
start and the last alert time -- O(rules) scalars, whatever the history.

Inside a micro-batch a device's rows are handled as: configs first (newest
``updated`` wins, so an old config arriving late cannot override a newer
one), then readings in event-time order.  Across micro-batches rows are
taken in arrival order, as the source does.  Readings of a device with no
config are dropped and leave the state untouched (FLT-7).  No watermark is
used before the fold, so no reading is ever dropped as late (STR-1).

State lives in the query's checkpoint (``checkpointLocation``), so a
restart resumes episodes and cooldowns (STR-9).  ``alert_time`` is the
micro-batch timestamp (``current_timestamp()``, which Spark replays unchanged
when a batch is retried) plus the alert's rank within its rule in
microseconds, so a repeated delivery carries the same silver key while two
alerts of one batch never share one.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomlake.functions.columns import epoch_millis, iso_instant
from roomlake.operators.breaches import candidates, emit_chain
from roomlake.schemas import ALERT_MESSAGE
from roomlake.settings import DEFAULT_RULES, DEFAULT_THRESHOLDS, MEASURES


#: Devices share state rows and Python calls by a hash of their id.  A call costs milliseconds whatever it holds, so their
#: number must not follow that of the devices; a micro-batch rewrites the rows whose devices it touches, so they stay small.
#: The number belongs to a checkpoint: a query that resumes one must use the same.
STATE_BUCKETS = 16384

STATE_SCHEMA = T.StructType([
    T.StructField("device_id", T.ArrayType(T.StringType())),
    T.StructField("user_id", T.ArrayType(T.StringType())),
    T.StructField("nums", T.ArrayType(T.DoubleType())),           # device after device, as ``state_fields`` names them
])


def state_fields(n_rules: int, thresholds=()) -> list[str]:
    """A device's numbers in the state; NaN stands for none."""
    return ["t_last", *[f"s{i}" for i in range(n_rules)], *[f"x{i}" for i in range(n_rules)],
            "updated_ms", "seq", *thresholds]


# Layout of the packed numeric column fed to the fold.  One array column
# instead of fourteen scalar ones halves PySpark's per-group Arrow -> pandas
# cost; every integer here stays below 2**53, so doubles hold it exactly.
def _packed(thresholds) -> list[str]:
    return ["t", "tie", "updated_ms", "seq", "batch_ms", *MEASURES, *thresholds]


def _pack(values: dict, thresholds) -> "F.Column":
    return F.array(*[values.get(name, F.lit(None)).cast("double") for name in _packed(thresholds)])


def union_inputs(readings: DataFrame, configs: DataFrame, thresholds=DEFAULT_THRESHOLDS) -> DataFrame:
    """Typed reading rows (event_time string or t) and config rows -> one
    stream of (device_id, user_id, nums); a NULL event time marks a config."""
    ts = F.col("event_ts") if "event_ts" in readings.columns else iso_instant("event_time")
    t = F.col("t") if "t" in readings.columns else epoch_millis(ts)
    batch = epoch_millis(F.current_timestamp())
    r = readings.where(t.isNotNull()).select(
        F.col("device_id"), F.lit(None).cast("string").alias("user_id"),
        _pack({"t": t, "tie": F.unix_micros(ts),      # equal ms: finer event time first
               "batch_ms": batch, **{c: F.col(c) for c in MEASURES}}, thresholds).alias("nums"))
    upd = (F.col("updated_ms") if "updated_ms" in configs.columns
           else epoch_millis(iso_instant("updated_at")))
    c = configs.select(
        F.col("device_id"), F.col("user_id").cast("string").alias("user_id"),
        _pack({"updated_ms": upd, "batch_ms": batch,
               **({"seq": F.col("seq")} if "seq" in configs.columns else {}),
               **{k: F.col(k) for k in thresholds}}, thresholds).alias("nums"))
    return r.unionByName(c).where(F.col("device_id").isNotNull())


def _lowest(v: np.ndarray) -> np.ndarray:
    """NULL (NaN) sorts lowest."""
    return np.where(np.isnan(v), -np.inf, v)


def _newest(devices: np.ndarray, users: np.ndarray, m: np.ndarray):
    """The newest config of each device by (updated, seq, user); ``m`` holds updated, seq and the thresholds."""
    codes, _ = pd.factorize(devices)
    order = np.lexsort((users.astype(str), _lowest(m[:, 1]), _lowest(m[:, 0]), codes))
    last = order[np.append(codes[order][1:] != codes[order][:-1], True)]
    return devices[last], users[last], m[last]


def _alert_times(end_ms: np.ndarray, batch_ms: np.ndarray, rank: np.ndarray, mode: str):
    """ISO alert times.  ``event``: the trigger reading's time (ms).  ``batch``:
    the micro-batch timestamp plus the alert's rank within its rule in
    microseconds, so the alerts of one rule in one batch keep distinct silver
    keys, and a replayed batch reproduces them exactly."""
    if mode == "event":
        return np.char.add(np.datetime_as_string(end_ms.astype("datetime64[ms]"), unit="ms"), "Z")
    us = batch_ms.astype(np.int64) * 1000 + rank
    return np.char.add(np.datetime_as_string(us.astype("datetime64[us]"), unit="us"), "Z")


def _fold(rules, alert_time_from: str, null_as_zero: bool = True, max_gap=None,
          thresholds=DEFAULT_THRESHOLDS):
    n = len(rules)
    packed = _packed(thresholds)
    place = {name: i for i, name in enumerate(packed)}
    of_config = [place["updated_ms"], place["seq"], *[place[k] for k in thresholds]]
    fields = state_fields(n, thresholds)
    at_config = fields.index("updated_ms")
    out_cols = [f.name for f in ALERT_MESSAGE.fields]
    names = np.array([r.name for r in rules], dtype=object)
    sevs = np.array([r.severity for r in rules], dtype=object)
    mets = np.array([r.metric for r in rules], dtype=object)
    fresh = np.array([0.0 if f.startswith("x") else np.nan for f in fields])

    def load(state):
        if not state.exists:
            return np.zeros(0, object), np.zeros(0, object), np.zeros((0, len(fields)))
        devices, users, nums = state.get
        return (np.array(devices, dtype=object), np.array(users, dtype=object),
                np.array(nums, dtype=np.float64).reshape(-1, len(fields)))

    def configure(devices, users, st, new):
        """The state once the newest configs of a micro-batch are in."""
        new_dev, new_users, m = new
        at = pd.Index(devices).get_indexer(new_dev)
        known = at >= 0
        old = st[at[known]]
        upd, seq = _lowest(m[known, 0]), _lowest(m[known, 1])
        upd0, seq0 = _lowest(old[:, at_config]), _lowest(old[:, at_config + 1])
        takes = (upd > upd0) | ((upd == upd0) & (seq >= seq0))     # an old config arriving late does not win
        rows = at[known][takes]
        st[rows, at_config:] = m[known][takes]
        users[rows] = new_users[known][takes]
        added = np.tile(fresh, (int((~known).sum()), 1))
        added[:, at_config:] = m[~known]
        return (np.concatenate([devices, new_dev[~known]]), np.concatenate([users, new_users[~known]]),
                np.concatenate([st, added]))

    def replay(devices, users, st, at, m):
        """Fold the readings ``m`` of the devices ``at`` into ``st``; their alerts, None if there are none."""
        t_raw = m[:, place["t"]].astype(np.int64)
        order = np.lexsort((m[:, place["tie"]], t_raw, at))
        m, t, at = m[order], t_raw[order], at[order]
        cols = {c: m[:, place[c]] for c in MEASURES}
        if null_as_zero:       # absent numeric fields read as 0, as typed messages do
            cols = {c: np.nan_to_num(v, nan=0.0) for c, v in cols.items()}
        cols.update({k: st[at, fields.index(k)] for k in thresholds})
        masks = [r.condition.mask(cols) for r in rules]
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        sel_all, rule_all, rank_all, start_all = [], [], [], []
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(at)]):       # a device's readings
            own, times = st[at[a]], t[a:b]
            t_last = None if np.isnan(own[0]) else int(own[0])
            for i, r in enumerate(rules):
                s_in = None if np.isnan(own[1 + i]) else int(own[1 + i])
                idx, start, s_out = candidates(times, masks[i][a:b].copy(), s_in, r.duration_ms, t_last, max_gap)
                em, x_out = emit_chain(times[idx].tolist(), int(own[1 + n + i]), r.cooldown_ms)
                own[1 + i] = np.nan if s_out is None else s_out
                own[1 + n + i] = x_out
                if em:
                    sel = idx[np.asarray(em, dtype=np.int64)]
                    sel_all.append(a + sel)
                    rule_all.append(np.full(len(sel), i))
                    rank_all.append(np.arange(len(sel), dtype=np.int64))
                    start_all.append(start[sel])
            own[0] = times[-1]
        if not sel_all:
            return None
        sel, ri = np.concatenate(sel_all), np.concatenate(rule_all)
        batch_ms = m[sel, place["batch_ms"]].astype(np.int64)
        observed, limit = np.zeros(len(sel)), np.zeros(len(sel))
        for i, r in enumerate(rules):
            of_rule = ri == i
            observed[of_rule], limit[of_rule] = cols[r.observed][sel[of_rule]], cols[r.threshold][sel[of_rule]]
        return pd.DataFrame({
            "alert_time": _alert_times(t[sel], batch_ms, np.concatenate(rank_all), alert_time_from),
            "user_id": users[at[sel]], "device_id": devices[at[sel]],
            "rule": names[ri], "severity": sevs[ri], "metric": mets[ri],
            "observed_value": observed, "threshold_value": limit,
            "window_start_ms": np.concatenate(start_all).astype(np.int64),
            "window_end_ms": t[sel]})[out_cols]

    def fn(key, pdfs: Iterator[pd.DataFrame], state):
        devices, users, st = load(state)
        new, readings = None, []
        for pdf in pdfs:
            m = np.concatenate(pdf["nums"].to_numpy()).reshape(-1, len(packed)).astype(np.float64)
            dev = pdf["device_id"].to_numpy()
            is_cfg = np.isnan(m[:, place["t"]])
            if is_cfg.any():           # reduced at once, so a long config history is never held
                found = dev[is_cfg], pdf["user_id"].to_numpy()[is_cfg], m[is_cfg][:, of_config]
                new = _newest(*(found if new is None else [np.concatenate(x) for x in zip(new, found)]))
            if not is_cfg.all():
                readings.append((dev[~is_cfg], m[~is_cfg]))
        if new is not None:
            devices, users, st = configure(devices, users, st, new)
        result, read = None, False
        if readings:
            at = pd.Index(devices).get_indexer(np.concatenate([d for d, _ in readings]))
            m = np.concatenate([m for _, m in readings])
            has_cfg = at >= 0           # readings of unknown devices leave no state behind
            read = bool(has_cfg.any())
            if read:
                result = replay(devices, users, st, at[has_cfg], m[has_cfg])
        if new is not None or read:
            state.update((devices.tolist(), users.tolist(), st.ravel().tolist()))
        if result is not None:
            yield result
    return fn


def stream_alerts(union: DataFrame, rules=DEFAULT_RULES, alert_time_from: str = "batch",
                  null_as_zero: bool = True, max_gap_s: int | None = None,
                  thresholds=DEFAULT_THRESHOLDS, buckets: int = STATE_BUCKETS) -> DataFrame:
    """Streaming alerts (ALERT_MESSAGE schema) from ``union_inputs`` rows (of the same ``thresholds``).

    ``null_as_zero=False`` lets a missing measure make its conditions false
    (NULL comparisons) instead of reading it as 0.  ``max_gap_s`` (off by
    default) ends an episode after a longer silence between two readings
    (in processing order).  ``buckets`` is the number of state rows that devices share.
    """
    rules = tuple(rules)
    unknown = set().union(*(r.columns for r in rules)) - set(MEASURES) - set(thresholds)
    if unknown:
        raise ValueError(f"rules use columns that neither readings nor configs have: {sorted(unknown)}")
    gap = None if max_gap_s is None else int(max_gap_s) * 1000
    return (union.withColumn("bucket", F.pmod(F.xxhash64("device_id"), F.lit(int(buckets)))).groupBy("bucket")
                 .applyInPandasWithState(_fold(rules, alert_time_from, null_as_zero, gap, thresholds),
                                         ALERT_MESSAGE, STATE_SCHEMA, "append", "NoTimeout"))
