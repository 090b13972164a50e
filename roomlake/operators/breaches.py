"""Sustained-breach detection with cooldown (FLT-3..5, STR-4..6) in batch.

Semantics, per key (device, or user and device) and rule, rows in event
order (t, then tie-break):

* a true row with no episode open opens one at its time (a start of 0 counts
  as "no episode"), and never alerts itself;
* a later true row alerts when ``t - start >= duration`` and
  ``t - last_alert >= cooldown`` (``last_alert`` starts at 0, the epoch);
* a false (or NULL) row closes the episode; ``last_alert`` survives;
* optionally (``max_gap_s``, off by default) a silence longer than that
  between two readings closes it too.

Plan
----
The fold is sequential per key, and one key may hold a large share of all
rows, so the work is never grouped by key.  Instead:

1. one range shuffle on (key, t, tie): Spark samples the sort key, so a hot
   key is cut into several contiguous, similarly sized partitions; the
   result is checkpointed to the shared checkpoint folder so every pass sees
   the same partitions and a lost executor does not re-sample;
2. pass A (``mapInPandas``): per partition, the key of the first and last
   run and how the episode start leaves the partition, as a function of how
   it entered -- a few scalars per rule;
3. pass B, only when some key crosses a partition boundary: with the
   episode starts known, the cooldown transfer of each single-key
   partition -- the last alert time as a step function of the incoming one
   (exact: one step per distinct chain end reachable from the first
   cooldown window); the transfers of consecutive partitions of a key are shuffled
   together and composed on the executors, one partition at a time;
4. pass C: every partition replays its rows with the exact incoming state
   and emits the alerts.

Every pass streams its partition's Arrow batches in order and carries the
run in progress across batch boundaries, so a task holds one batch and
O(rules) state, never a whole key or partition.  Between passes the carries
are folded in partition order on the driver: O(rules) numbers per partition,
never data rows or transfers -- the pattern Spark uses itself for ``zipWithIndex``
offsets and range-partition bounds.  Row work is vectorised numpy; Python
loops run once per run segment (a key's rows in one batch) and rule, once
per emitted alert, and -- only for a partition that continues a key -- once
per candidate of its first cooldown window.
"""

from __future__ import annotations

import bisect
import logging
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomlake.functions.columns import iso_utc_string
from roomlake.schemas import ALERT_MESSAGE
from roomlake.session import ensure_checkpoint_dir
from roomlake.settings import DEFAULT_RULES, RuleSpec

KEY_SEP = "\x1f"
INT64_MAX = np.iinfo(np.int64).max
NULL_AS_ZERO = ["temperature", "humidity", "light", "co2", "humidity_ratio", "occupancy"]

# Target rows per range partition when the planner knows the row count;
# otherwise spark.sql.shuffle.partitions (or num_partitions) decides.  Memory
# does not depend on it: partitions are streamed batch by batch.
DEFAULT_ROWS_PER_PARTITION = 2_000_000
DEFAULT_SOURCE_BYTES_PER_PARTITION = 128 * 1024 * 1024


# --------------------------------------------------------------------------
# Spark side: build the per-rule columns, shuffle once, checkpoint
# --------------------------------------------------------------------------

def rule_columns(joined: DataFrame, rules=DEFAULT_RULES, null_as_zero: bool = True,
                 key_cols=("user_id", "device_id"), t_col: str = "t",
                 tie_cols=("event_id",)) -> DataFrame:
    """Readings joined with thresholds -> one row per reading with, per rule i,
    ``c{i}`` (condition, NULL as false), ``o{i}`` observed, ``h{i}`` threshold.

    Absent numeric fields count as 0 by default, as in the source's typed
    messages, so a missing occupancy reads as "unoccupied".
    """
    # a reading without event time or device cannot be placed in a sequence
    df = joined.where(F.col(t_col).isNotNull() & F.col("device_id").isNotNull())
    if null_as_zero:
        df = df.fillna(0, subset=[c for c in NULL_AS_ZERO if c in df.columns])
    ties = [c for c in tie_cols if c in df.columns]
    key = F.concat_ws(KEY_SEP, *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key_cols])
    names = dict.fromkeys((*key_cols, "user_id", "device_id"))      # the alert names both, keys or not
    cols = [key.alias("_k"), *[F.col(k) for k in names],
            F.col(t_col).cast("long").alias("t"), *[F.col(c) for c in ties]]
    for i, r in enumerate(rules):
        cols += [r.condition.column().alias(f"c{i}"),
                 F.col(r.observed).cast("double").alias(f"o{i}"),
                 F.col(r.threshold).cast("double").alias(f"h{i}")]
    return df.select(*cols), ties


def _big(v) -> int:
    """A Scala BigInt from py4j (already an int, or an object with toString)."""
    return v if isinstance(v, int) else int(v.toString())


def spark_default_size(spark) -> int:
    """The size Spark assumes of a relation it knows nothing about."""
    return int(spark.conf.get("spark.sql.defaultSizeInBytes", str(INT64_MAX)).rstrip("bB"))


def _estimate_partitions(df: DataFrame, rows_per_partition: int,
                         source_bytes_per_partition: int = DEFAULT_SOURCE_BYTES_PER_PARTITION) -> int:
    """Range partitions for the staging shuffle: enough that each holds about
    ``source_bytes_per_partition`` of the largest input relation (the
    readings), never fewer than ``spark.sql.shuffle.partitions``.  The join's
    own size estimate is useless here (without CBO Spark multiplies child
    sizes), so the leaves are used; a known row count refines it."""
    spark = df.sparkSession
    base = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    want = base
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        leaves = plan.collectLeaves()
        sizes = [_big(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
        known = [x for x in sizes if x < spark_default_size(spark)]     # a leaf without statistics counts as that
        if known:
            want = max(want, math.ceil(max(known) / source_bytes_per_partition))
        rows = plan.stats().rowCount()
        if rows.isDefined():
            want = max(want, math.ceil(_big(rows.get()) / rows_per_partition))
    except Exception as e:  # a remote session has no plan handle: the caller's num_partitions decides there
        logging.getLogger(__name__).warning(
            "no plan statistics (%s): staging into %d partitions; pass num_partitions for large inputs", e, want)
    return want


# --------------------------------------------------------------------------
# numpy kernels (one run = one key's rows inside one partition, sorted)
# --------------------------------------------------------------------------

def gaps(t: np.ndarray, t_prev, max_gap) -> np.ndarray | None:
    """Rows that follow more than ``max_gap`` ms of silence (None: feature off)."""
    if max_gap is None:
        return None
    g = np.empty(len(t), dtype=bool)
    g[0] = t_prev is not None and int(t[0]) - int(t_prev) > max_gap
    g[1:] = (t[1:] - t[:-1]) > max_gap
    return g


def seen_starts(t: np.ndarray, cond: np.ndarray, s_in, t_prev=None, max_gap=None):
    """Episode start each row sees before it is processed (-1 = none) and
    the start left behind after the run (None = no episode).

    ``s_in`` is the start entering the run (None or 0 = no episode).  With
    ``max_gap`` (ms), a row after a longer silence since the previous reading
    (``t_prev`` for the first row) closes the episode as a false row would.
    """
    n = len(t)
    head = ~cond
    g = gaps(t, t_prev, max_gap)
    if g is not None:
        head = head | g
    head[0] = True
    island = np.cumsum(head) - 1
    marker = cond & (t != 0)
    idx = np.arange(n)
    first = np.full(island[-1] + 1, n, dtype=np.int64)
    isl_m, idx_m = island[marker], idx[marker]
    if len(isl_m):
        new = np.empty(len(isl_m), dtype=bool)
        new[0] = True
        new[1:] = isl_m[1:] != isl_m[:-1]
        first[isl_m[new]] = idx_m[new]   # first marker of each island
    fm = first[island]
    valid = fm < idx
    start = np.where(valid, t[np.minimum(fm, n - 1)], -1)
    inherit = s_in is not None and s_in != 0 and bool(cond[0]) and not (g is not None and g[0])
    if inherit:
        in0 = island == 0
        start = np.where(in0, s_in, start)
        valid = valid | in0
    # state after the run
    if not cond[-1]:
        s_out = None
    elif inherit and island[-1] == 0:
        s_out = s_in
    else:
        f = first[island[-1]]
        s_out = int(t[f]) if f < n else None
    return start, valid, s_out


def candidates(t, cond, s_in, dur, t_prev=None, max_gap=None):
    start, valid, s_out = seen_starts(t, cond, s_in, t_prev, max_gap)
    cand = cond & valid & ((t - start) >= dur)
    return np.flatnonzero(cand), start, s_out


def emit_chain(ct: list, x_in: int, cd: int):
    """Indices (into ct) of emitted candidates and the last alert time after."""
    m = len(ct)
    if m == 0:
        return [], x_in
    if cd <= 0:
        # after the first alert every later candidate passes; the first one
        # must still clear x_in (a late, older reading may not)
        j = bisect.bisect_left(ct, x_in + cd)
        return list(range(j, m)), (ct[-1] if j < m else x_in)
    out = []
    x = x_in
    j = bisect.bisect_left(ct, x + cd)
    while j < m:
        out.append(j)
        x = ct[j]
        j = bisect.bisect_left(ct, x + cd, j + 1)
    return out, x


class ChainTransfer:
    """Incremental cooldown transfer of one run entered with any x_in <= t_first.

    Candidate times are fed in order, in chunks.  Every candidate in the first
    cooldown window after ``t_first`` (and the first one beyond it) can be the
    first alert, depending on x_in; each such entry starts a chain.  No chain
    can alert again inside that window, so its candidates are only appended; from the first one
    beyond it on, all chains advance together by sorted jumps, and chains that alert on the
    same candidate merge for good.  ``result()`` gives (thresholds, ends): x_out = ends[j]
    for the first j with thresholds[j] >= x_in + cooldown, else x_in.
    """

    def __init__(self, t_first: int, cd: int):
        self.t_first, self.cd = int(t_first), int(cd)
        self.entries = [np.zeros(0, np.int64)]   # entry candidates, in order
        self.last = None                         # each entry's last alert, once the window is over
        self.last_seen = None

    def feed(self, ct) -> None:
        ct = np.asarray(ct, dtype=np.int64)
        if not len(ct):
            return
        self.last_seen = int(ct[-1])
        if self.cd <= 0:
            return
        if self.last is None:
            beyond = int(np.searchsorted(ct, self.t_first + self.cd))
            self.entries.append(ct[:beyond + 1])
            if beyond == len(ct):
                return
            self.entries = [np.concatenate(self.entries)]
            self.last = self.entries[0].copy()
            # the candidate beyond the window is an entry and may be a chain's next alert too
            self.last[self.last <= ct[beyond] - self.cd] = ct[beyond]
            ct = ct[beyond + 1:]
        chains, of = np.unique(self.last, return_inverse=True)
        while len(ct):
            nxt = np.searchsorted(ct, chains + self.cd)
            fires = nxt < len(ct)
            if not fires.any():
                break
            chains = np.where(fires, ct[np.minimum(nxt, len(ct) - 1)], chains)
            chains, merged = np.unique(chains, return_inverse=True)
            of = merged[of]
        self.last = chains[of]

    def result(self):
        if self.last_seen is None:
            return [], []
        if self.cd <= 0:
            return [int(INT64_MAX)], [int(self.last_seen)]
        thr = np.concatenate(self.entries)
        ends = thr if self.last is None else self.last
        order = np.lexsort((ends, thr))
        thr, ends = thr[order], ends[order]
        keep = np.append(ends[1:] != ends[:-1], True)     # the last threshold of each block
        return thr[keep].tolist(), ends[keep].tolist()


def apply_transfer(thr: list, ends: list, x_in: int, cd: int) -> int:
    if not len(thr):
        return x_in
    j = bisect.bisect_left(thr, x_in + cd) if cd > 0 else 0
    return ends[j] if j < len(thr) else x_in


# --------------------------------------------------------------------------
# the three passes: each streams its partition's Arrow batches in order and
# carries the state of the run in progress across batch boundaries, so a
# task holds one batch, never a whole partition or key
# --------------------------------------------------------------------------

def _segments(batches, n_rules: int):
    """(pid, key, new_partition, new_run, t, conds, frame, lo, hi, head) per run segment.

    The partition id is a column stamped before the checkpoint, not the
    task's index, which changes when the frame is unioned or re-planned.
    ``head`` is the state that a run starts from, if a state row opens it; ``lo`` is past that row, so a
    segment may be empty.
    """
    prev_pid, prev_key = None, None
    for pdf in batches:
        n = len(pdf)
        if not n:
            continue
        pids = pdf["_pid"].to_numpy()
        keys = pdf["_k"].to_numpy()
        t = pdf["t"].to_numpy(dtype=np.int64)
        conds = [pdf[f"c{i}"].to_numpy(dtype=bool) for i in range(n_rules)]
        heads = pdf["_in"].to_numpy() if "_in" in pdf.columns else None
        change = np.empty(n, dtype=bool)
        change[0] = True
        change[1:] = (keys[1:] != keys[:-1]) | (pids[1:] != pids[:-1])
        starts = np.flatnonzero(change)
        ends = np.append(starts[1:], n)
        for lo, hi in zip(starts.tolist(), ends.tolist()):
            pid, key = int(pids[lo]), keys[lo]
            new_part = pid != prev_pid
            new_run = new_part or key != prev_key
            head = None
            if heads is not None and heads[lo] is not None:
                v = [None if x is None or x != x else int(x) for x in heads[lo]]
                head = (v[0], v[1:1 + n_rules], [x or 0 for x in v[1 + n_rules:]])
                lo += 1
            yield pid, key, new_part, new_run, t, conds, pdf, lo, hi, head
            prev_pid, prev_key = pid, key


_SUMMARY_A = T.StructType([
    T.StructField("pid", T.IntegerType()),
    T.StructField("first_k", T.StringType()),
    T.StructField("last_k", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("t_first", T.LongType()),
    T.StructField("t_last", T.LongType()),
    T.StructField("has_false", T.ArrayType(T.BooleanType())),
    T.StructField("fnz", T.ArrayType(T.LongType())),
    T.StructField("s_exit", T.ArrayType(T.LongType())),
])

_SUMMARY_B = T.StructType([
    T.StructField("pid", T.IntegerType()),
    T.StructField("thr", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("ends", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("x_exit", T.ArrayType(T.LongType())),
    T.StructField("chain", T.IntegerType()),
])


def _pass_a(n_rules: int, max_gap=None):
    """Per partition: first / last key and time, and how the episode start
    leaves it: lead-run has_false (a false row or a silence gap) and first
    non-zero true time before it (fnz), and the start after the last run
    entered fresh (s_exit)."""
    def summary(st):
        return {"pid": st["pid"], "first_k": st["first_k"], "last_k": st["last_k"],
                "rows": st["rows"], "t_first": st["t_first"], "t_last": st["t_last"],
                "has_false": list(st["has_false"]), "fnz": list(st["fnz"]),
                "s_exit": list(st["s"])}

    def run(batches):
        out, st = [], None
        for pid, key, new_part, new_run, t, conds, _pdf, lo, hi, head in _segments(batches, n_rules):
            if new_part:
                if st is not None:
                    out.append(summary(st))
                st = {"pid": pid, "first_k": key, "t_first": int(t[lo]) if lo < hi else 0, "lead": True, "rows": 0,
                      "has_false": [False] * n_rules, "open": [True] * n_rules,
                      "fnz": [None] * n_rules, "s": [None] * n_rules, "t_last": None}
            elif new_run:
                st["lead"] = False
                st["s"] = [None] * n_rules
                st["t_last"] = None
            st["last_k"] = key
            st["rows"] += hi - lo
            if head is not None:
                st["t_last"], st["s"] = head[0], list(head[1])
                if st["lead"]:                 # nothing that came before matters
                    st["open"], st["has_false"] = [False] * n_rules, [True] * n_rules
            if lo == hi:
                continue
            tt = t[lo:hi]
            g = gaps(tt, st["t_last"], max_gap)
            for i in range(n_rules):
                c = conds[i][lo:hi]
                if st["lead"] and st["open"][i]:
                    reset = ~c if g is None else (~c | g)
                    f = int(np.argmax(reset)) if reset.any() else len(c)
                    if st["fnz"][i] is None:
                        nz = np.flatnonzero(tt[:f] != 0)
                        if len(nz):
                            st["fnz"][i] = int(tt[nz[0]])
                    if f < len(c):
                        st["open"][i] = False
                        st["has_false"][i] = True
                _, _, st["s"][i] = seen_starts(tt, c.copy(), st["s"][i], st["t_last"], max_gap)
            st["t_last"] = int(tt[-1])
        if st is not None:
            out.append(summary(st))
        if out:
            yield pd.DataFrame(out)
    return run


def _share(spark, carries: dict):
    """Carries go to executors as a broadcast variable (once per executor,
    not inside every task's closure); remote sessions fall back to the
    closure."""
    try:
        return spark.sparkContext.broadcast(carries)
    except Exception:
        return carries


def _lookup(carries, pid: int):
    table = carries.value if hasattr(carries, "value") else carries
    return table.get(pid)


def _pass_b(rules, single_cont, chains, max_gap=None):
    """Per partition: the exit last-alert time of its last run entered fresh,
    and for single-key partitions that continue a key the cooldown transfer
    (entered with the known episode start and previous reading time
    ``single_cont[pid]``)."""
    durs = [r.duration_ms for r in rules]
    cds = [r.cooldown_ms for r in rules]
    n = len(rules)

    def summary(st):
        thr, ends = [], []
        for i in range(n):
            a, b = st["xfer"][i].result() if st["xfer"] else ([], [])
            thr.append(a)
            ends.append(b)
        return {"pid": st["pid"], "thr": thr, "ends": ends, "x_exit": [int(v) for v in st["x"]],
                "chain": _lookup(chains, st["pid"])[0]}

    def run(batches):
        out, st = [], None
        for pid, _key, new_part, new_run, t, conds, _pdf, lo, hi, head in _segments(batches, n):
            if new_part:
                if st is not None:
                    out.append(summary(st))
                entry = _lookup(single_cont, pid)
                st = {"pid": pid, "s": [None] * n, "x": [0] * n, "xs": None, "t_last": None,
                      "xt": None,
                      "xfer": [ChainTransfer(int(t[lo]), cds[i]) for i in range(n)]
                      if entry is not None else None}
                if entry is not None:
                    st["xs"] = list(entry[0])      # start state along the single run
                    st["xt"] = entry[1]            # previous reading time along it
            elif new_run:
                st["s"] = [None] * n
                st["x"] = [0] * n
                st["t_last"] = None
            if head is not None:
                st["t_last"], st["s"], st["x"] = head[0], list(head[1]), list(head[2])
            if lo == hi:
                continue
            tt = t[lo:hi]
            for i in range(n):
                c = conds[i][lo:hi]
                idx, _, st["s"][i] = candidates(tt, c.copy(), st["s"][i], durs[i],
                                                st["t_last"], max_gap)
                _, st["x"][i] = emit_chain(tt[idx].tolist(), st["x"][i], cds[i])
                if st["xfer"] is not None:
                    idx2, _, st["xs"][i] = candidates(tt, c.copy(), st["xs"][i], durs[i],
                                                      st["xt"], max_gap)
                    st["xfer"][i].feed(tt[idx2])
            st["t_last"] = st["xt"] = int(tt[-1])
        if st is not None:
            out.append(summary(st))
        if out:
            yield pd.DataFrame(out)
    return run


_ALERT_ROWS = T.StructType([f for f in ALERT_MESSAGE.fields if f.name != "alert_time"])


#: what a stateful run leaves per device: last reading, episode starts, last alerts
_STATE_ROWS = T.StructType([*_ALERT_ROWS.fields, T.StructField("_state", T.ArrayType(T.LongType()))])


def _pass_c(rules, entry_map, max_gap=None, goes_on=None):
    """Replay every run with its exact entry state and emit the alerts.

    With ``goes_on`` (partitions whose last key goes on in the next one) a key's last run also emits the
    state it leaves, as a row with ``_state`` and no rule.
    """
    durs = [r.duration_ms for r in rules]
    cds = [r.cooldown_ms for r in rules]
    n = len(rules)
    names = np.array([r.name for r in rules], dtype=object)
    sev = np.array([r.severity for r in rules], dtype=object)
    met = np.array([r.metric for r in rules], dtype=object)
    out_cols = (_ALERT_ROWS if goes_on is None else _STATE_ROWS).fieldNames()

    def flush(pdf, t, parts):
        if not parts:
            return None
        ix = np.concatenate([p[0] for p in parts])
        ri = np.concatenate([p[1] for p in parts])
        st = np.concatenate([p[2] for p in parts])
        obs = np.empty(len(ix), dtype=np.float64)
        thr = np.empty(len(ix), dtype=np.float64)
        for i in range(n):
            m = ri == i
            if m.any():
                obs[m] = pdf[f"o{i}"].to_numpy(dtype=np.float64)[ix[m]]
                thr[m] = pdf[f"h{i}"].to_numpy(dtype=np.float64)[ix[m]]
        frame = pd.DataFrame({
            "user_id": pdf["user_id"].to_numpy()[ix],
            "device_id": pdf["device_id"].to_numpy()[ix],
            "rule": names[ri], "severity": sev[ri], "metric": met[ri],
            "observed_value": obs, "threshold_value": thr,
            "window_start_ms": st.astype(np.int64), "window_end_ms": t[ix], "_state": None,
        })
        return frame[out_cols]

    def left_states(ended):
        frame = pd.DataFrame(None, index=range(len(ended)), columns=out_cols, dtype=object)
        frame["device_id"] = [e[0] for e in ended]
        frame["_state"] = pd.Series([[t, *s, *x] for _, t, s, x in ended], dtype=object)
        return frame.where(frame.notna(), None)

    def run(batches):
        s, x, t_last = [None] * n, [0] * n, None
        cur_pdf, cur_t, parts, ended, at, device = None, None, [], [], None, None
        for pid, _key, new_part, new_run, t, conds, pdf, lo, hi, head in _segments(batches, n):
            if goes_on is not None and new_run and at is not None and not (new_part and at in goes_on):
                ended.append((device, t_last, s, [int(v) for v in x]))
            if pdf is not cur_pdf:
                res = flush(cur_pdf, cur_t, parts)
                if res is not None:
                    yield res
                if ended:
                    yield left_states(ended)
                cur_pdf, cur_t, parts, ended = pdf, t, [], []
            if new_run:
                entry = _lookup(entry_map, pid) if new_part else None
                s = list(entry[0]) if entry and entry[0] else [None] * n
                x = list(entry[1]) if entry else [0] * n
                t_last = entry[2] if entry else None
                at, device = pid, pdf["device_id"].iat[hi - 1]
            if head is not None:
                t_last, s, x = head[0], list(head[1]), list(head[2])
            if lo == hi:
                continue
            tt = t[lo:hi]
            t_prev, t_last = t_last, int(tt[-1])
            for i in range(n):
                c = conds[i][lo:hi]
                idx, start, s[i] = candidates(tt, c.copy(), s[i], durs[i], t_prev, max_gap)
                if not len(idx):
                    continue
                em, x[i] = emit_chain(tt[idx].tolist(), x[i], cds[i])
                if em:
                    sel = idx[np.asarray(em, dtype=np.int64)]
                    parts.append((sel + lo, np.full(len(sel), i), start[sel]))
        res = flush(cur_pdf, cur_t, parts)
        if res is not None:
            yield res
        if goes_on is not None and at is not None and at not in goes_on:
            ended.append((device, t_last, s, [int(v) for v in x]))
        if ended:
            yield left_states(ended)
    return run


@dataclass
class DetectionPlan:
    """What a detection run did, for tests and the bench."""
    partitions: int
    crossing_partitions: int
    pass_b: bool
    rows_per_partition: list


def _fold_starts(summ_a, rules, max_gap=None):
    """Entry episode start and previous reading time per partition (only for
    partitions whose first key continues the previous partition's last key)."""
    s_in_map, prev, prev_exit = {}, None, None
    for row in sorted(summ_a, key=lambda r: r["pid"]):
        cont = prev is not None and row["first_k"] == prev["last_k"]
        s_in = prev_exit if cont else None
        single = row["first_k"] == row["last_k"]
        gap0 = (cont and max_gap is not None and prev["t_last"] is not None
                and row["t_first"] - prev["t_last"] > max_gap)
        if cont:
            s_in_map[row["pid"]] = (s_in, prev["t_last"])
        if single:
            base = s_in if s_in is not None and not gap0 else [None] * len(rules)
            exit_ = [row["s_exit"][i] if row["has_false"][i]
                     else (base[i] if base[i] not in (None, 0) else row["fnz"][i])
                     for i in range(len(rules))]
        else:
            exit_ = list(row["s_exit"])
        prev, prev_exit = row, exit_
    return s_in_map


def _chains(summ_a) -> dict[int, tuple[int, int]]:
    """(chain, next partition) of every partition; -1 after the last.

    A chain starts at a partition whose exit does not depend on its entry and
    goes on through the single-key partitions that continue the key.
    """
    rows, out, chain, prev = sorted(summ_a, key=lambda r: r["pid"]), {}, None, None
    for k, row in enumerate(rows):
        cont = prev is not None and row["first_k"] == prev["last_k"]
        if not (cont and row["first_k"] == row["last_k"]):
            chain = row["pid"]
        out[row["pid"]] = (chain, rows[k + 1]["pid"] if k + 1 < len(rows) else -1)
        prev = row
    return out


_ENTRY = T.StructType([T.StructField("pid", T.IntegerType()),
                       T.StructField("x_in", T.ArrayType(T.LongType()))])


def _compose(rules, chains):
    """Carry the last alert time along each chain: (partition, its entry value per rule).

    Rows come sorted by (chain, pid) and are taken one at a time, so a task
    holds one partition's transfer, however long the chain.
    """
    cds = [r.cooldown_ms for r in rules]

    def run(batches):
        chain, x = None, None
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                own, nxt = _lookup(chains, row.pid)
                if own != chain:
                    chain, x = own, [int(v) for v in row.x_exit]
                else:
                    x = [apply_transfer(row.thr[i], row.ends[i], x[i], cds[i]) for i in range(len(cds))]
                if nxt >= 0:
                    out.append((nxt, [int(v) for v in x]))
            if out:
                yield pd.DataFrame(out, columns=["pid", "x_in"])
    return run


def _entry_cooldowns(summ_b: DataFrame, rules, chains) -> dict[int, list[int]]:
    """Entry last-alert time per partition and rule; transfers are composed on the executors."""
    rows = (summ_b.repartition("chain").sortWithinPartitions("chain", "pid")
            .select("pid", "thr", "ends", "x_exit"))
    return {r["pid"]: list(r["x_in"]) for r in rows.mapInPandas(_compose(rules, chains), _ENTRY).collect()}


def detect_breaches(joined: DataFrame, rules=DEFAULT_RULES,
                    key_cols=("user_id", "device_id"), t_col: str = "t",
                    tie_cols=("event_id",), num_partitions: int | None = None,
                    rows_per_partition: int = DEFAULT_ROWS_PER_PARTITION,
                    alert_time_ms: int | None = None, null_as_zero: bool = True,
                    max_gap_s: int | None = None, return_plan: bool = False,
                    initial: DataFrame | None = None):
    """Alerts (ALERT_MESSAGE schema) for readings already joined with thresholds.

    ``joined`` needs ``key_cols``, ``device_id``, ``user_id``, ``t`` (epoch
    ms) and the columns the rules reference.  ``key_cols=("device_id",)`` lets an episode outlive a change of the
    config's user, as the stream does (for readings joined with the config in force).  ``alert_time`` is the trigger
    reading's event time unless ``alert_time_ms`` fixes it.  ``max_gap_s``
    (off by default, as in the source) lets a silence longer than that end
    an episode.

    ``initial`` (device_id, ``_state``: last reading's time, an episode start per rule, a last alert per rule; at
    most one row a device) goes on from where an earlier run ended.  The result then is the alert rows without
    ``alert_time`` and, with ``rule`` NULL, a row per device with the ``_state`` that it leaves.
    """
    rules = tuple(rules)
    key_cols = tuple(key_cols)
    if "device_id" not in key_cols:
        raise ValueError("key_cols must contain device_id")
    wide, ties = rule_columns(joined, rules, null_as_zero, key_cols, t_col, tie_cols)
    gap = None if max_gap_s is None else int(max_gap_s) * 1000
    if initial is not None:
        if key_cols != ("device_id",):
            raise ValueError("a state is kept per device: key_cols=('device_id',)")
        wide = _with_states(wide, initial, rules)
    raw, plan = _replay(wide, ties, rules, num_partitions, rows_per_partition, gap, initial is not None)
    if initial is not None:
        return raw
    when = F.lit(alert_time_ms) if alert_time_ms is not None else F.col("window_end_ms")
    alerts = raw.select(
        iso_utc_string(F.timestamp_millis(when), fractional=True).alias("alert_time"), *_ALERT_ROWS.fieldNames())
    return (alerts, plan) if return_plan else alerts


def _with_states(wide: DataFrame, states: DataFrame, rules) -> DataFrame:
    """Readings with one state row before each device's first reading (``_in``: last time, starts, last alerts)."""
    n = len(rules)
    blank = {f"c{i}": F.lit(False) for i in range(n)}
    rows = states.select(
        F.col("device_id").alias("_k"), "device_id", F.lit(0).cast("long").alias("t"),
        F.col("_state").alias("_in"), *[v.alias(k) for k, v in blank.items()])
    return wide.withColumn("_in", F.lit(None).cast("array<long>")).unionByName(rows, allowMissingColumns=True)


def _replay(wide: DataFrame, ties: list, rules, num_partitions, rows_per_partition, gap, stateful: bool):
    """The range shuffle and the three passes over per-rule columns: (rows of pass C, what was done)."""
    spark = wide.sparkSession
    ensure_checkpoint_dir(spark)
    p = num_partitions or _estimate_partitions(wide, rows_per_partition)
    order = [F.col("_k"), *([F.col("_in").isNull()] if stateful else []), F.col("t"), *[F.col(c) for c in ties]]
    staged = (wide.repartitionByRange(p, *order).sortWithinPartitions(*order)
                  .withColumn("_pid", F.spark_partition_id())
                  .checkpoint(eager=True))

    # the summary passes only need keys, times and conditions
    narrow = staged.select("_pid", "_k", "t", *[f"c{i}" for i in range(len(rules))], *(["_in"] if stateful else []))
    summ_a = [r.asDict() for r in
              narrow.mapInPandas(_pass_a(len(rules), gap), _SUMMARY_A).collect()]
    s_in_map = _fold_starts(summ_a, rules, gap)
    entry_map = _share(spark, {})
    if s_in_map:
        single = {r["pid"] for r in summ_a if r["first_k"] == r["last_k"]}
        single_cont = _share(spark, {pid: v for pid, v in s_in_map.items() if pid in single})
        chains = _share(spark, _chains(summ_a))
        summ_b = narrow.mapInPandas(_pass_b(rules, single_cont, chains, gap), _SUMMARY_B)
        x_in_map = _entry_cooldowns(summ_b, rules, chains)
        entry_map = _share(spark, {pid: (v[0], x_in_map[pid], v[1])
                                   for pid, v in s_in_map.items()})
    goes_on = None
    if stateful:
        by_pid = sorted(summ_a, key=lambda r: r["pid"])
        goes_on = {a["pid"] for a, b in zip(by_pid, by_pid[1:]) if a["last_k"] == b["first_k"]}
    raw = staged.mapInPandas(_pass_c(rules, entry_map, gap, goes_on), _STATE_ROWS if stateful else _ALERT_ROWS)
    rows = [r["rows"] for r in sorted(summ_a, key=lambda r: r["pid"])]
    return raw, DetectionPlan(p, len(s_in_map), bool(s_in_map), rows)


def rule_matches(joined: DataFrame, rule: RuleSpec, null_as_zero: bool = True) -> DataFrame:
    """FLT-3..5: readings (joined with thresholds) on which one rule's condition
    holds, with the observed and threshold values; a pure filter + projection."""
    df = joined
    if null_as_zero:
        df = df.fillna(0, subset=[c for c in NULL_AS_ZERO if c in df.columns])
    return (df.where(rule.condition.column())
              .select("event_id", "user_id", "device_id", "t",
                      F.lit(rule.name).alias("rule"), F.lit(rule.severity).alias("severity"),
                      F.col(rule.observed).cast("double").alias("observed_value"),
                      F.col(rule.threshold).cast("double").alias("threshold_value")))
