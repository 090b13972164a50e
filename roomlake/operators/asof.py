"""Backward as-of join: every left row with the newest right row of its key at or before its time (JOIN-1 over history).

A key may hold a large share of either side, so rows are never grouped by key.  Both sides are laid end to end in
one frame, range-partitioned and sorted by (key, time, right before left, tie): a hot key spans several
partitions of similar size.  A right row then stands before the left rows that it applies to, and the join is a
forward fill:

1. one range shuffle, checkpointed (every pass sees the same partitions, a lost executor re-samples nothing);
2. pass A: per partition its first and last key and, where its last key has one there, the last right row;
3. the driver folds these in partition order into the right row that enters each partition: one row a
   partition, as with Spark's own range bounds;
4. pass B: a task fills forward batch by batch and carries one right row, whatever the size of the key.

Equal times: a right row at the very time of a left row applies to it; among right rows of one time the one with the greatest
``right_tie`` (NULL lowest).  Left rows with a NULL key or time match nothing: ``how="left"`` returns them unmatched,
``inner`` drops them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomlake.operators.breaches import (DEFAULT_ROWS_PER_PARTITION, KEY_SEP, _estimate_partitions, _lookup,
                                         _share)
from roomlake.session import ensure_checkpoint_dir


def _side(df: DataFrame, on: tuple, time: str, tie: str | None, side: int, structs: tuple) -> DataFrame:
    """Rows of one side as (_key, _time, _side, _tie, _l, _r); the other side's struct is NULL."""
    key = F.concat_ws(KEY_SEP, *[F.col(c).cast("string") for c in on])
    own = F.struct(*[F.col(c) for c in df.columns])
    none = lambda t: F.lit(None).cast(t)
    known = F.col(time).isNotNull()
    for c in on:
        known = known & F.col(c).isNotNull()
    return df.where(known).select(
        key.alias("_key"), F.col(time).alias("_time"), F.lit(side).alias("_side"),
        (F.col(tie).cast("long") if tie else none("long")).alias("_tie"),
        (own if side else none(structs[0])).alias("_l"), (none(structs[1]) if side else own).alias("_r"))


def _runs(batches: Iterator[pa.RecordBatch]):
    """(batch, partition, keys, is_right, run starts) of every non-empty batch; a run is one key in one partition."""
    for batch in batches:
        if batch.num_rows:
            pid = batch.column(0).to_numpy(zero_copy_only=False)
            keys = batch.column(1).to_numpy(zero_copy_only=False)
            new = np.ones(len(keys), dtype=bool)
            new[1:] = (keys[1:] != keys[:-1]) | (pid[1:] != pid[:-1])
            yield batch, pid, keys, batch.column(2).to_numpy(zero_copy_only=False) == 0, new


def _freeze(row: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.record_batch([row], names=["r"])
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _thaw(data: bytes) -> pa.Array:
    return pa.ipc.open_stream(data).read_all().column(0).combine_chunks()


_ENDS = "pid int, first_key string, last_key string, carry binary"


def _partition_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass A: per partition its outer keys and the last right row of the last key."""
    ends: dict[int, list] = {}
    for batch, pid, keys, is_right, new in _runs(batches):
        starts = np.flatnonzero(new)
        for a, b in zip(starts.tolist(), np.append(starts[1:], len(keys)).tolist()):
            p, key = int(pid[a]), keys[a]
            end = ends.setdefault(p, [key, key, None])
            if end[1] != key:
                end[1], end[2] = key, None
            right = np.flatnonzero(is_right[a:b])
            if len(right):
                end[2] = batch.column(3).slice(a + int(right[-1]), 1)
    rows = [(p, first, last, None if r is None else _freeze(pa.concat_arrays([r]))) for p, (first, last, r) in ends.items()]
    cols = list(zip(*rows)) if rows else [[]] * 4
    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.int32(), pa.string(), pa.string(), pa.binary()))],
                                     names=["pid", "first_key", "last_key", "carry"])


def _entering(ends: list) -> dict[int, bytes]:
    """The right row that enters each partition whose first key goes on from the one before."""
    out, key, carry = {}, None, None
    for row in sorted(ends, key=lambda r: r["pid"]):
        into = carry if key is not None and row["first_key"] == key else None
        if into is not None:
            out[row["pid"]] = bytes(into)
        if row["carry"] is not None:
            carry = row["carry"]
        elif row["first_key"] != row["last_key"] or into is None:
            carry = None
        key = row["last_key"]
    return out


def _fill(entering, inner: bool):
    """Pass B: left rows with the right row in force; one right row is carried from batch to batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, key, carry = None, None, None
        for batch, pid, keys, is_right, new in _runs(batches):
            n, r = len(keys), batch.column(4)
            if at != pid[0] or key != keys[0]:
                frozen = _lookup(entering, int(pid[0])) if at != pid[0] else None
                carry = _thaw(frozen) if frozen is not None else None
            here = np.arange(n)
            last = np.maximum.accumulate(np.where(is_right, here, -1))
            start = np.maximum.accumulate(np.where(new, here, 0))
            first_run = start == 0
            place = np.where(last >= start, last + 1, np.where(first_run & (carry is not None), 0, -1))
            # a partition that starts inside the batch may be entered by a key that goes on
            heads = [carry if carry is not None else pa.nulls(1, r.type)]
            for s in np.flatnonzero(new)[1:].tolist():
                if pid[s] != pid[s - 1]:
                    frozen = _lookup(entering, int(pid[s]))
                    if frozen is not None:
                        heads.append(_thaw(frozen))
                        own = (start == s) & (last < s)
                        place[own] = n + len(heads) - 1
            pool = pa.concat_arrays([heads[0], r, *heads[1:]])
            left = ~is_right & (place >= 0) if inner else ~is_right
            rows = np.flatnonzero(left)
            if len(rows):
                take = pa.array(place[rows], mask=place[rows] < 0)
                yield pa.RecordBatch.from_arrays([batch.column(3).take(pa.array(rows)), pool.take(take)], names=["_l", "_r"])
            at, key = pid[-1], keys[-1]
            carry = pool.slice(int(place[-1]), 1) if place[-1] >= 0 else None
    return run


def asof_join(left: DataFrame, right: DataFrame, on, left_time: str, right_time: str, left_tie: str | None = None,
              right_tie: str | None = None, how: str = "inner", num_partitions: int | None = None) -> DataFrame:
    """Left columns, then those of the newest right row of the same key at or before the left row's time.

    Right columns named like a left one are left out.  Both times must compare (one type); ties are whole
    numbers.  ``num_partitions`` overrides the size-based number of range partitions.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how is inner or left, not {how!r}")
    on = (on,) if isinstance(on, str) else tuple(on)
    spark = left.sparkSession
    ensure_checkpoint_dir(spark)
    structs = tuple(T.StructType([T.StructField(f.name, f.dataType) for f in d.schema.fields]) for d in (left, right))
    both = (_side(right, on, right_time, right_tie, 0, structs)
            .unionByName(_side(left, on, left_time, left_tie, 1, structs)))
    order = ["_key", "_time", "_side", "_tie"]
    p = num_partitions or _estimate_partitions(both, DEFAULT_ROWS_PER_PARTITION)
    staged = (both.repartitionByRange(p, *order).sortWithinPartitions(*order)
                  .select(F.spark_partition_id().alias("_pid"), "_key", "_side", "_l", "_r").checkpoint(eager=True))
    ends = staged.select("_pid", "_key", "_side", "_r").mapInArrow(_partition_ends, _ENDS).collect()
    entering = _share(spark, _entering([r.asDict() for r in ends]))
    filled = staged.mapInArrow(_fill(entering, how == "inner"),
                               T.StructType([T.StructField("_l", structs[0]), T.StructField("_r", structs[1])]))
    more = [c for c in right.columns if c not in left.columns]
    out = filled.select("_l.*", *[F.col("_r")[c].alias(c) for c in more])
    if how == "left":
        lost = F.col(left_time).isNull()
        for c in on:
            lost = lost | F.col(c).isNull()
        types = {f.name: f.dataType for f in right.schema.fields}
        out = out.unionByName(left.where(lost).select("*", *[F.lit(None).cast(types[c]).alias(c) for c in more]))
    return out


def join_config_in_force(readings: DataFrame, updates: DataFrame, how: str = "inner", reading_time: str = "event_ts",
                         update_time: str = "updated_ts", num_partitions: int | None = None) -> DataFrame:
    """Readings with the config of their device that was in force at the reading (a backfill of the live job).

    Readings before their device's first config drop (FLT-7).  Updates at one instant: the greatest ``seq`` wins.
    """
    cols = ["device_id", "user_id", update_time, *[c for c in updates.columns if c.endswith("_threshold")]]
    tie = "seq" if "seq" in updates.columns else None
    readings = readings.drop("user_id")
    tie_cols = [tie] if tie else []
    out = asof_join(readings, updates.select(*cols, *tie_cols), "device_id", reading_time, update_time,
                    right_tie=tie, how=how, num_partitions=num_partitions)
    return out.drop(*tie_cols)
