"""SRC-3 / SNK-2: few large files in place of the many small ones that a streaming sink leaves.

A file sink writes its log of files once and for all, and readers of its folder follow that log, so its files can be neither
replaced nor renamed.  Closed ``dt``/``hour`` folders are therefore copied into larger files of a table beside it
(``<path>_compact``), and a small manifest names the folders that have been copied.  ``read_compacted`` takes those
folders from there and all others from the sink's folder; partition pruning keeps the replaced small files from being
listed as input or opened.  A folder changes sides by one write of the manifest, after its copy is complete: a
reader that began before sees the small files, one that begins after sees the large ones, with the same rows.

Once no reader that began before the copy is left, ``purge`` deletes the small files; the sink's log still names them, but
pruning keeps them from being opened.  The sink names folders by processing time, so a closed folder gets no more files.

Files are packed by bytes: folders that fit together into one task's share are written by one task each (first fit, largest
first), larger folders by several.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomlake.sources.bronze_stats import _folders, _in_folders
from roomlake.sources.files import PARTITION_FIELDS, read_bronze
from roomlake.operators.tables import _fs, _read_small, _write_small

MANIFEST = "_folders.json"
TARGET_BYTES = 128 << 20


def _beside(path: str) -> str:
    return f"{path.rstrip('/')}_compact"


def compacted_folders(spark: SparkSession, path: str) -> dict[tuple[str, str], list[int] | None]:
    """(dt, hour) -> [files, bytes] of the small files that a copy was made of; None once they are purged."""
    text = _read_small(spark, f"{_beside(path)}/{MANIFEST}")
    return {} if text is None else {(dt, hour): size for dt, hour, size in json.loads(text)}


def _record(spark: SparkSession, path: str, done: dict) -> None:
    _write_small(spark, f"{_beside(path)}/{MANIFEST}", json.dumps([[*k, s] for k, s in sorted(done.items())]))


def pack_folders(sizes: dict, target: int) -> list[list]:
    """First fit, largest first: lists of folders whose bytes add up to about ``target`` or less."""
    bins: list[list] = []
    room: list[int] = []
    for folder, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        at = next((i for i, r in enumerate(room) if r >= size), None)
        if at is None:
            bins.append([])
            room.append(max(target, size))
            at = len(bins) - 1
        bins[at].append(folder)
        room[at] -= size
    return bins


def compact(spark: SparkSession, path: str, schema: T.StructType, closed_before: _dt.datetime, min_files: int = 2,
            target_bytes: int = TARGET_BYTES) -> list[tuple[str, str]]:
    """Copy closed folders (whole hours before ``closed_before``, UTC) of at least ``min_files`` files.

    Returns the folders copied.  A folder to which a file was added since its copy is copied anew.
    """
    path = path.rstrip("/")
    done, now = compacted_folders(spark, path), _folders(spark, path)
    edge = closed_before.strftime("%Y-%m-%d"), closed_before.strftime("%H")
    todo = {k: size for k, size in now.items()
            if k < edge and (done[k] not in (None, size) if k in done else size[0] >= min_files)}
    if not todo:
        return []
    # files per folder by its bytes; rows of a folder go to that many tasks, small folders share one
    bins = pack_folders({k: s[1] for k, s in todo.items()}, target_bytes)
    place = [(dt, hour, b, max(1, -(-todo[dt, hour][1] // target_bytes))) for b, folders in enumerate(bins) for dt, hour in folders]
    plan = F.broadcast(spark.createDataFrame(place, "dt string, hour string, _bin int, _files long"))       # a row a folder
    rows = read_bronze(spark, path, schema).where(_in_folders(list(todo)))
    dealt = (rows.join(plan, ["dt", "hour"])
                 .withColumn("_part", F.pmod(F.xxhash64(*schema.fieldNames()), F.col("_files")))
                 .repartition(F.col("_bin"), F.col("_part")).sortWithinPartitions("dt", "hour").drop("_bin", "_files", "_part"))
    (dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt", "hour").json(_beside(path)))
    # files that came while the copy was made: not in it for certain, so the folder stays with the small files
    after = _folders(spark, path)
    done |= todo
    done = {k: s for k, s in done.items() if s is None or after.get(k) == s}
    _record(spark, path, done)
    return sorted(k for k in todo if k in done)


def read_compacted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All bronze rows: copied folders from their large files, the others from the sink's folder."""
    path = path.rstrip("/")
    now = _folders(spark, path)
    # a folder that got a file since is read from the small files until it is copied anew
    copied = [k for k, size in compacted_folders(spark, path).items() if size is None or now.get(k) == size]
    small = read_bronze(spark, path, schema)
    if not copied:
        return small
    full = T.StructType(schema.fields + PARTITION_FIELDS)
    large = spark.read.schema(full).json(_beside(path)).select(*full.names).where(_in_folders(copied))
    return small.where(~_in_folders(copied)).unionByName(large)


def purge(spark: SparkSession, path: str) -> int:
    """Delete the small files of copied folders; returns how many folders went.  The manifest is written first."""
    path = path.rstrip("/")
    done, now = compacted_folders(spark, path), _folders(spark, path)
    gone = [k for k, size in done.items() if size is not None and now.get(k) == size]
    if gone:
        _record(spark, path, {**done, **{k: None for k in gone}})
    for dt, hour in [k for k, size in compacted_folders(spark, path).items() if size is None]:
        fs, p = _fs(spark, f"{path}/dt={dt}/hour={hour}")
        fs.delete(p, True)
    return len(gone)
