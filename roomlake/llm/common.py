"""Helpers shared by the operators: lineage cuts, tokenizer files, word scans."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roomlake.session import scratch_path

#: the six ASCII separators of ``[^\x20\x09-\x0D]+`` words
SEPARATORS = b"\x20\x09\x0a\x0b\x0c\x0d"


def cut(df: DataFrame, name: str, **options) -> DataFrame:
    """Materialise ``df`` as Parquet under the session's checkpoint folder and reread it.

    Cuts the lineage like ``checkpoint()`` but keeps the columns compressed;
    the folder is shared storage on a cluster (``spark.checkpoint.dir``), so
    the rows outlive any executor.  ``options`` go to the Parquet writer.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Remove tables that ``cut`` wrote, once whatever was made from them is written itself."""
    for table in tables:
        spark, path = table.sparkSession, table._cut_path
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def tokenizer_path(name: str) -> str:
    """A file name of the public tokenizers, or a path, as a path on this machine."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def texts(column: pa.Array) -> list[str]:
    """Python strings of a string column; null counts as the empty text."""
    return [t or "" for t in column.to_pylist()]


def chunks(items: list, weight, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive slices ``[a, b)`` whose summed weight stays under ``limit`` (or one item)."""
    a, total = 0, 0
    for b, x in enumerate(items):
        w = weight(x)
        if b > a and total + w > limit:
            yield a, b
            a, total = b, 0
        total += w
    if a < len(items):
        yield a, len(items)


class Memo(dict):
    """A bounded word cache: emptied when full, long words pass through uncached."""

    def __init__(self, limit: int, longest: int = 64):
        super().__init__()
        self.limit, self.longest = limit, longest

    def missing(self, keys: set) -> list:
        """The keys not cached, in a cache that has room for them (emptied first if need be)."""
        new = [k for k in keys if k not in self]
        if len(self) + len(new) > self.limit and len(self):
            self.clear()
            new = list(keys)
        return new


class Generations(Memo):
    """A bounded word cache that, when full, keeps what it held as an older generation and takes words back from there."""

    def __init__(self, limit: int, longest: int = 64):
        super().__init__(limit, longest)
        self.old: dict = {}

    def missing(self, keys: set) -> list:
        """The keys that neither generation holds, in a cache that has room for them."""
        absent = [k for k in keys if k not in self]
        if len(self) + len(absent) > self.limit and len(self):
            self.old = dict(self)
            self.clear()
            absent = keys
        new = []
        for k in absent:
            if k in self.old:
                self[k] = self.old[k]
            else:
                new.append(k)
        return new


_IS_SEP = np.zeros(256, dtype=bool)
_IS_SEP[list(SEPARATORS)] = True


def word_bounds(data: np.ndarray, doc_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (byte offsets) of the words of several texts laid end to end."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~_IS_SEP[data]
    first = np.zeros(len(data) + 1, dtype=bool)        # a text starts here: no word runs across
    first[0] = True
    first[doc_ends] = True
    prev = np.empty(len(data), dtype=bool)
    prev[0] = False
    prev[1:] = word[:-1]
    starts = np.flatnonzero(word & (~prev | first[:-1]))
    nxt = np.empty(len(data), dtype=bool)
    nxt[-1] = False
    nxt[:-1] = word[1:]
    ends = np.flatnonzero(word & (~nxt | first[1:])) + 1
    return starts, ends


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise on uint64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_spans(buf: bytes, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte span, eight bytes at a time over all spans at once."""
    n = len(starts)
    lens = (ends - starts).astype(np.int64)
    h = mix64(lens.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 ^ seed))
    if n == 0:
        return h
    padded = buf + b"\0" * 8
    lanes = np.lib.stride_tricks.as_strided(
        np.frombuffer(padded, dtype="<u8", count=1), shape=(len(buf) + 1,), strides=(1,))
    k, idx = 0, np.arange(n)
    while len(idx):
        if k >= 8:                                     # spans of more than 64 bytes: one call each
            import xxhash

            mv = memoryview(buf)
            for i in idx:
                h[i] = xxhash.xxh64_intdigest(mv[starts[i]:ends[i]], int(h[i]) & 0xFFFFFFFF)
            break
        at = starts[idx] + 8 * k
        lane = lanes[at]
        rest = lens[idx] - 8 * k
        short = rest < 8
        if short.any():
            keep = (np.uint64(1) << (rest[short] * 8).astype(np.uint64)) - np.uint64(1)
            lane[short] &= keep
        h[idx] = mix64(h[idx] ^ mix64(lane + np.uint64(0x9E3779B97F4A7C15)))
        idx = idx[rest > 8]
        k += 1
    return h
