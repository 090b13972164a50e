"""Document fingerprints (operator 9) from Lempel-Ziv phrases.

A text is parsed into dictionary phrases (LZ78: the shortest piece not yet in
the dictionary, which it then joins).  The set of phrases is what a compressor would learn
of the text; its one-permutation minimum hashes are the fingerprint, and two
fingerprints' agreement estimates how far the texts compress alike (the
Jaccard similarity of their phrase sets).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomlake.llm.common import chunks, hash_spans, texts

BINS = 128
EMPTY = 0xFFFF
GROUP_CHARS = 1_000_000     # text hashed at once


def parse(text: str, at: int, seen: set[str], ends: list[int]) -> None:
    """Parse ``text`` from ``at`` on; ``seen`` and ``ends`` (phrase ends) grow.

    Every prefix of a phrase is a phrase, so the length of the next one is
    searched up or down from the last one's.  A rest that is a phrase already adds none.
    """
    n, length, add, end = len(text), 2, seen.add, ends.append
    while at < n:
        piece = text[at:at + length]
        if piece in seen:
            while True:
                if at + length >= n:
                    return
                length += 1
                piece = text[at:at + length]
                if piece not in seen:
                    break
        else:
            while length > 1:
                shorter = text[at:at + length - 1]
                if shorter in seen:
                    break
                piece = shorter
                length -= 1
        add(piece)
        at += len(piece)
        end(at)


def _byte_places(text: str, places: list[int]) -> np.ndarray:
    """UTF-8 offsets of code point offsets."""
    at = np.array(places, np.int64)
    if text.isascii():
        return at
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    return np.concatenate(([0], np.cumsum(width)))[at]


def _hash_phrases(rows: list[str], froms: list[int], ends: list[list[int]]) -> list[np.ndarray]:
    """Hashes of each text's phrases: from ``froms`` to the first end, then from end to end; one pass over all."""
    data, starts, stops, counts, base = [], [], [], [], 0
    for text, first, own in zip(rows, froms, ends):
        raw = text.encode()
        places = _byte_places(text, [first, *own]) + base
        starts.append(places[:-1])
        stops.append(places[1:])
        counts.append(len(own))
        data.append(raw)
        base += len(raw)
    if not data:
        return []
    hashes = hash_spans(b"".join(data), np.concatenate(starts), np.concatenate(stops))
    return np.split(hashes, np.cumsum(counts)[:-1])


def _signatures(hashes: list[np.ndarray]) -> list[np.ndarray]:
    """Minimum hash per bin of each phrase set; empty bins hold ``EMPTY``."""
    out = np.full((len(hashes), BINS), EMPTY, np.uint16)
    if any(len(h) for h in hashes):
        h = np.concatenate(hashes)
        row = np.repeat(np.arange(len(hashes), dtype=np.uint64), [len(x) for x in hashes])
        value = np.minimum((h >> np.uint64(41)) & np.uint64(0xFFFF), np.uint64(EMPTY - 1))
        key = np.sort(((row << np.uint64(7) | h >> np.uint64(57)) << np.uint64(16)) | value)
        first = key[np.concatenate(([True], key[1:] >> np.uint64(16) != key[:-1] >> np.uint64(16)))]
        cell = first >> np.uint64(16)
        out[(cell >> np.uint64(7)).astype(np.int64), (cell & np.uint64(BINS - 1)).astype(np.int64)] = \
            (first & np.uint64(0xFFFF)).astype(np.uint16)
    return list(out)


def fingerprint_many(rows: list[str], afters: list[str | None] = ()) -> tuple[list, list]:
    """Signatures of texts and, where ``afters`` has the next text, (edited text, its signature).

    The edited text is the text with its last third replaced by as many first code points of
    the next one.  Phrases that end within the unchanged part are the same, so only the
    rest is parsed and hashed again.
    """
    ends: list[list[int]] = []
    for t in rows:
        own: list[int] = []
        parse(t, 0, set(), own)
        ends.append(own)
    hashes = _hash_phrases(rows, [0] * len(rows), ends)
    new_texts, froms, new_ends, kept = [], [], [], []
    for t, own, h, after in zip(rows, ends, hashes, afters):
        if after is None:
            continue
        k = len(t) // 3
        edited = t[:len(t) - k] + after[:k] if k else t
        same = int(np.searchsorted(np.array(own, np.int64), len(t) - k, side="right"))
        head = own[:same]
        seen = {t[a:b] for a, b in zip([0, *head], head)}
        tail: list[int] = []
        parse(edited, head[-1] if head else 0, seen, tail)
        new_texts.append(edited)
        froms.append(head[-1] if head else 0)
        new_ends.append(tail)
        kept.append(h[:same])
    fresh = _hash_phrases(new_texts, froms, new_ends)
    edited_sigs = iter(zip(new_texts, _signatures([np.concatenate(x) for x in zip(kept, fresh)])))
    return _signatures(hashes), [None if a is None else next(edited_sigs) for a in afters]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of two phrase sets; two empty sets are alike."""
    used = (a != EMPTY) | (b != EMPTY)
    n = int(used.sum())
    return float((a[used] == b[used]).sum() / n) if n else 1.0


def to_text(sig: np.ndarray) -> str:
    return sig.astype(">u2").tobytes().hex()


def signature(text: str) -> np.ndarray:
    return fingerprint_many([text])[0][0]


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_chars`` and ``fingerprint``.  A null text is an empty one."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    schema = T.StructType([T.StructField(id_col, src.schema["id"].dataType), T.StructField("n_chars", T.LongType()),
                           T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = texts(b.column(1))
            sigs = [x for i, j in chunks(rows, len, GROUP_CHARS) for x in fingerprint_many(rows[i:j])[0]]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t) for t in rows], pa.int64()),
                 pa.array([to_text(x) for x in sigs], pa.string())], names=schema.names)

    return src.mapInArrow(run, schema)


class Ranges:
    """Contiguous ranges of the (id, text hash) order, split from quantiles over all ids.

    An id that fills several quantiles (a third of the rows may share one) is
    split further by the hash.
    """

    def __init__(self, rows: DataFrame, n: int):
        marks = [int(x) for x in rows.approxQuantile("id", [i / n for i in range(1, n)], 1 / (4 * n))] if n > 1 else []
        bounds = []
        for x in sorted(set(marks)):
            times = marks.count(x)
            bounds += [(x, -(1 << 63) + (i << 64) // times) for i in range(times)]
        self.ids = np.array([b[0] for b in bounds], np.int64)
        self.hashes = np.array([b[1] for b in bounds], np.int64)

    def of(self, ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """How many bounds do not come after (id, hash)."""
        lo, hi = np.searchsorted(self.ids, ids, side="left"), np.searchsorted(self.ids, ids, side="right")
        out = lo.copy()
        for i in np.flatnonzero(hi > lo):
            out[i] += np.searchsorted(self.hashes[lo[i]:hi[i]], hashes[i], side="right")
        return out.astype(np.int64)


def neighbour_likeness(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                       ranges: int | None = None) -> DataFrame:
    """Fingerprint each text, its edited text and compare with the next document, descending id.

    Columns: the id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.  The edited text's last floor(n_chars / 3) code points are the first as
    many (or all) of the next document; after the last document comes the first.  Null text:
    empty.  Equal ids follow each other by text hash; null ids come last; a single document is
    its own next one.

    Texts are shuffled once, into ranges of the id order; the first document of each range also goes
    to the range before it.  A task streams its rows and holds a group of a few MB (two documents at least).
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    lowest = -(1 << 63)
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(lowest)).alias("id"),
                      F.col(id_col).isNull().alias("no_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    keyed = src.withColumn("h", F.xxhash64("t"))
    n = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = Ranges(keyed.select("id"), n)

    @F.pandas_udf("long")
    def range_of(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series(cuts.of(ids.to_numpy(np.int64), hashes.to_numpy(np.int64)))

    heads = sorted((r["r"], r["m"]["id"], r["m"]["h"]) for r in
                   keyed.select("id", "h", range_of("id", "h").alias("r"))
                   .groupBy("r").agg(F.max(F.struct("id", "h")).alias("m")).collect())    # a row per range
    # the head of each range ends the next higher one; the highest head ends the lowest range
    ends = {(h[1], h[2]): after for h, after in
            zip(heads, [*(x[0] for x in heads[1:]), heads[0][0]])} if heads else {}

    @F.pandas_udf("array<long>")
    def targets(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        own = cuts.of(ids.to_numpy(np.int64), hashes.to_numpy(np.int64)).tolist()
        tails = [ends.get(k) for k in zip(ids.tolist(), hashes.tolist())]
        return pd.Series([[2 * r] if t is None else [2 * r, 2 * t + 1] for r, t in zip(own, tails)])

    arrow = pa.schema([("id", pa.int64()), ("no_id", pa.bool_()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                       ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                       ("near_edited", pa.float64()), ("near_next", pa.float64())])
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("no_id", T.BooleanType()),
        T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])

    def compare(rows: list[tuple]) -> pa.RecordBatch:
        """Rows (place, id, no_id, text) in order; each that has its next one here gives a row."""
        own = [r[3] for r in rows]
        pairs = [a[0] % 2 == 0 and a[0] // 2 == b[0] // 2 for a, b in zip(rows, rows[1:])] + [False]
        sigs, edited = fingerprint_many(own, [own[i + 1] if pair else None for i, pair in enumerate(pairs)])
        out = [(rows[i][1], rows[i][2], len(own[i]), hashlib.sha256(edited[i][0].encode()).hexdigest(),
                to_text(sigs[i]), to_text(edited[i][1]), likeness(sigs[i], edited[i][1]),
                likeness(sigs[i], sigs[i + 1])) for i, pair in enumerate(pairs) if pair]
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in out], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(4))):
                rows.append(row)
                size += len(row[3])
                if size > GROUP_CHARS and len(rows) > 1:
                    yield compare(rows)
                    rows, size = rows[-1:], len(row[3])     # the last one still needs its next
        if len(rows) > 1:
            yield compare(rows)

    dealt = (keyed.withColumn("place", F.explode(targets("id", "h")))
             .repartition(F.expr("place div 2"))
             .sortWithinPartitions("place", F.desc("id"), F.desc("h"))
             .select("place", "id", "no_id", "t"))
    done = dealt.mapInArrow(run, schema)
    return done.select(F.when(~F.col("no_id"), F.col("id")).cast(kind).alias(id_col), *schema.names[2:])
