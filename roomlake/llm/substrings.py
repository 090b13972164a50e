"""Substring dedup (operator 2) with super-k-mer partitions of word windows.

A window is ``window`` consecutive words; its minimiser is the smallest hash
among its ``mer``-word sequences.  Consecutive windows with the same minimiser
occurrence form a super-k-mer: one string that holds them all.  Two equal windows
have the same minimiser, so a minimiser met once in the whole input holds no repeated
window, and one whose super-k-mers are all the same words (told by a 64-bit digest of them beside the
64-bit minimiser) holds only repeated ones.  Only the
others travel: each as one packed string to the bucket of its minimiser, where its
windows are sorted and counted.  The repeated windows go back to their
documents, and the words they cover are removed.

Texts are scanned once for minimisers; those of documents that hold a repeated minimiser
are fetched by one join, kept in the shared folder and read again to remove words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomlake.llm.common import cut, hash_spans, mix64, word_bounds

SCAN_BYTES = 4_000_000      # text scanned at once
SEGMENT = 1 << 22           # windows of one minimiser scan (positions must fit the low bits below)
LOW = np.uint64((1 << 24) - 1)
BUCKET_STRINGS = 20_000     # distinct strings that one bucket counts in memory; larger ones are counted as rows


def _rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column end to end, and each row's end; null rows are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if len(column) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column), np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets[1:] - offsets[0]


def scan_groups(column: pa.Array) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of rows: first row, bytes, each row's end, word starts and word ends within the bytes."""
    data, ends = _rows(column)
    a = 0
    while a < len(ends):
        base = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, base + SCAN_BYTES, side="right")))
        part, stops = data[base:ends[b - 1]], ends[a:b] - base
        inside = stops[stops < len(part)]
        starts, stops_w = word_bounds(part, inside)
        yield a, part.tobytes(), stops, starts, stops_w
        a = b


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive entries."""
    span, out = 1, x
    while 2 * span <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[:len(x) - w + 1], out[w - span:w - span + len(x) - w + 1])


def mer_hashes(words: np.ndarray, mer: int) -> np.ndarray:
    """Hash of every ``mer`` consecutive words from the words' hashes."""
    n = len(words) - mer + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(mer):
            out = out * np.uint64(0x9E3779B97F4A7C15) + words[j:j + n]
    return mix64(out)


def super_kmers(words: np.ndarray, doc_of: np.ndarray, window: int, mer: int):
    """Minimiser, first window and number of windows of every super-k-mer.

    ``words``: hashes of the words of several documents end to end; ``doc_of``: the
    document of each word (windows stay inside one).
    """
    mers = mer_hashes(words, mer)
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    per = window - mer + 1
    minis, firsts, counts = [], [], []
    for a in range(0, n, SEGMENT):
        b = min(n, a + SEGMENT)
        part = mers[a:b + per - 1]
        # the hash's high bits and the place: the minimum is the leftmost of the smallest
        low = _sliding_min((part & ~LOW) | np.arange(len(part), dtype=np.uint64), per)
        place = (low & LOW).astype(np.int64)
        whole = np.flatnonzero(doc_of[a:b] == doc_of[a + window - 1:b + window - 1])
        if len(whole) == 0:
            continue
        at = place[whole]
        new = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 0) | (np.diff(whole) != 1))))
        minis.append(part[at[new]])
        firsts.append(whole[new] + a)
        counts.append(np.diff(np.append(new, len(whole))))
    if not minis:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(minis), np.concatenate(firsts), np.concatenate(counts)


def _doc_of(word_starts: np.ndarray, row_ends: np.ndarray) -> np.ndarray:
    return np.searchsorted(row_ends, word_starts, side="right")


def _scan(src: DataFrame, window: int, mer: int) -> DataFrame:
    """One row per text (``mini`` null: words, digest) and one per super-k-mer.

    ``rid`` numbers the texts.  A super-k-mer's ``digest`` is a hash of all its words,
    its ``at`` the first window and its ``n`` the number of windows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 36
        for b in batches:
            for a, data, ends, starts, stops in scan_groups(b.column(1)):
                k = len(ends)
                doc_of = _doc_of(starts, ends)
                n_words = np.bincount(doc_of, minlength=k)
                first_word = np.cumsum(n_words) - n_words
                shas = []
                for i in range(k):
                    f, n = first_word[i], n_words[i]
                    line = b" ".join(data[starts[f]:stops[f + n - 1]].split()) if n else b""
                    shas.append(hashlib.sha256(line).hexdigest())
                words = hash_spans(data, starts, stops)
                mini, first, count = super_kmers(words, doc_of, window, mer)
                # polynomial hash of a run of words from prefix sums, a second family beside the minimiser's
                digest = _run_hash(hash_spans(data, starts, stops, seed=0x5BD1E995) if len(mini) else words,
                                   first, count + window - 1)
                m = len(mini)
                none = pa.nulls(m, pa.string())
                ids = b.column(0).slice(a, k)
                owner = doc_of[first] if m else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(rid, rid + k)), ids, b.column(2).slice(a, k), pa.nulls(k, pa.int64()),
                     pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array(n_words.astype(np.int64)),
                     pa.array(shas, pa.string())], names=names)
                if m:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rid + owner), pa.nulls(m, ids.type), pa.nulls(m, pa.int64()),
                         pa.array(mini.view(np.int64)), pa.array(digest.view(np.int64)),
                         pa.array(first - first_word[owner]), pa.array(count.astype(np.int64)), none], names=names)
                rid += k

    schema = T.StructType([
        T.StructField("rid", T.LongType()), T.StructField("id", src.schema["id"].dataType),
        T.StructField("k", T.LongType()), T.StructField("mini", T.LongType()), T.StructField("digest", T.LongType()),
        T.StructField("at", T.LongType()), T.StructField("n", T.LongType()), T.StructField("sha", T.StringType())])
    names = schema.names
    return src.mapInArrow(run, schema)


_ODD = np.uint64(0xD6E8FEB86659FD93)
_ODD_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(max(n - 1, 0), base, np.uint64))))[:n]


def _run_hash(words: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Hash of each run ``words[first:first + count]``, wherever it stands."""
    if len(first) == 0:
        return np.zeros(0, np.uint64)
    n = len(words)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * _powers(_ODD, n))))
        inverse = _powers(_ODD_INVERSE, n)
        return mix64((sums[first + count] - sums[first]) * inverse[first] + count.astype(np.uint64))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Small slices, so that few rows are Python objects at a time."""
    for b in batches:
        for a in range(0, b.num_rows, rows):
            yield b.slice(a, rows)


def _pack(docs: DataFrame, window: int) -> DataFrame:
    """The packed string of each super-k-mer (rid, mini, at, n) from its document's text ``t``.

    ``docs`` has, per text, its super-k-mers as arrays; the strings are its words
    joined by one space.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            rids, minis, ats, packed = [], [], [], []
            size = 0
            for rid, t, kmers in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                words = t.encode().split()
                for k in kmers:
                    rids.append(rid)
                    minis.append(k["mini"])
                    ats.append(k["at"])
                    packed.append(b" ".join(words[k["at"]:k["at"] + k["n"] + window - 1]))
                    size += len(packed[-1])
                if size > 8_000_000:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rids, pa.int64()), pa.array(minis, pa.int64()), pa.array(ats, pa.int64()),
                         pa.array(packed, pa.binary())], names=["rid", "mini", "at", "packed"])
                    rids, minis, ats, packed, size = [], [], [], [], 0
            if rids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rids, pa.int64()), pa.array(minis, pa.int64()), pa.array(ats, pa.int64()),
                     pa.array(packed, pa.binary())], names=["rid", "mini", "at", "packed"])

    return docs.mapInArrow(run, "rid long, mini long, at long, packed binary")


def _windows(packed: bytes, window: int) -> list[bytes]:
    """The windows of a packed string, each as its own words."""
    ends = [i for i, c in enumerate(packed) if c == 32] + [len(packed)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    return [packed[starts[i]:ends[i + window - 1]] for i in range(len(ends) - window + 1)]


def _count_buckets(strings: DataFrame, window: int) -> DataFrame:
    """Sort and count the windows of each minimiser's strings (mini, pd, packed, copies).

    Returns (mini, pd, off): the windows of a string that occur more than once in all.
    """
    def bucket(rows: list[tuple[int, bytes, int]]) -> list[tuple[int, int]]:
        every = [(w, pd, off, copies) for pd, packed, copies in rows for off, w in enumerate(_windows(packed, window))]
        every.sort()
        out, a = [], 0
        while a < len(every):
            b, total = a, 0
            while b < len(every) and every[b][0] == every[a][0]:
                total += every[b][3]
                b += 1
            if total > 1:
                out += [(pd, off) for _, pd, off, _ in every[a:b]]
            a = b
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mini, rows = None, []

        def done(found: list[tuple[int, int]], of: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([of] * len(found), pa.int64()), pa.array([x[0] for x in found], pa.int64()),
                 pa.array([x[1] for x in found], pa.int64())], names=["mini", "pd", "off"])

        for b in batches:
            for m, pd, packed, copies in zip(*(b.column(i).to_pylist() for i in range(4))):
                if m != mini:
                    if rows and (found := bucket(rows)):
                        yield done(found, mini)
                    mini, rows = m, []
                rows.append((pd, packed, copies))
        if rows and (found := bucket(rows)):
            yield done(found, mini)

    dealt = strings.select("mini", "pd", "packed", "copies").repartition("mini").sortWithinPartitions("mini")
    return dealt.mapInArrow(run, "mini long, pd long, off long")


def _count_rows(strings: DataFrame, window: int) -> DataFrame:
    """The same for minimisers with very many strings: windows as rows, counted by one aggregation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for m, pd, packed, copies in zip(*(b.column(i).to_pylist() for i in range(4))):
                ws = _windows(packed, window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m] * len(ws), pa.int64()), pa.array([pd] * len(ws), pa.int64()),
                     pa.array(range(len(ws)), pa.int64()),
                     pa.array([hashlib.blake2b(w, digest_size=16).digest() for w in ws], pa.binary()),
                     pa.array([copies] * len(ws), pa.int64())], names=["mini", "pd", "off", "w", "copies"])

    rows = strings.select("mini", "pd", "packed", "copies").mapInArrow(
        run, "mini long, pd long, off long, w binary, copies long")
    many = rows.groupBy("mini", "w").agg(F.sum("copies").alias("c")).where("c > 1").select("mini", "w")
    return rows.join(many, ["mini", "w"]).select("mini", "pd", "off")


def _remove(docs: DataFrame, window: int, keep_text: bool) -> DataFrame:
    """Drop the words that the spans (first window, number of windows) of each text cover."""
    names = ["rid", "n_removed", "sha"] + ["kept_text"] * keep_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            removed, shas, kept_texts = [], [], []
            for t, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                words = t.encode().split()
                edge = np.zeros(len(words) + 1, np.int64)
                at = np.array([s["at"] for s in spans], np.int64)
                end = at + np.array([s["n"] for s in spans], np.int64) + window - 1
                np.add.at(edge, at, 1)
                np.add.at(edge, end, -1)
                keep = np.cumsum(edge[:-1]) == 0
                line = b" ".join([words[i] for i in np.flatnonzero(keep)])
                removed.append(int(len(words) - keep.sum()))
                shas.append(hashlib.sha256(line).hexdigest())
                kept_texts.append(line)
            cols = [b.column(0), pa.array(removed, pa.int64()), pa.array(shas, pa.string())]
            if keep_text:
                cols.append(pa.array(kept_texts, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.mapInArrow(run, "rid long, n_removed long, sha string" + ", kept_text string" * keep_text)


def substring_dedup(docs: DataFrame, *, window: int = 35, mer: int = 8, id_col: str = "doc_id",
                    text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Per row: the id, n_words, n_removed and kept_sha256 (of the kept words joined by one space).

    Removes every word that lies in a window whose words also start
    anywhere else, the same text included.  ``keep_text`` adds ``kept_text``: the kept words
    of the texts that lost any, else null (the text stands), and ``text_hash``.  A null text has no words.
    Texts shorter than a window lose nothing.  Repeated rows are texts of their
    own, so from ``window`` words on they repeat each other.  Other input columns are left out.

    Rows meet again by (id, hash of the text) where texts are fetched, so repeated rows share their
    spans, and null ids are told apart by their texts.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"),
                      F.xxhash64(text_col).alias("k"))
    scanned = cut(_scan(src, window, mer), "scan")
    rows = scanned.where("mini IS NULL").select("rid", "id", "k", F.col("n").alias("n_words"), "sha")
    kmers = scanned.where("mini IS NOT NULL").select("rid", "mini", "digest", "at", "n")

    # a minimiser met once repeats nothing; one digest for all its super-k-mers: every window repeats
    # (written, so that the join's sides are plain shuffles and a hot minimiser can be split)
    repeated = cut(kmers.groupBy("mini")
                   .agg(F.count("*").alias("c"), F.min("digest").alias("lo"), F.max("digest").alias("hi"))
                   .where("c > 1").select("mini", (F.col("lo") == F.col("hi")).alias("same")), "repeated")
    candidates = cut(kmers.select("rid", "mini", "at", "n").join(repeated, "mini"), "candidates")

    # the texts that hold any of them, by (id, text hash): one representative row a pair is enough
    wanted = cut(
        candidates.groupBy("rid").agg(F.collect_list(F.struct("mini", "at", "n", "same")).alias("kmers"))
        .join(rows.select("rid", "id", "k"), "rid"), "wanted")
    texts = src.where("t IS NOT NULL").join(
        wanted.select("id", "k").distinct().select(F.col("id").alias("_id"), F.col("k").alias("_k")),
        F.col("id").eqNullSafe(F.col("_id")) & (F.col("k") == F.col("_k"))).select("id", "k", "t")
    texts = cut(texts.dropDuplicates(["id", "k"]), "texts")

    def with_text(df: DataFrame) -> DataFrame:
        t = texts.select(F.col("id").alias("_id"), F.col("k").alias("_k"), "t")
        return df.join(t, F.col("id").eqNullSafe(F.col("_id")) & (F.col("k") == F.col("_k")))

    mixed = wanted.select("rid", "id", "k", F.filter("kmers", lambda x: ~x["same"]).alias("kmers")).where(
        "size(kmers) > 0")
    packed = cut(_pack(with_text(mixed).select("rid", "t", "kmers"), window)
                 .withColumn("pd", F.xxhash64("packed")), "packed")
    strings = packed.groupBy("mini", "pd", "packed").agg(F.count("*").alias("copies"))
    size = strings.groupBy("mini").agg(F.count("*").alias("s"), F.sum("copies").alias("c"))
    large = cut(size.where(F.col("s") > BUCKET_STRINGS).select("mini"), "large")
    if large.isEmpty():
        found = _count_buckets(strings, window)
    else:
        found = _count_buckets(strings.join(large, "mini", "left_anti"), window).unionByName(
            _count_rows(strings.join(large, "mini", "left_semi"), window))
    # back to the occurrences: each string's repeated windows, as spans of their documents
    # (written, as above, so that the occurrences of a string in many copies can be split)
    per_string = cut(found.groupBy("mini", "pd").agg(F.collect_list("off").alias("offs")), "repeats")
    spans = (packed.select("rid", "mini", "pd", "at").join(per_string, ["mini", "pd"])
             .select("rid", F.explode("offs").alias("off"), "at")
             .select("rid", (F.col("at") + F.col("off")).alias("at"), F.lit(1).cast("long").alias("n")))
    spans = spans.unionByName(candidates.where("same").select("rid", "at", "n"))
    by_text = (spans.groupBy("rid").agg(F.collect_list(F.struct("at", "n")).alias("spans"))
               .join(rows.select("rid", "id", "k"), "rid"))
    cleaned = _remove(with_text(by_text).select("rid", "t", "spans"), window, keep_text)
    out = rows.join(cleaned.withColumnRenamed("sha", "new_sha"), "rid", "left")
    return out.select(F.col("id").alias(id_col), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce("new_sha", "sha").alias("kept_sha256"),
                      *(["kept_text", F.col("k").alias("text_hash")] if keep_text else []))


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n_chars_col: str = "n_chars",
                   **options) -> DataFrame:
    """``docs`` without the words that ``substring_dedup`` removes; all rows and columns stay.

    Changed texts are their kept words joined by one space, with ``n_chars`` set anew (where there
    is such a column); other texts stay as they are.  A text that loses all its words is empty.
    """
    done = substring_dedup(docs, id_col=id_col, text_col=text_col, keep_text=True, **options)
    changed = (done.where("n_removed > 0").dropDuplicates([id_col, "text_hash"])
               .select(F.col(id_col).alias("_id"), F.col("text_hash").alias("_k"), F.col("kept_text").alias("_kept")))
    rows = docs.withColumn("_text_hash", F.xxhash64(text_col))
    joined = rows.join(changed, rows[id_col].eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_k")), "left")
    new = {text_col: F.coalesce("_kept", F.col(text_col))}
    if n_chars_col in docs.columns:
        new[n_chars_col] = (F.when(F.col("_kept").isNotNull(), F.length("_kept")).otherwise(F.col(n_chars_col))
                            .cast(docs.schema[n_chars_col].dataType))
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])
