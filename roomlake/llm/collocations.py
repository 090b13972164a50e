"""Phrase collocations: contiguous word phrases that occur together more often than their parts suggest.

Texts are cut into shards (a few MB of one language).  A shard's distinct words are shuffled once: sorted by word, their
counts are added up, the words that occur often enough get numbers, and the numbers go back to the shards.  Phrases are
counted length by length: a phrase of n words is packed as (number of its first n - 1 words, number of its last word), in as
many bits as there are numbers, since a frequent phrase has a frequent beginning and a frequent end.  A shard keeps its counts in counting quotient filters (``quotient.py``): the packed phrase is permuted invertibly,
its leading bits choose the range, the filter holds quotients and whole remainders.  Ranges are even whatever the phrases
are, a phrase that fills the corpus is one entry a shard, and each range merges its shards' sorted filters in one task
of bounded size.  Frequent phrases get numbers of their own, which go back to the shards that hold them, for the
next length.  All later steps (parts, scores, covered phrases, ranks) are joins and aggregations over frequent phrases.

Tables between the steps are written to the shared folder and removed when the next one is written.

Defined results: a null text is empty, a null language ``und`` (with rows of that name); repeated rows count each; ids are not
used; an empty table has no phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomlake.llm import quotient as cqf
from roomlake.llm.common import cut, release

SHARD_BYTES = 8 << 20          # text of one shard
RANGE_WORDS = 1 << 21          # words of the corpus a range stands for
HELD_ROWS = 1 << 20            # words of shards that a task gathers before it sends their numbers back
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
SPACES = b"\x20\x09"
#: rows with large binary values: small row groups, so that readers and writers hold few of them
BLOBS = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 8}

_IS_BREAK = np.zeros(256, dtype=bool)
_IS_BREAK[list(BREAKS)] = True
_IS_WORD = ~_IS_BREAK
_IS_WORD[list(SPACES)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

_WORDS = "shard long, lang string, pos int, word string, n long, seq binary"
_SLICES = "shard long, range int, n long, data binary, grams binary"


def _pack(a: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(a).tobytes(), 1)


def _unpack(data: bytes, dtype=np.uint32) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype=dtype)


def shard_words(data: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(words, ids) of text bytes: the distinct words, and per word its place + 1, with 0 between pieces."""
    inside = _IS_WORD[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    at = np.flatnonzero(start)
    place = np.cumsum(inside, dtype=np.int64)
    bounds = np.append(place[at] - 1, place[-1] if len(place) else 0)
    words = pa.Array.from_buffers(pa.large_binary(), len(at),
                                  [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(_LOWER[data[inside]])])
    coded = words.dictionary_encode()
    piece = np.cumsum(_IS_BREAK[data], dtype=np.int32)[at]
    shift = np.zeros(len(at), dtype=np.int64)
    shift[1:] = np.cumsum(piece[1:] != piece[:-1])
    ids = np.zeros(len(at) + (int(shift[-1]) if len(at) else 0), dtype=np.uint32)
    ids[np.arange(len(at)) + shift] = coded.indices.to_numpy(zero_copy_only=False).astype(np.uint32) + 1
    return coded.dictionary, ids


def _shards(shard_bytes: int):
    """(lang, text) -> a row per distinct word of a shard, and one with the shard's word sequence."""
    def rows(number: int, lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        words, ids = shard_words(np.frombuffer(b"\n".join(texts), dtype=np.uint8))
        k = len(words)
        if k:
            counts = np.bincount(ids, minlength=k + 1)[1:]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(k + 1, number)), pa.array([lang] * (k + 1), pa.string()),
                pa.array(np.arange(-1, k), pa.int32()),
                pa.concat_arrays([pa.nulls(1, pa.large_string()), words.cast(pa.large_string())]).cast(pa.string()),
                pa.array(np.concatenate([[0], counts]), pa.int64()),
                pa.array([_pack(ids)] + [None] * k, pa.binary())],
                names=["shard", "lang", "pos", "word", "n", "seq"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                if not raw:
                    continue
                held.setdefault(lang, []).append(raw)
                size[lang] = size.get(lang, 0) + len(raw) + 1
                full = lang if size[lang] >= shard_bytes else None
                if full is None and sum(size.values()) >= 2 * shard_bytes:      # many languages in one task
                    full = max(size, key=size.get)
                if full is not None:
                    size.pop(full)
                    yield from rows(number, full, held.pop(full))
                    number += 1
        for lang, texts in held.items():
            yield from rows(number, lang, texts)
            number += 1
    return run


class Packing:
    """How the phrases of one length are packed and dealt: bits of a key, of its last word, and of a range."""

    def __init__(self, prefixes: int, words: int, range_bits: int):
        self.word_bits = max(int(words).bit_length(), 1)
        self.bits = self.word_bits + max(int(prefixes).bit_length(), 1)
        if self.bits > 64:
            raise OverflowError(f"{prefixes} beginnings and {words} words: phrases do not pack into 64 bits")
        self.range_bits = min(range_bits, self.bits)

    def keys(self, grams: np.ndarray, last: np.ndarray) -> np.ndarray:
        return cqf.permute((grams.astype(np.uint64) << np.uint64(self.word_bits)) | last.astype(np.uint64), self.bits)

    def parts(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = cqf.restore(x, self.bits)
        return (key >> np.uint64(self.word_bits)).astype(np.int64), (key & np.uint64((1 << self.word_bits) - 1)).astype(np.int64)


def _slices(shard: int, n: int, words: np.ndarray, grams: np.ndarray, how: Packing,
            last: bool) -> Iterator[pa.RecordBatch]:
    """A shard's filters of its n-word phrases, and (but for the last length) its sequences for the next one."""
    whole = (grams[:-1] != 0) & (grams[1:] != 0)
    at = np.flatnonzero(whole[:max(len(grams) - n + 1, 0)])
    if not len(at):
        return
    x, counts = np.unique(how.keys(grams[at], words[at + n - 1]), return_counts=True)
    bounds = np.searchsorted(cqf.range_of(x, how.range_bits, how.bits), np.arange((1 << how.range_bits) + 1))
    rows = [(shard, r, int(b - a), cqf.encode(x[a:b], counts[a:b], how.range_bits, how.bits), None)
            for r, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if b > a]
    if not last:
        used = np.zeros(len(words), dtype=bool)        # words outside these phrases are not needed again
        for k in range(n):
            used[at + k] = True
        sequence = _pack(np.where(used, words, 0))
        # pairs begin where two words meet: no second sequence
        rows.insert(0, (shard, -1, 0, sequence, None if n == 2 else _pack(np.where(whole_at(at, len(grams)), grams, 0))))
    yield _batch(rows)


def whole_at(at: np.ndarray, n: int) -> np.ndarray:
    mask = np.zeros(n, dtype=bool)
    mask[at] = True
    return mask


def _batch(rows: list) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    cols = zip(*rows) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)],
                                      names=["shard", "range", "n", "data", "grams"])


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
    """Consecutive rows of one shard; the first holds its sequence."""
    shard, rows = None, []
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = np.append(np.flatnonzero(np.diff(ids, prepend=ids[0] - 1 if len(ids) else 0)), len(ids))
        for a, b in zip(cuts[:-1], cuts[1:]):
            if shard is not None and ids[a] != shard:
                yield shard, rows
                rows = []
            shard = int(ids[a])
            rows.append(batch.slice(a, b - a))
    if shard is not None:
        yield shard, rows


def _count_words(min_count: int):
    """Rows (lang, word, shard, pos, n) sorted by word -> numbers of the frequent words, and per shard where it holds them.

    A word's rows (one a shard at most) are added up as they pass; those of the batch's last word wait for the next batch.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known, rest = TaskContext.get().partitionId(), 0, None
        held: list[tuple] = []                         # (shards, places, numbers) not sent yet

        def send() -> Iterator[pa.RecordBatch]:
            shard, pos, number = (np.concatenate(c) for c in zip(*held))
            held.clear()
            order = np.argsort(shard, kind="stable")
            shard, pos, number = shard[order], pos[order], number[order]
            cuts = np.append(np.flatnonzero(np.diff(shard, prepend=shard[0] - 1)), len(shard)).tolist()
            packed = [_pack(np.stack([pos[a:b], number[a:b]]).astype(np.uint32)) for a, b in zip(cuts[:-1], cuts[1:])]
            yield _word_batch(part, len(packed), shard=shard[cuts[:-1]], data=pa.array(packed, pa.binary()))

        def numbered(t: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal known
            lang, word, shard, pos, n = (c.combine_chunks() for c in t.columns)
            starts = np.flatnonzero(_changes(lang) | _changes(word))
            total = np.add.reduceat(n.to_numpy(), starts)
            frequent = total >= min_count
            number = known + np.cumsum(frequent)
            known += int(frequent.sum())
            first = pa.array(starts[frequent])
            yield _word_batch(part, len(first), lang=lang.take(first), word=word.take(first), a=total[frequent],
                              number=number[frequent])
            of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(n))))
            rows = np.flatnonzero(frequent[of])
            if len(rows):
                held.append((shard.to_numpy()[rows], pos.to_numpy()[rows], number[of[rows]]))
            if sum(len(h[0]) for h in held) >= HELD_ROWS:
                yield from send()

        for batch in batches:
            t = pa.Table.from_batches([batch])
            rest = t if rest is None else pa.concat_tables([rest, t])
            lang, word = (rest.column(i).combine_chunks() for i in (0, 1))
            begins = np.flatnonzero(_changes(lang) | _changes(word))
            if len(begins) > 1:
                yield from numbered(rest.slice(0, begins[-1]))
                rest = rest.slice(begins[-1])
        if rest is not None and rest.num_rows:
            yield from numbered(rest)
        if held:
            yield from send()
    return run


def _changes(column: pa.Array) -> np.ndarray:
    """Rows that differ from the one before."""
    out = np.ones(len(column), dtype=bool)
    if len(column) > 1:
        out[1:] = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return out


_NUMBERS = "part int, lang string, word string, a long, number long, shard long, data binary"


def _word_batch(part: int, n: int, **columns) -> pa.RecordBatch:
    types = {"lang": pa.string(), "word": pa.string(), "a": pa.int64(), "number": pa.int64(), "shard": pa.int64(), "data": pa.binary()}
    out = [pa.array(np.full(n, part), pa.int32())]
    for name, t in types.items():
        v = columns.get(name)
        out.append(pa.nulls(n, t) if v is None else pa.array(v, t) if isinstance(v, np.ndarray) else v.cast(t))
    return pa.RecordBatch.from_arrays(out, names=["part", *types])


def _number_words(offsets: np.ndarray, how: Packing, last: bool):
    """Rows (shard, part, data), the sequence first -> the shard's numbered words and filters of its word pairs."""
    def run(batches):
        for shard, rows in _by_shard(batches):
            if rows[0].column(1)[0].as_py() != -1:
                raise ValueError(f"shard {shard} has words but no sequence")
            ids = _unpack(rows[0].column(2)[0].as_py())
            table = np.zeros(int(ids.max()) + 1, dtype=np.uint32)
            for r in rows:
                for part, data in zip(r.column(1).to_pylist(), r.column(2)):
                    if part >= 0:
                        pos, number = _unpack(data.as_py()).reshape(2, -1)
                        table[pos.astype(np.int64) + 1] = number + np.uint32(offsets[part])
            words = table[ids]
            yield from _slices(shard, 2, words, words, how, last)
    return run


def _merge_range(min_count: int, how: Packing):
    """All shards' filters of one range -> its frequent phrases, and per shard those that it holds."""
    def run(table: pa.Table) -> pa.Table:
        range_id = table.column("range")[0].as_py()
        shards = table.column("shard").to_pylist()
        filters = [cqf.decode(d.as_py(), range_id) for d in table.column("data")]
        x, total, place = cqf.merge(filters)
        frequent = total >= min_count
        number = np.cumsum(frequent)                   # from 1, within the range
        rows = [(-1, range_id, int(frequent.sum()), cqf.encode(x[frequent], total[frequent], how.range_bits, how.bits), None)]
        at = 0
        for shard, (own, _) in zip(shards, filters):
            mine = place[at:at + len(own)]
            at += len(own)
            keep = frequent[mine]
            if keep.any():                             # numbers rise with the keys: their steps fit the counters
                steps = np.diff(number[mine[keep]], prepend=0)
                rows.append((shard, range_id, 0, cqf.encode(own[keep], steps, how.range_bits, how.bits), None))
        return pa.Table.from_batches([_batch(rows)])
    return run


def _number_phrases(n: int, offsets: np.ndarray, before: Packing, how: Packing, last: bool):
    """A shard's sequences and its frequent (n - 1)-word phrases -> filters of its n-word phrases."""
    def run(batches):
        for shard, rows in _by_shard(batches):
            if rows[0].column(1)[0].as_py() != -1:
                raise ValueError(f"shard {shard} has phrases but no sequence")
            words, grams = _unpack(rows[0].column(3)[0].as_py()), rows[0].column(4)[0].as_py()
            if grams is None:
                grams = np.where(np.append(words[1:] != 0, False), words, 0)
            else:
                grams = _unpack(grams)
            keys, ids = [], []
            for r in rows:
                for range_id, data in zip(r.column(1).to_pylist(), r.column(3)):
                    if range_id >= 0:
                        x, steps = cqf.decode(data.as_py(), range_id)
                        keys.append(x)
                        ids.append(np.cumsum(steps) + offsets[range_id])
            if not keys:
                continue
            keys, ids = np.concatenate(keys), np.concatenate(ids)      # ranges in order: sorted
            at = np.flatnonzero(grams)
            key = before.keys(grams[at], words[at + n - 2])
            where = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            new = np.zeros(len(grams), dtype=np.uint32)
            new[at] = np.where(keys[where] == key, ids[where], 0)
            yield from _slices(shard, n, words, new, how, last)
    return run


def _list_phrases(offsets: np.ndarray, how: Packing):
    """Frequent phrases of each range -> (id, prefix id, last word id, count)."""
    def run(batches):
        for batch in batches:
            for range_id, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                x, counts = cqf.decode(data.as_py(), range_id)
                prefix, last = how.parts(x)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(1, len(x) + 1) + offsets[range_id]), pa.array(prefix), pa.array(last), pa.array(counts)],
                    names=["id", "prefix", "last", "a"])
    return run


def _offsets(sizes: list, ranges: int, what: str) -> tuple[np.ndarray, int]:
    """(numbers given before each range, numbers given in all), from (range, size) rows."""
    n = np.zeros(ranges, dtype=np.int64)
    for r, size in sizes:
        n[r] = size
    if n.sum() >= 1 << 32:
        raise OverflowError(f"{n.sum()} frequent {what}: more than 32-bit numbers can name")
    return np.concatenate([[0], np.cumsum(n)[:-1]]), int(n.sum())


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 5,
                     min_count: int = 100, shard_bytes: int = SHARD_BYTES,
                     range_words: int = RANGE_WORDS) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): (lang, size, phrase, a) of every phrase of one to ``max_words`` words that occurs
    ``min_count`` times or more in its language, and (lang, n) the number of all its word occurrences."""
    if min_count < 1 or max_words < 1:
        raise ValueError("min_count and max_words start at 1")
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    shards = cut(docs.select(lang.alias("lang"), F.col(text_col).cast("string").alias("text")).mapInArrow(_shards(shard_bytes), _WORDS),
                 "phrase-shards", **BLOBS)
    words = shards.where(F.col("word").isNotNull())
    totals = cut(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    total = totals.agg(F.sum("n")).first()[0] or 0
    range_bits = max(0, int(-(-total // range_words) - 1).bit_length())

    numbers = cut(words.select("lang", "word", "shard", "pos", "n").repartition("lang", "word")
                       .sortWithinPartitions("lang", "word").mapInArrow(_count_words(min_count), _NUMBERS), "phrase-words")
    named = numbers.where(F.col("word").isNotNull())
    sizes = named.groupBy("part").agg(F.max("number")).collect()                 # a row a partition
    before, n_words = _offsets(sizes, max([p for p, _ in sizes], default=0) + 1, "words")
    starts = F.array(*[F.lit(int(b)) for b in before])
    number = (F.get(starts, F.col("part")) + F.col("number")).alias("id")
    levels = [named.select("lang", number, F.lit(1).alias("size"), F.col("word").alias("phrase"), "a")]

    # word numbers go back to the shards; a shard's sequence sorts before them
    placed = numbers.where(F.col("shard").isNotNull()).select("shard", "part", "data")
    parts = shards.where(F.col("seq").isNotNull()).select("shard", F.lit(-1).alias("part"), F.col("seq").alias("data"))
    how = Packing(n_words, n_words, range_bits)
    work = (parts.unionByName(placed).repartition("shard").sortWithinPartitions("shard", "part")
                 .mapInArrow(_number_words(before, how, max_words == 2), _SLICES))
    previous = [shards]
    for n in range(2, max_words + 1):
        work = cut(work, f"phrase-filters-{n}", **BLOBS)
        release(*previous)
        merged = cut(work.where(F.col("range") >= 0).groupBy("range").applyInArrow(_merge_range(min_count, how), _SLICES),
                     f"phrase-merged-{n}", **BLOBS)
        found = merged.where(F.col("shard") == -1)
        offsets, n_found = _offsets(found.select("range", "n").collect(), 1 << how.range_bits, "phrases")
        rows = found.select("range", "data").mapInArrow(_list_phrases(offsets, how), "id long, prefix long, last long, a long")
        head = levels[-1].select(F.col("id").alias("prefix"), "lang", F.col("phrase").alias("head"))
        tail = levels[0].select(F.col("id").alias("last"), F.col("phrase").alias("tail"))
        levels.append(cut(rows.join(head, "prefix").join(tail, "last").select(
            "lang", "id", F.lit(n).alias("size"), F.concat_ws(" ", "head", "tail").alias("phrase"), "a"), f"phrases-{n}"))
        previous = [work, merged]
        if n < max_words:
            following = Packing(n_found, n_words, range_bits)
            back = work.where(F.col("range") == -1).unionByName(merged.where(F.col("shard") >= 0))
            work = (back.repartition("shard").sortWithinPartitions("shard", "range")
                        .mapInArrow(_number_phrases(n + 1, offsets, how, following, n + 1 == max_words), _SLICES))
            how = following
    release(*previous)
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out.select("lang", "size", "phrase", "a"), totals


def scored_phrases(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, size, phrase, a, l, r, n, score) of all phrases of two words or more that no longer one covers.

    The cut with the lowest score counts, among equals the first.  Products are decimals of 38 digits: exact.
    """
    long_ones = phrases.where(F.col("size") >= 2)
    w = F.split("phrase", " ")
    join = lambda a: F.array_join(a, " ")
    # an extension by one word that occurs as often covers a phrase; a longer one implies such an extension
    cover = (long_ones.where(F.col("size") >= 3)
             .select("lang", F.explode(F.array(join(F.slice(w, F.lit(1), F.col("size") - 1)),
                                               join(F.slice(w, F.lit(2), F.col("size") - 1)))).alias("phrase"), F.col("a").alias("b"))
             .groupBy("lang", "phrase").agg(F.max("b").alias("b")))
    kept = (long_ones.join(cover, ["lang", "phrase"], "left")
                     .where(F.col("b").isNull() | (100 * F.col("b") < 100 * F.col("a"))).drop("b"))
    cuts = (kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
                .withColumn("left", join(F.slice(w, F.lit(1), F.col("k"))))
                .withColumn("right", join(F.slice(w, F.col("k") + 1, F.col("size") - F.col("k")))))
    f = phrases.select("lang", "phrase", "a")
    parts = (cuts.join(f.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
                 .join(f.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
                 .join(totals, "lang"))
    d = lambda c, p=19: F.col(c).cast(f"decimal({p},0)")
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * d("a", 16) * d("n", 16), d("l", 18) * d("r", 18))
    best = parts.withColumn("score", score.cast("long")).groupBy("lang", "size", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("s"))
    return best.select("lang", "size", "phrase", "a", "s.l", "s.r", "n", "s.score")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 5,
                 min_count: int = 100, top: int = 2000, **sizes) -> DataFrame:
    """Each language's ``top`` collocations: (lang, rank, phrase, a, l, r, n, score), numbers as longs."""
    phrases, totals = frequent_phrases(docs, text_col, lang_col, max_words, min_count, **sizes)
    scored = cut(scored_phrases(phrases, totals), "phrase-scores")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # a language may hold most phrases: rank its parts first
    parts = max(1, -(-scored.count() // 100_000))
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    first = (scored.withColumn("_part", part)
                   .withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
                   .where(F.col("_rank") <= top))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return (first.withColumn("rank", rank).where(F.col("rank") <= top)
                 .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
