"""Best-fit packing (operator 1) with certified bin counts.

Documents become token pieces of at most ``capacity``; pieces are dealt to
groups of a set size and every group is packed by best-fit decreasing.  Lower
bounds from dual feasible functions (the Martello-Toth thresholds and the
staircase functions ``u(k)``) certify a group whose bin count equals its bound.
Dual feasible functions add up, so the same bound over the length counts of all
pieces tells how far the whole packing is from the optimum.  While it is above
that bound, the bins with gaps of all groups exchange documents: they are
dealt anew, so that each new group mixes bins of many old ones, and packed again, until
a round saves no bin.
"""

from __future__ import annotations

import json
import logging
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomlake.llm.common import SEPARATORS, Memo, chunks, cut, texts, tokenizer_path, word_bounds

CACHE_WORDS = 240_000
SLICE_CHARS = 2_000_000     # text whose words are numbered together
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_ALNUM, _MARK = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_ALNUM[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_MARK[list(b".,;:!?")] = True


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level tokenizers write for each byte: itself where printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + k)
    return out


class WordEncoder:
    """Token ids of texts by a tokenizer that drops white space: each distinct word once, with a bounded cache.

    White space is removed before any merge, so the ids of a text are the ids
    of its space-separated words laid end to end.  Where the file is of the usual kind (NFC, lower case,
    one split pattern, byte-level letters), a printable Latin-1 word is split by that pattern here and
    the tokenizer's merge model is called on its parts; any other word takes the whole tokenizer.
    Words are found, numbered and laid out again for a slice of texts at a time, without a step per word.
    """

    def __init__(self, name: str):
        from tokenizers import Tokenizer

        path = tokenizer_path(name)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.young, self.old = {}, {}          # words met lately, and those before them: bytes -> ids
        self.parts = Memo(CACHE_WORDS // 2)
        self.pattern = self._split_pattern(path)
        self.letters = _byte_letters()

    @staticmethod
    def _split_pattern(path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        try:
            split, letters = spec["pre_tokenizer"]["pretokenizers"]
            names = [n["type"] for n in spec["normalizer"]["normalizers"]]
            usual = (names == ["NFC", "Replace", "Lowercase"] and split["type"] == "Split" and split["invert"]
                     and split["behavior"] == "Removed" and letters["type"] == "ByteLevel"
                     and not letters["add_prefix_space"] and not letters["use_regex"]
                     and all(t["content"].startswith("<|") for t in spec["added_tokens"]))
            return regex.compile(split["pattern"]["Regex"]) if usual else None
        except (KeyError, TypeError, ValueError):
            return None

    def _merged(self, part: str) -> bytes:
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = self._merged(part)
            if len(self.parts) >= self.parts.limit:
                self.parts.clear()
            if len(part) <= self.parts.longest:
                self.parts[part] = ids
        return ids

    def _encode(self, words: list[str]) -> list[bytes]:
        out, pattern = [], self.pattern
        for w in words:
            if pattern and w.isalpha() and (w.isascii() or max(w) <= "\xff"):
                out.append(self._merged(w.lower()))          # one part
            elif pattern and w.isprintable() and (w.isascii() or max(w) <= "\xff") and "<|" not in w:
                out.append(b"".join(map(self._part, pattern.findall(w.lower()))))
            else:
                out.append(array("I", self.tokenizer.encode(w, add_special_tokens=False).ids).tobytes())
        return out

    def _plainer(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray):
        """Fewer distinct words, same ids: A-Z in lower case, and a mark at a word's end apart from the letter or digit before.

        The pattern begins a new part there, and merges stay within parts.  Texts that may hold a special token stay as they are.
        """
        if ((data[:-1] == ord("<")) & (data[1:] == ord("|"))).any():
            return data, starts, stops
        data = _LOWER[data]
        end = stops[stops - starts > 1] - 1
        end = end[_MARK[data[end]] & _ALNUM[data[end - 1]]]
        return data, np.sort(np.concatenate([starts, end])), np.sort(np.concatenate([stops, end]))

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words; those not met lately are encoded, and the cache forgets its older half when full."""
        young, old = self.young, self.old
        out = [young.get(w) or old.get(w) for w in words]
        missing = [i for i, v in enumerate(out) if v is None]
        for i, ids in zip(missing, self._encode([words[i].decode() for i in missing])):
            out[i] = ids
        for w, ids in zip(words, out):
            if w not in young and len(w) <= 64:
                if len(young) >= CACHE_WORDS // 2:
                    self.old = old = young
                    self.young = young = {}
                young[w] = ids
        return out

    def texts(self, rows: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        for a, b in chunks(rows, len, SLICE_CHARS):
            raw = [t.encode() for t in rows[a:b]]
            data = np.frombuffer(b"".join(raw), dtype=np.uint8)
            ends = np.cumsum([len(t) for t in raw])
            starts, stops = word_bounds(data, ends[:-1])
            if self.pattern:
                data, starts, stops = self._plainer(data, starts, stops)
            size = stops - starts
            inside = np.ones(len(data), dtype=bool)
            inside[np.isin(data, np.frombuffer(SEPARATORS, np.uint8))] = False
            bounds = np.concatenate([[0], np.cumsum(size)])
            words = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(bounds), pa.py_buffer(data[inside])])
            coded = words.dictionary_encode()
            ids = self._ids(coded.dictionary.to_pylist())
            flat = np.frombuffer(b"".join(ids), dtype="<u4")
            n = np.array([len(v) // 4 for v in ids], dtype=np.int64)
            of = coded.indices.to_numpy(zero_copy_only=False)
            each = n[of]
            last = np.cumsum(each)
            place = np.repeat((np.cumsum(n) - n)[of] - (last - each), each) + np.arange(last[-1] if len(last) else 0)
            out = flat[place]
            cut_at = np.concatenate([[0], last])[np.searchsorted(starts, ends)]      # tokens of the texts before and this one
            at = 0
            for to in cut_at.tolist():
                yield out[at:to].tobytes()
                at = to


_encoders: dict[str, WordEncoder] = {}


def token_pieces(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", *, end_id: int = 1, capacity: int = 4096,
                 id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: ids of each whole text, then ``end_id``.

    Columns: the id, piece, start, length, ids_crc32 and ``slot`` (a number of
    its own for every piece; ``keep_ids`` adds ``ids``, the token ids as
    little-endian 32-bit binary).  A null text is an empty one: a single piece
    holding only ``end_id``.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    fields = [T.StructField(id_col, src.schema["id"].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType()), T.StructField("slot", T.LongType())]
    if keep_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    step, end = 4 * capacity, np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _encoders:
            _encoders[tokenizer] = WordEncoder(tokenizer)
        slot = (TaskContext.get().partitionId() << 36)
        for b in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, data in enumerate(_encoders[tokenizer].texts(texts(b.column(1)))):
                data += end
                for k, a in enumerate(range(0, len(data), step)):
                    part = data[a:a + step]
                    row.append(i)
                    piece.append(k)
                    start.append(a // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(part)
            cols = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                    pa.array(range(slot, slot + len(row)), pa.int64())]
            slot += len(row)
            if keep_ids:
                cols.append(pa.array(ids, pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    return src.mapInArrow(run, T.StructType(fields))


def bin_lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that no packing can go below; ``counts[x]`` pieces have length ``x`` (0..capacity).

    The best of: the lengths' sum over the capacity; Martello-Toth's bound
    at every threshold; and the staircase functions ``u(k)`` for k up to 20.
    """
    c = np.asarray(counts, dtype=np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    total = int((c * x).sum())
    best = -(-total // capacity)
    n_upto, len_upto = np.cumsum(c), np.cumsum(c * x)
    for alpha in range(1, capacity // 2 + 1):
        # longer than capacity - alpha: one each; shorter than alpha: nothing; between: their length
        large = int(n_upto[capacity] - n_upto[capacity - alpha])
        middle = int(len_upto[capacity - alpha] - len_upto[alpha - 1])
        best = max(best, large + -(-middle // capacity))
    for k in range(1, 21):
        whole = (k + 1) * x % capacity == 0
        # u(k) times capacity * k, kept in integers
        u = np.where(whole, k * x, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((c * u).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset of each piece and free space of each bin.

    Longest first, each into the fullest bin that still takes it.  Bins are
    kept by their gap; a bit mask over the gaps finds the smallest that fits.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps, free = 0, []
    for i in order:
        size = int(lengths[i])
        above = gaps >> size
        if above:
            gap = size + (above & -above).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps ^= 1 << gap
        else:
            gap, b = capacity, len(free)
            free.append(capacity)
        bins[i], offsets[i] = b, capacity - gap
        gap -= size
        free[b] = gap
        if gap:
            if not by_gap[gap]:
                gaps |= 1 << gap
            by_gap[gap].append(b)
    return bins, offsets, np.array(free, dtype=np.int64)


def _pack_groups(pieces: DataFrame, columns: list[str], key, group_size: int, n: int, capacity: int) -> DataFrame:
    """Deal pieces to groups by ``key`` (whole keys stay together) and pack each group."""
    groups = max(1, -(-n // group_size))
    kinds = {f.name: f.dataType for f in pieces.schema.fields}
    schema = T.StructType([*[T.StructField(c, kinds[c]) for c in columns],
                           T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
                           T.StructField("free", T.LongType()), T.StructField("certified", T.BooleanType())])

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("slot", kind="stable").reset_index(drop=True)
        lengths = pdf["length"].to_numpy()
        bins, offsets, free = best_fit_decreasing(lengths, capacity)
        bound = bin_lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        first = np.flatnonzero(offsets == 0)           # every bin's first piece names the sequence
        names = np.empty(len(free), np.int64)
        names[bins[first]] = pdf["slot"].to_numpy()[first]
        return pdf[columns].assign(sequence_id=names[bins], offset=offsets, free=free[bins],
                                   certified=len(free) == bound)

    dealt = pieces.select(*columns, F.pmod(F.xxhash64(key), F.lit(groups)).alias("_group"))
    return dealt.groupBy("_group").applyInPandas(pack, schema)


def _bins(packed: DataFrame) -> int:
    return packed.filter(F.col("offset") == 0).count()


def best_fit_pack(pieces: DataFrame, *, capacity: int = 4096, group_size: int = 20_000,
                  rounds: int | None = None) -> DataFrame:
    """Pack pieces (``slot`` unique, ``length`` 1..capacity) into sequences of at most ``capacity``.

    Adds sequence_id, offset, ``free`` (the sequence's unused tokens) and
    ``certified`` (its group reached its lower bound).  All input columns and
    rows stay.  A group holds about ``group_size`` pieces of a few numbers each, at any input size.  Bins with
    gaps are exchanged until the global bound is reached or a round saves no bin; ``rounds`` may
    bound the exchanges.  The log tells the bins against the bound.  An empty table packs into an empty one.
    """
    columns = pieces.columns
    by_length = pieces.groupBy("length").count().collect()      # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, np.int64)
    for r in by_length:
        if not 1 <= r["length"] <= capacity:
            raise ValueError(f"a piece of {r['length']} tokens does not fit a sequence of {capacity}")
        counts[r["length"]] = r["count"]
    bound = bin_lower_bound(counts, capacity)
    full = pieces.filter(F.col("length") == capacity).select(
        *columns, F.col("slot").alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.lit(0).cast("long").alias("free"), F.lit(True).alias("certified"))
    open_ = pieces.filter(F.col("length") < capacity)
    n = int(counts[:capacity].sum())
    packed = cut(_pack_groups(open_, columns, F.col("slot"), group_size, n, capacity), "packed")
    total = _bins(packed) + int(counts[capacity])
    round_ = 0
    while rounds is None or round_ < rounds:
        gappy = packed.filter(F.col("free") > 0)
        k = gappy.count()
        if total <= bound or k == 0:
            break
        again = cut(_pack_groups(gappy, columns, F.struct("sequence_id", F.lit(round_)), group_size, k, capacity),
                    "repacked")
        gain = _bins(gappy) - _bins(again)
        if gain <= 0:
            break
        packed = cut(packed.filter(F.col("free") == 0).unionByName(again), "packed")
        total -= gain
        round_ += 1
    logging.getLogger(__name__).info("%d sequences, bound %d, %d exchanges with gain", total, bound, round_)
    return full.unionByName(packed)


def pack_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", *, end_id: int = 1, capacity: int = 4096,
                   group_size: int = 20_000, rounds: int | None = None, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Tokenise ``docs`` once, cut texts over ``capacity`` into pieces and pack all pieces.

    Null text: empty, a piece of ``end_id`` alone.  Repeated rows are packed
    each; extra columns are left out.  The pieces (numbers only) are written to
    the shared folder, so texts are read and tokenised once.
    """
    pieces = cut(token_pieces(docs, tokenizer, end_id=end_id, capacity=capacity, id_col=id_col, text_col=text_col),
                 "pieces")
    return best_fit_pack(pieces, capacity=capacity, group_size=group_size, rounds=rounds).drop("slot")
