"""Token counts (operator 3): prefix dynamic programming over BPE pieces.

A BPE token sequence is the encoding of its text exactly when every two
neighbouring tokens are (the encoding of their joined text is those two
tokens).  So the encoding of a prefix of length ``i`` is the encoding of a
shorter prefix plus one last token that is compatible with the last token
there: ``count[i] = count[j] + 1``.  One pass over a text gives the exact count
of *every* prefix, and truncation or budget questions are answered from those
counts without encoding again.

No piece spans a word and the marker of the next one, so the programme runs
once per distinct word of a task and a text's counts are the running sum of
its words' counts.  They are stored as one signed byte per code point (how the
count changes when the prefix grows by it).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomlake.llm.common import Memo, texts, tokenizer_path

MARK = "▁"
CACHE_WORDS = 300_000
_INF = float("inf")
_RUNS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class PrefixCounter:
    """Prefix counts by the vocabulary of one sentencepiece BPE model."""

    def __init__(self, model: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(tokenizer_path(model), "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        kinds = {p.type for p in proto.pieces}
        if (proto.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces
                or not norm.add_dummy_prefix or not norm.escape_whitespaces or 4 in kinds or 5 in kinds
                or proto.trainer_spec.treat_whitespace_as_suffix):
            raise ValueError("needs a BPE model with the identity normaliser, a dummy prefix and plain pieces")
        # a lower rank merges first; equal scores share a rank and then the leftmost pair goes first
        scores = sorted({p.score for p in proto.pieces if p.type == 1}, reverse=True)
        order = {s: i for i, s in enumerate(scores)}
        self.rank = {p.piece: order[p.score] for p in proto.pieces if p.type == 1}
        if any(MARK in p[1:].lstrip(MARK) for p in self.rank if p[0] == MARK) or \
                any(MARK in p for p in self.rank if p[0] != MARK):
            raise ValueError("a piece spans two words")
        self.bytes_known = 6 in kinds
        self.left: dict[str, str] = {}                 # how a piece is made: its left and right part
        self.right: dict[str, str] = {}
        self.pieces = set()
        for piece in self.rank:
            parts = self._halves(piece)
            if parts is None:
                continue                               # merges never make it
            self.pieces.add(piece)
            if len(piece) > 1:
                self.left[piece], self.right[piece] = parts
        self.names = sorted(self.pieces)
        self.matcher = ahocorasick.Automaton()
        for i, piece in enumerate(self.names):
            self.matcher.add_word(piece, (len(piece), i))
        self.matcher.make_automaton()
        self._pairs: dict[int, bool] = {}              # a * len(names) + b -> compatible
        self.cache = Memo(CACHE_WORDS)

    def _halves(self, piece: str):
        """The last merge that makes ``piece``, or None where the merges end otherwise."""
        parts = list(piece)
        while len(parts) > 2:
            ranks = [self.rank.get(a + b, _INF) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best == _INF:
                return None
            i = ranks.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return tuple(parts) if len(parts) < 2 or "".join(parts) in self.rank else None

    def _spine(self, piece: str, side: dict[str, str]) -> list[tuple[str, float]]:
        """The parts of ``piece`` along one edge, smallest first, each with the rank that absorbs it."""
        out, absorbed = [(piece, _INF)], piece
        while absorbed in side:
            part = side[absorbed]
            out.append((part, self.rank[absorbed]))
            absorbed = part
        return out[::-1]

    def compatible(self, a: str, b: str) -> bool:
        """Whether the text a + b is encoded as just these two pieces.

        Walks the merges along the seam in rank order: ``a``'s right edge and
        ``b``'s left edge grow piece by piece, and the two stay apart only if
        no merge across the seam comes before the one that absorbs either edge.
        """
        xs, ys = self._spine(a, self.right), self._spine(b, self.left)
        i = j = 0
        while True:
            (x, rx), (y, ry) = xs[i], ys[j]
            across = self.rank.get(x + y, _INF)
            if across < rx and across <= ry:
                return False                           # the edge parts merge with each other first
            if rx == _INF and ry == _INF:
                return True
            if rx <= ry:
                i += 1
            else:
                j += 1

    def word(self, w: str) -> bytes:
        """The change of the token count at each code point of one word (marker included)."""
        n, names, pairs = len(w), self.names, self._pairs
        size = len(names)
        count, last = [0] * (n + 1), [-2] * (n + 1)    # last piece of each prefix; -1: nothing merges with it
        last[0] = -1
        at = 0                                         # prefixes up to here are settled
        for end, (length, piece) in self.matcher.iter(w):
            if at > end:
                continue
            while at < end:                            # no piece ends there: bytes
                at += 1
                count[at] = count[at - 1] + self._raw(w[at - 1])
                last[at] = -1
            j = end + 1 - length
            before = last[j]
            if before >= 0:
                ok = pairs.get(before * size + piece)
                if ok is None:
                    if len(pairs) >= 400_000:
                        pairs.clear()
                    ok = pairs[before * size + piece] = self.compatible(names[before], names[piece])
                if not ok:
                    continue
            at = end + 1
            last[at] = piece
            count[at] = count[j] + 1
        while at < n:
            at += 1
            count[at] = count[at - 1] + self._raw(w[at - 1])
        return bytes([(y - x) & 255 for x, y in zip(count, count[1:])])

    def _raw(self, char: str) -> int:
        return len(char.encode()) if self.bytes_known else 1

    def deltas(self, text: str) -> bytes:
        """The change of the token count at each code point of a whole text.

        Entry 0 covers the marker that the encoder puts before the text, so
        there is one entry more than code points; an empty text has none.
        """
        if not text:
            return b""
        s = MARK + text.replace(" ", MARK)
        if MARK + MARK in s:
            words = _RUNS.findall(s)
        else:
            words = [MARK + w for w in s[1:].split(MARK)]
        cache = self.cache
        try:
            return b"".join([cache[w] for w in words])
        except KeyError:
            pass
        if len(cache) > cache.limit:
            cache.clear()
        out = []
        for w in words:
            d = cache.get(w)
            if d is None:
                d = self.word(w)
                if len(w) <= cache.longest:
                    cache[w] = d
            out.append(d)
        return b"".join(out)


def prefix_tokens(deltas: bytes, n_chars: int) -> int:
    """Tokens of the first ``n_chars`` code points, from stored deltas."""
    return int(np.frombuffer(deltas, np.int8)[:n_chars + 1].sum(dtype=np.int64)) if n_chars > 0 else 0


def fitting_chars(deltas: bytes, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens, from stored deltas."""
    if not deltas:
        return 0
    counts = np.cumsum(np.frombuffer(deltas, np.int8), dtype=np.int64)
    fits = np.flatnonzero(counts[1:] <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


_counters: dict[str, PrefixCounter] = {}


def _counter(model: str) -> PrefixCounter:
    if model not in _counters:
        _counters[model] = PrefixCounter(model)
    return _counters[model]


def token_counts(docs: DataFrame, model: str = "piece_bpe_32k.model", *, id_col: str = "doc_id",
                 text_col: str = "text", budget: int = 4096, keep_prefixes: bool = False) -> DataFrame:
    """Per row: ``n_bytes``, ``n_tokens`` and ``fit_chars`` (the longest prefix within ``budget`` tokens).

    ``keep_prefixes`` adds ``prefix_deltas`` (binary): with it
    ``prefix_tokens`` / ``fitting_chars`` answer for any prefix or budget.
    A null text counts as empty (0 tokens, 0 code points); the id may be null
    or repeated and is passed on; other input columns are left out, so their
    names cannot clash.  No shuffle: one pass over the texts.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    kind = src.schema["id"].dataType
    fields = [T.StructField(id_col, kind), T.StructField("n_bytes", T.LongType()),
              T.StructField("n_tokens", T.LongType()), T.StructField("fit_chars", T.LongType())]
    if keep_prefixes:
        fields.append(T.StructField("prefix_deltas", T.BinaryType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model)
        for b in batches:
            rows = texts(b.column(1))
            n_bytes, n_tokens, fit, kept = [], [], [], []
            for t in rows:
                d = counter.deltas(t)
                n = int(np.frombuffer(d, np.int8).sum(dtype=np.int64))
                n_bytes.append(len(t.encode()))
                n_tokens.append(n)
                # short of the budget every prefix might still not fit: counts can shrink as text grows
                fit.append(len(t) if n <= budget else fitting_chars(d, budget))
                if keep_prefixes:
                    kept.append(d)
            cols = [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                    pa.array(fit, pa.int64())]
            if keep_prefixes:
                cols.append(pa.array(kept, pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    return src.mapInArrow(run, T.StructType(fields))
