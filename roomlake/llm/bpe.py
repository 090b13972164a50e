"""Byte-level BPE encoding and decoding (operator 7) by DuckDB recursive queries.

Each Spark task keeps one private in-memory DuckDB with the merge table (which
token pair makes which token; a token's id is its rank).  The words of a batch
that the task has not met yet become token-position rows, one per byte.  A
recursive query joins neighbouring rows with the merge table and contracts each
word's leftmost minimum-rank pair until no pair merges.  Ordered aggregation
turns the rows into ids, and joined with the vocabulary back into bytes.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomlake.llm.common import Generations, chunks, texts, tokenizer_path

CACHE_WORDS = 450_000       # in each of two generations
GROUP_CHARS = 6_000_000     # text whose new words are looked up together
QUERY_WORDS = 40_000        # words per recursive query: bounds its rows
QUERY_BYTES = 400_000       # and their bytes
LONG_WORD = 48              # bytes; a longer word is encoded in parts that are then fitted together
LONG_WINDOW = 1_000         # bytes; where parts of a word do not fit within such a window, a query of its own
                            # contracts, per round, all occurrences of its minimum-rank pair

# Rows are (k, tok): k = word * span + position, so a row's right neighbour is
# k + 1.  One contraction per word and round: the merged token takes its left
# part's row, the right part's row goes, later rows move up by one.  A word
# without a merge drops out; its last round is its encoding.
_LEFTMOST = """
WITH RECURSIVE t(k, tok, step) AS (
  SELECT k, tok, 0 FROM word_bytes
  UNION ALL
  (WITH best AS (
     SELECT l.k // {span} AS w, min(m.merged * {span} + l.k % {span}) AS best
     FROM t l JOIN t r ON r.k = l.k + 1 JOIN merges m ON m.ab = l.tok * 65536 + r.tok
     GROUP BY 1)
   SELECT t.k - CASE WHEN t.k % {span} > best % {span} THEN 1 ELSE 0 END,
          CASE WHEN t.k % {span} = best % {span} THEN best // {span} ELSE tok END, step + 1
   FROM t JOIN best ON best.w = t.k // {span}
   WHERE t.k % {span} <> best % {span} + 1)
)
"""
# The same order for long words: occurrences of one pair merge back to back
# from the left, so a round may contract every second hit of a touching run.
_ALL_HITS = """
WITH RECURSIVE t(k, tok, step) AS (
  SELECT k, tok, 0 FROM word_bytes
  UNION ALL
  SELECT row_number() OVER (ORDER BY k) - 1, CASE WHEN take THEN best ELSE tok END, step + 1
  FROM (SELECT k, tok, step, best, take, lag(take, 1, false) OVER (ORDER BY k) AS eaten
        FROM (SELECT *, hit AND row_number() OVER (PARTITION BY island, hit ORDER BY k) % 2 = 1 AS take
              FROM (SELECT *, sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER (ORDER BY k) AS island
                    FROM (SELECT *, coalesce(merged = best, false) AS hit
                          FROM (SELECT p.*, merged, min(merged) OVER () AS best
                                FROM (SELECT *, lead(tok) OVER (ORDER BY k) AS nxt FROM t) p
                                LEFT JOIN merges m ON m.ab = p.tok * 65536 + p.nxt)
                          WHERE best IS NOT NULL))))
  WHERE NOT eaten
)
"""
_LAST_ROUND = """
SELECT w, array_to_string(list_transform(parts, lambda p: p.tok::VARCHAR), ','),
       array_to_string(list_transform(parts, lambda p: p.hex), '')
FROM (SELECT t.k // {span} AS w, list({{'tok': t.tok, 'hex': v.hex}} ORDER BY t.k) AS parts
      FROM t JOIN (SELECT k // {span} AS w, max(step) AS last FROM t GROUP BY 1) f
        ON f.w = t.k // {span} AND f.last = t.step
      JOIN vocabulary v ON v.id = t.tok
      GROUP BY 1)
"""

_cut = re.compile(r"(?<=\S)(?= \S)")
_space_then = re.compile(r" \s")
_then_space = re.compile(r"[^\S ] ")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(tokenizer_path(path), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class RecursiveBPE:
    """Encodes and decodes words with one in-memory DuckDB."""

    def __init__(self, ranks: str, pattern: str):
        import duckdb

        vocab = read_ranks(ranks)
        if not all(bytes([i]) in vocab for i in range(256)) or max(vocab.values()) >= 65536:
            raise ValueError("needs all single bytes and ranks below 65536")
        self.byte_id = np.array([vocab[bytes([i])] for i in range(256)], dtype=np.int64)
        self.words = regex.compile(pattern)
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "512MB", "temp_directory": ""})
        pairs = [(vocab[t[:i]], vocab[t[i:]], r) for t, r in vocab.items() if len(t) > 1
                 for i in range(1, len(t)) if t[:i] in vocab and t[i:] in vocab]
        self._table("merges", ab=[p[0] * 65536 + p[1] for p in pairs], merged=[p[2] for p in pairs])
        self._table("vocabulary", id=list(vocab.values()), hex=[t.hex() for t in vocab])
        self.bytes_of = {r: t for t, r in vocab.items()}
        self.cache = Generations(CACHE_WORDS)  # word -> (ids as text, decoded bytes)
        self.pieces = Generations(CACHE_WORDS)     # space-cut piece -> ids as text
        self.odd: dict[str, bytes] = {}        # decoded bytes of pieces that don't decode to themselves

    def _table(self, name: str, **columns: list) -> None:
        rows = pa.table({k: pa.array(v, pa.int64() if isinstance(v[0], int) else pa.string())
                         for k, v in columns.items()})
        self.con.register("incoming", rows)
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM incoming")
        self.con.unregister("incoming")

    def _query(self, words: list[bytes], sql: str, span: int) -> dict[int, tuple[bytes, bytes]]:
        lens = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8)
        pos = np.arange(len(data)) - np.repeat(np.cumsum(lens) - lens, lens)
        rows = pa.table({"k": np.repeat(np.arange(len(words)), lens) * span + pos, "tok": self.byte_id[data]})
        self.con.register("word_bytes", rows)
        out = self.con.execute(sql.replace("{span}", str(span)) + _LAST_ROUND.format(span=span)).fetchall()
        self.con.unregister("word_bytes")
        return {w: (ids.encode(), bytes.fromhex(hexed)) for w, ids, hexed in out}

    def encode_words(self, words: list[str]) -> dict[str, tuple[bytes, bytes]]:
        """Ids (decimal, joined by commas) and decoded bytes of each word, by the recursive query."""
        found: dict[str, tuple[bytes, bytes]] = {}
        raw = [(w, w.encode()) for w in words]
        short = [x for x in raw if len(x[1]) <= LONG_WORD]
        for a in range(0, len(short), QUERY_WORDS):
            part = short[a:a + QUERY_WORDS]
            got = self._query([x[1] for x in part], _LEFTMOST, 64)
            found.update((part[i][0], v) for i, v in got.items())
        for w, data in raw:
            if len(data) > LONG_WORD:
                found[w] = self._encode_long(data)
        return found

    def _tokens(self, parts: list[bytes]) -> list[list[int]]:
        """Token ids of each part, by queries of a bounded number of rows."""
        out: list[list[int]] = []
        for a, b in chunks(parts, len, QUERY_BYTES):
            few = [p for p in parts[a:b] if len(p) <= LONG_WINDOW]
            got = iter(sorted(self._query(few, _LEFTMOST, 1024).items())) if few else iter(())
            for p in parts[a:b]:
                ids = next(got)[1][0] if len(p) <= LONG_WINDOW else self._query([p], _ALL_HITS, 1 << 40)[0][0]
                out.append([int(x) for x in ids.split(b",")])
        return out

    def _encode_long(self, data: bytes) -> tuple[bytes, bytes]:
        """A long word: parts are encoded apart and fitted together.

        A token sequence is the encoding of its bytes if and only if each two neighbours are the encoding of theirs.  So
        only the seams between parts need a look; where two neighbours would merge otherwise, a window around the seam is
        encoded anew, twice as wide each time.
        """
        tokens, seams = [], {}                         # place -> tokens on either side to encode anew
        for ids in self._tokens([data[i:i + LONG_WORD] for i in range(0, len(data), LONG_WORD)]):
            if tokens:
                seams[len(tokens)] = 2
            tokens += ids
        fits: dict[tuple[int, int], bool] = {}
        while seams:
            new = sorted({(tokens[i - 1], tokens[i]) for i in seams} - fits.keys())
            fits.update((p, ids == list(p)) for p, ids in zip(new, self._tokens([self.bytes_of[a] + self.bytes_of[b] for a, b in new])))
            bad = sorted((i, w) for i, w in seams.items() if not fits[tokens[i - 1], tokens[i]])
            windows: list[list[int]] = []
            for i, w in bad:
                lo, hi = max(i - w, 0), min(i + w, len(tokens))
                if windows and lo <= windows[-1][1]:
                    windows[-1][1], windows[-1][2] = max(hi, windows[-1][1]), max(w, windows[-1][2])
                else:
                    windows.append([lo, hi, w])
            again = self._tokens([b"".join([self.bytes_of[t] for t in tokens[lo:hi]]) for lo, hi, _ in windows])
            out, seams, at = [], {}, 0
            for (lo, hi, w), ids in zip(windows, again):
                out += tokens[at:lo]
                if lo:
                    seams[len(out)] = max(2 * w, seams.get(len(out), 0))
                out += ids
                if hi < len(tokens):
                    seams[len(out)] = 2 * w
                at = hi
            tokens = out + tokens[at:]
        self.con.register("encoded", pa.table({"k": np.arange(len(tokens)), "tok": np.array(tokens, dtype=np.int64)}))
        hexed = self.con.execute("SELECT string_agg(v.hex, '' ORDER BY k) FROM encoded JOIN vocabulary v ON v.id = tok").fetchall()[0][0]
        self.con.unregister("encoded")
        return b",".join([b"%d" % t for t in tokens]), bytes.fromhex(hexed)

    def split(self, text: str) -> list[str]:
        """Pieces between which no match of the pattern runs: cut before a lone space."""
        if (text[0] == " " or text[-1] == " " or _space_then.search(text) or _then_space.search(text)):
            return _cut.split(text)
        head, *rest = text.split(" ")
        return [head, *[" " + x for x in rest]]

    def _learn(self, pieces: set[str]) -> dict[str, tuple[bytes, bytes]]:
        """Encode the pieces not met yet; the result also holds those too long to keep."""
        matched = {p: self.words.findall(p) for p in pieces}
        new = self.cache.missing(set().union(*matched.values()))
        got = self.encode_words(new)
        for w, v in got.items():
            if len(w) <= self.cache.longest:
                self.cache[w] = v
        extra = {}
        for p, ws in matched.items():
            vs = [got[w] if w in got else self.cache[w] for w in ws]
            both = vs[0] if len(vs) == 1 else (b",".join([v[0] for v in vs]), b"".join([v[1] for v in vs]))
            if len(p) <= self.pieces.longest:
                self.pieces[p] = both[0]
                if both[1] != p.encode():
                    self.odd[p] = both[1]
            else:
                extra[p] = both
        return extra

    def learn(self, pieces: set[str]) -> dict[str, tuple[bytes, bytes]]:
        """``_learn`` without cyclic garbage collection: it makes a few hundred thousand rows and no cycles."""
        on = gc.isenabled()
        gc.disable()
        try:
            return self._learn(pieces)
        finally:
            if on:
                gc.enable()

    def texts(self, rows: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Ids (decimal, joined by commas) and decoded bytes of whole texts."""
        for a, b in chunks(rows, len, GROUP_CHARS):
            split = [self.split(t) if t else [] for t in rows[a:b]]
            new = self.pieces.missing(set().union(*split))
            if len(self.odd) > CACHE_WORDS:    # pieces that decode to other bytes: none in a lossless vocabulary
                for held in (self.pieces, self.pieces.old, self.odd):
                    held.clear()
                new = set().union(*split)
            extra = self.learn(set(new)) if new else {}
            for t, parts in zip(rows[a:b], split):
                if extra:
                    ids = b",".join([extra[p][0] if p in extra else self.pieces[p] for p in parts])
                else:
                    ids = b",".join(map(self.pieces.__getitem__, parts))
                if extra or self.odd:
                    yield ids, b"".join([extra[p][1] if p in extra else self.odd.get(p) or p.encode() for p in parts])
                else:                          # every piece was decoded to its own bytes
                    yield ids, t.encode()


_coders: dict[tuple[str, str], RecursiveBPE] = {}


def _coder(ranks: str, pattern: str | None) -> RecursiveBPE:
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    key = (ranks, pattern)
    if key not in _coders:
        _coders[key] = RecursiveBPE(*key)
    return _coders[key]


def bpe_round_trip(docs: DataFrame, ranks: str = "byte_bpe_multi_50k.tiktoken", pattern: str | None = None, *,
                   id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Per row: ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by commas), ``decoded_sha256``.

    ``keep_ids`` adds the real outputs: ``ids`` (array<int>) and ``decoded``
    (binary, the decoded bytes).  A null text counts as empty: no tokens, and
    both digests are of the empty string.  The id may be null or repeated and
    is passed on; other input columns are left out.  No shuffle; a task holds
    one Arrow batch, a bounded word cache and one bounded query.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    kind = src.schema["id"].dataType
    fields = [T.StructField(id_col, kind), T.StructField("n_tokens", T.LongType()),
              T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if keep_ids:
        fields += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(ranks, pattern)
        for b in batches:
            n, ids_sha, back_sha, ids, back = [], [], [], [], []
            for i, d in coder.texts(texts(b.column(1))):
                n.append(i.count(b",") + 1 if i else 0)
                ids_sha.append(hashlib.sha256(i).hexdigest())
                back_sha.append(hashlib.sha256(d).hexdigest())
                if keep_ids:
                    ids.append([int(x) for x in i.split(b",")] if i else [])
                    back.append(d)
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                    pa.array(back_sha, pa.string())]
            if keep_ids:
                cols += [pa.array(ids, pa.list_(pa.int32())), pa.array(back, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    return src.mapInArrow(run, T.StructType(fields))
