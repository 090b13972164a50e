"""Language ID (operator 6) with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  An n-gram's vector binds its
letters' vectors: each is rotated by its place in the n-gram, and they are
multiplied elementwise.  A text's vector bundles (sums) those of its n-grams; a
language's prototype bundles its texts.  A text gets the language whose
prototype has the largest cosine with its vector.

Letters are lower-cased; a run of anything else counts as one word-boundary
"letter", so n-grams also see how words begin and end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomlake.llm.common import texts

DIMENSIONS = 1024
CACHE_GRAMS = 20_000        # bound gram vectors kept by a task (one byte a dimension)
UNKNOWN = "und"
_SHIFT = 21                 # bits of a code point

_alpha: np.ndarray | None = None


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-cased letters; 0 for each run of other characters, also around the text."""
    global _alpha
    if _alpha is None:
        _alpha = np.array([chr(i).isalpha() for i in range(0x110000)], dtype=bool)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _alpha[points]
    if not letter.any():
        return np.zeros(0, np.int64)
    seq = np.zeros(len(points) + 2, np.int64)
    seq[1:-1] = np.where(letter, points, 0)
    return seq[np.concatenate(([True], (seq[1:] != 0) | (seq[:-1] != 0)))]


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of the text (three code points packed in one number) and their counts."""
    s = _letters(text)
    if len(s) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.unique((s[:-2] << 2 * _SHIFT) | (s[1:-1] << _SHIFT) | s[2:], return_counts=True)


class GramVectors:
    """Bound vectors of trigrams, made when first met."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = 7):
        self.dimensions, self.seed = dimensions, seed
        self._letter: dict[int, np.ndarray] = {}
        self._clear()

    def _clear(self) -> None:
        self.codes = np.zeros(0, np.int64)             # sorted; ``place`` gives each one's row
        self.place = np.zeros(0, np.int64)
        self.rows = np.zeros((0, self.dimensions), np.int8)
        self.used = 0

    def letter(self, point: int) -> np.ndarray:
        v = self._letter.get(point)
        if v is None:
            bits = np.random.default_rng((self.seed, point)).integers(0, 2, self.dimensions, dtype=np.int8)
            v = self._letter[point] = bits * 2 - 1
        return v

    def bind(self, code: int) -> np.ndarray:
        m = (1 << _SHIFT) - 1
        a, b, c = self.letter(code >> 2 * _SHIFT), self.letter(code >> _SHIFT & m), self.letter(code & m)
        return np.roll(a, 2) * np.roll(b, 1) * c

    def at(self, codes: np.ndarray) -> np.ndarray:
        """The bound vectors of distinct codes, one a row."""
        at = np.searchsorted(self.codes, codes)
        known = at < len(self.codes)
        known[known] = self.codes[at[known]] == codes[known]
        new = codes[~known]
        if len(new) == 0:
            return self.rows[self.place[at]]
        if self.used + len(new) > CACHE_GRAMS and self.used:
            self._clear()
            new = codes
        if self.used + len(new) > len(self.rows):
            grown = np.zeros((max(self.used + len(new), 2 * len(self.rows), 1024), self.dimensions), np.int8)
            grown[:self.used] = self.rows[:self.used]
            self.rows = grown
        for i, code in enumerate(new.tolist(), start=self.used):
            self.rows[i] = self.bind(code)
        place = np.concatenate((self.place, np.arange(self.used, self.used + len(new))))
        merged = np.concatenate((self.codes, new))
        order = np.argsort(merged, kind="stable")
        self.codes, self.place = merged[order], place[order]
        self.used += len(new)
        return self.rows[self.place[np.searchsorted(self.codes, codes)]]

    def bundle(self, codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(self.dimensions, np.float32)
        w = weights.astype(np.float32)
        for a in range(0, len(codes), 8192):           # bounds the rows unpacked at once
            out += w[a:a + 8192] @ self.at(codes[a:a + 8192]).astype(np.float32)
        return out


_vectors: dict[tuple[int, int], GramVectors] = {}


def _gram_vectors(dimensions: int, seed: int) -> GramVectors:
    return _vectors.setdefault((dimensions, seed), GramVectors(dimensions, seed))


def learn_prototypes(docs: DataFrame, *, lang_col: str = "lang", text_col: str = "text",
                     dimensions: int = DIMENSIONS, seed: int = 7) -> dict[str, np.ndarray]:
    """Unit prototype of every non-null language, bundled over all rows of ``docs``.

    Each text weighs the same, whatever its length; texts without letters are
    left out.  Tasks sum gram weights by language, so what is shuffled grows
    with the grams, not the text; the driver gets ``dimensions`` numbers a language.
    """
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, rows = b.column(0).to_pylist(), texts(b.column(1))
            names = sorted(set(langs))
            of = {x: i for i, x in enumerate(names)}
            parts = []
            for lang, t in zip(langs, rows):
                codes, n = grams(t)
                if len(codes):
                    parts.append((np.full(len(codes), of[lang]), codes, n / n.sum()))
            if not parts:
                continue
            lang_i, codes, w = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((codes, lang_i))
            lang_i, codes, w = lang_i[order], codes[order], w[order]
            first = np.flatnonzero(np.concatenate(([True], (np.diff(codes) != 0) | (np.diff(lang_i) != 0))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in lang_i[first]], pa.string()), pa.array(codes[first]),
                 pa.array(np.add.reduceat(w, first))], names=["lang", "gram", "w"])

    def bind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, sums = _gram_vectors(dimensions, seed), {}
        for b in batches:
            lang = np.array(b.column(0).to_pylist(), dtype=object)
            codes, w = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            for x in set(lang):
                at = np.flatnonzero(lang == x)
                order = at[np.argsort(codes[at])]
                sums[x] = sums.get(x, 0) + vectors.bundle(codes[order], w[order]).astype(np.float64)
        for x, v in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([x] * dimensions, pa.string()), pa.array(np.arange(dimensions), pa.int32()), pa.array(v)],
                names=["lang", "dim", "x"])

    src = docs.select(F.col(lang_col).cast("string").alias("l"), F.col(text_col).alias("t")).where("l IS NOT NULL")
    weights = (src.mapInArrow(weigh, "lang string, gram long, w double")
               .groupBy("lang", "gram").agg(F.sum("w").alias("w")))
    rows = (weights.mapInArrow(bind, "lang string, dim int, x double")
            .groupBy("lang", "dim").agg(F.sum("x").alias("x")).collect())
    out: dict[str, np.ndarray] = {}
    for r in rows:
        out.setdefault(r["lang"], np.zeros(dimensions))[r["dim"]] = r["x"]
    return {k: v / np.linalg.norm(v) for k, v in sorted(out.items()) if np.linalg.norm(v) > 0}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], *, text_col: str = "text",
             dimensions: int = DIMENSIONS, seed: int = 7, pred_col: str = "lang_pred",
             score_col: str = "score") -> DataFrame:
    """Adds the language of the nearest prototype and that cosine (0 to 1; below 0 counts as 0).

    A null text, one without letters, or no prototypes at all: ``und`` and 0.  Equal
    cosines go to the smaller language name.  All rows and columns stay;
    columns named like the two new ones are replaced.  No shuffle.
    """
    names = list(prototypes)
    matrix = np.array([prototypes[x] for x in names], dtype=np.float32).reshape(len(names), dimensions)
    keep = [c for c in docs.columns if c not in (pred_col, score_col)]
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField(pred_col, T.StringType()),
                           T.StructField(score_col, T.DoubleType())])
    at = keep.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = _gram_vectors(dimensions, seed)
        for b in batches:
            pred, score = [], []
            for t in texts(b.column(at)):
                codes, n = grams(t)
                best, cosine = UNKNOWN, 0.0
                if len(codes) and names:
                    v = vectors.bundle(codes, n)
                    norm = float(np.linalg.norm(v))
                    if norm > 0:
                        cosines = matrix @ v / norm
                        k = int(np.argmax(cosines))
                        best, cosine = names[k], min(1.0, max(0.0, float(cosines[k])))
                    else:                              # bundled to nothing: as far from every prototype
                        best = names[0]
                pred.append(best)
                score.append(cosine)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             names=schema.names)

    return docs.select(*keep).mapInArrow(run, schema)


def with_letter(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The rows whose text has a letter, by the rule of ``identify``; all columns stay.  No shuffle."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([len(_letters(t)) > 0 for t in texts(b.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def fold(id_col: str, n: int):
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % n


def train_rows(docs: DataFrame) -> DataFrame:
    """Rows that prototypes may learn from: fold 0 of 5 is held out (a null id is in no fold)."""
    return docs.where(F.coalesce(fold("doc_id", 5) != 0, F.lit(True))).where(F.col("lang").isNotNull())


def language_predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: prototypes from the rows not held out, every row predicted."""
    prototypes = learn_prototypes(train_rows(docs))
    rows = docs.select("doc_id", "text", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"))
    return identify(rows, prototypes).select("doc_id", "held_out", "lang_pred", "score")
