"""Toxicity (operator 10): a learned lexicon met by Levenshtein automata, with context windows.

The lexicon (whole words and word stems) is learned from labelled rows: terms whose
documents are labelled toxic far more often than chance allows.  Its trie is
intersected with the Levenshtein automaton of each word: states are sets of (trie node,
edits spent), determinised as words need them, so that a word one edit away from a term (a
letter added, dropped, changed, or two swapped) is caught in one pass over its letters.  Every hit
is weighed by the words around it: inside quotation marks or next to words of
reporting it counts as quotation, otherwise as abuse.  A logistic model, fitted on the
same labelled rows, turns a text's weighed hits into its score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomlake.llm.common import cut, texts
from roomlake.llm.language import fold

STEMS = (4, 5, 6)               # stem lengths tried besides whole words
FUZZY_FROM = 5                  # shorter terms must match exactly, but for those of ``near_free``
SHORT = 4                       # letters of a term that ``near_free`` may allow an edit
SHORT_WORDS = 100_000           # words of clean texts that show whether a short term has neighbours, at least
WINDOW = 6                      # words looked at on each side of a hit
SAMPLE_ROWS = 10_000            # labelled rows per class that the lexicon and the model learn from, at most
PER_TEXT = 4                    # occurrences of a term that count in one training text
FEATURES = 5
MIN_RATIO = 6.0                 # a term's rate in toxic texts over that in clean ones, at least
CACHE_WORDS = 300_000
QUOTED_SHARE = 0.25             # what a quoted hit counts of an abusive one
_WORD = re.compile(r"\w+")
_QUOTES = "\"“”„«»‹›‘"
#: Words of reporting in the four languages of the tables.
REPORTING = frozenset("""
said says wrote writes quoted quote quotes called reported reports replied
dit disait écrit cité cita
sagte sagt schrieb zitiert nannte
dijo dice escribió citó llamó
""".split())


def terms_of(text: str) -> tuple[Counter, int]:
    """Candidate lexicon entries of a text with their counts, and its number of words.

    Entries are the words, and stems written with a final ``*``.  An entry counts at most
    ``PER_TEXT`` times a text, so that one repetitive text cannot make a term.
    """
    words = Counter(_WORD.findall(text.lower()))
    out = Counter()
    for w, n in words.items():
        if len(w) > 40 or w.isdigit():
            continue
        out[w] += n
        for k in STEMS:
            if len(w) > k:
                out[w[:k] + "*"] += n
    return Counter({t: min(n, PER_TEXT) for t, n in out.items()}), sum(words.values())


class Lexicon:
    """Trie of terms (``word`` or ``stem*``) with a lazily determinised Levenshtein automaton over it."""

    def __init__(self, terms: list[str], fuzzy_from: int = FUZZY_FROM, short: frozenset[str] = frozenset()):
        """``short``: terms that take an edit though shorter than ``fuzzy_from``."""
        self.children: list[dict[str, int]] = [{}]
        self.word: list[str | None] = [None]            # the term that ends as a whole word here
        self.stem: list[str | None] = [None]            # the term whose stem ends here
        self.budget: list[int] = [0]                    # most edits of any term below
        for term in terms:
            body = term.rstrip("*")
            edits = 1 if len(body) >= fuzzy_from or term in short else 0
            node = 0
            self.budget[0] = max(self.budget[0], edits)
            for c in body:
                nxt = self.children[node].get(c)
                if nxt is None:
                    nxt = len(self.children)
                    self.children[node][c] = nxt
                    self.children.append({})
                    self.word.append(None)
                    self.stem.append(None)
                    self.budget.append(0)
                node = nxt
                self.budget[node] = max(self.budget[node], edits)
            (self.stem if term.endswith("*") else self.word)[node] = term
        self.fuzzy_from, self.short = fuzzy_from, short
        self._reset()

    def _reset(self) -> None:
        self._ids: dict[frozenset, int] = {}
        self._sets: list[frozenset] = []
        self._next: list[dict[str, int]] = []
        self._final: list[tuple] = []                   # (exact term, fuzzy term) if a word ends here
        self._stemmed: list[tuple] = []                 # the same for stems reached at this letter
        self.start = self._state(self._close({(0, 0, "")}))

    def _allowed(self, term: str, edits: int) -> bool:
        return edits == 0 or len(term.rstrip("*")) >= self.fuzzy_from or term in self.short

    def _close(self, states: set) -> frozenset:
        """Adds the nodes reached by dropping letters of a term."""
        todo = list(states)
        while todo:
            node, e, want = todo.pop()
            if not want and e < 1:
                for child in self.children[node].values():
                    s = (child, e + 1, "")
                    if e + 1 <= self.budget[child] and s not in states:
                        states.add(s)
                        todo.append(s)
        return frozenset(states)

    def _state(self, states: frozenset) -> int:
        i = self._ids.get(states)
        if i is None:
            i = self._ids[states] = len(self._sets)
            self._sets.append(states)
            self._next.append({})
            for ends, out in ((self.word, self._final), (self.stem, self._stemmed)):
                found = {0: None, 1: None}
                for node, e, want in sorted(states):
                    term = ends[node]
                    if not want and term is not None and found[e] is None and self._allowed(term, e):
                        found[e] = term
                out.append((found[0], found[1]))
        return i

    def _step(self, state: int, c: str) -> int:
        """The state after reading ``c``; -1 once no term can match any more."""
        out = set()
        for node, e, want in self._sets[state]:
            if want:                                    # second letter of a swap
                if c == want[0]:
                    out.add((int(want[1:]), e, ""))
                continue
            kids = self.children[node]
            child = kids.get(c)
            if child is not None:
                out.add((child, e, ""))
            if e < 1:
                if e + 1 <= self.budget[node]:
                    out.add((node, e + 1, ""))          # an added letter
                for d, child in kids.items():
                    if d != c and self.budget[child] > e:
                        out.add((child, e + 1, ""))     # a changed letter
                        after = self.children[child].get(c)
                        if after is not None and self.budget[after] > e:
                            out.add((node, e + 1, f"{d}{after}"))
        return self._state(self._close(out)) if out else -1

    def match(self, word: str) -> tuple[str, int] | None:
        """The term that the word spells, and the edits (0 or 1); exact matches come first."""
        if len(self._sets) > 50_000:
            self._reset()
        state, fuzzy_stem, nxt = self.start, None, self._next
        for c in word:
            to = nxt[state].get(c)
            if to is None:
                to = nxt[state][c] = self._step(state, c)
            if to < 0:
                return (fuzzy_stem, 1) if fuzzy_stem else None
            state = to
            exact, near = self._stemmed[state]
            if exact:
                return exact, 0
            fuzzy_stem = fuzzy_stem or near
        exact, near = self._final[state]
        if exact:
            return exact, 0
        found = near or fuzzy_stem
        return (found, 1) if found else None


class Matcher:
    """Hits of texts, with a bounded memory of words."""

    def __init__(self, weights: dict[str, float], short: frozenset[str] = frozenset()):
        self.weights = weights
        self.lexicon = Lexicon(sorted(weights), short=short)
        self.clean: set[str] = set()
        self.hits: dict[str, tuple[str, int]] = {}

    def _words_hit(self, words: set[str]) -> list[str]:
        if len(self.clean) + len(self.hits) > CACHE_WORDS:
            self.clean, self.hits = set(), {}
        for w in words.difference(self.clean):
            if w in self.hits:
                continue
            m = self.lexicon.match(w)
            if m is None:
                if len(w) <= 64:
                    self.clean.add(w)
            else:
                self.hits[w] = m
        return [w for w in words if w in self.hits] if self.hits else []

    def features(self, text: str) -> list[float]:
        """Weighed hits, distinct terms, the strongest term's weight, hits a thousand words, length if hit."""
        low = text.lower()
        words = _WORD.findall(low)
        found = set(self._words_hit(set(words)))
        if not found:
            return [0.0] * FEATURES
        total, strongest, terms = 0.0, 0.0, Counter()
        spans = [m.span() for m in _WORD.finditer(low)]
        opened, at = False, 0                           # inside a pair of quotation marks
        for i, w in enumerate(words):
            if w not in found:
                continue
            term, edits = self.hits[w]
            a, b = spans[i]
            if sum(map(low[at:a].count, _QUOTES)) % 2:
                opened = not opened
            at = a
            share = (1.0 - 0.3 * edits) * self.context(low, words, spans, i, opened)
            weight = self.weights[term]
            total += share * weight
            strongest = max(strongest, share * weight)
            terms[term] = max(terms[term], share)
        return [math.log1p(total), math.log1p(sum(terms.values())), strongest,
                math.log1p(1000.0 * total / max(len(words), 50)), math.log(max(len(words), 50) / 50)]

    @staticmethod
    def context(low: str, words: list[str], spans: list[tuple[int, int]], i: int, opened: bool) -> float:
        """1 for abuse, ``QUOTED_SHARE`` for quotation, by the window around word ``i``.

        Quotation: a mark was opened before the hit and closes within the window, or the
        hit has a mark within the window and a word of reporting near it.
        """
        lo, hi = max(0, i - WINDOW), min(len(words), i + WINDOW + 1)
        before, after = low[spans[lo][0]:spans[i][0]], low[spans[i][1]:spans[hi - 1][1] + 1]
        closes = any(q in after for q in _QUOTES)
        if opened and closes:
            return QUOTED_SHARE
        reported = not REPORTING.isdisjoint(words[lo:hi])
        return QUOTED_SHARE if reported and (closes or any(q in before for q in _QUOTES)) else 1.0


def pick_terms(counts: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Terms and weights from (term, occurrences in toxic, in clean texts) and the words of either.

    A term stays if chance would put so large a share of its occurrences into toxic texts with odds under
    e^-18, and its toxic rate is at least ``MIN_RATIO`` times its clean rate.  A stem gives way to a longer
    term that covers nine tenths of it, other terms to a stem that covers them.
    """
    p = n_toxic / max(n_toxic + n_clean, 1)
    strong = {}
    for term, a, b in counts:
        n = a + b
        share = a / n
        ratio = (a / n_toxic) / ((b + 0.5) / n_clean)
        if share <= p or a < 3 or ratio < MIN_RATIO:
            continue
        divergence = share * math.log(share / p) + ((1 - share) * math.log((1 - share) / (1 - p)) if b else 0.0)
        if n * divergence >= 18:
            strong[term] = (a, math.log(ratio))
    longest: dict[str, int] = {}                        # most occurrences of a longer term, by stem
    for term, (a, _) in strong.items():
        body = term.rstrip("*")
        for k in STEMS:
            if k < len(body):
                longest[body[:k]] = max(longest.get(body[:k], 0), a)
    kept = {t: (a, w) for t, (a, w) in strong.items() if not t.endswith("*") or longest.get(t[:-1], 0) < 0.9 * a}
    stems = {t[:-1] for t in kept if t.endswith("*")}
    out = {t: v for t, v in kept.items()
           if not any(t.rstrip("*")[:k] in stems for k in STEMS if k < len(t.rstrip("*")))}
    best = sorted(out.items(), key=lambda x: (-x[1][0] * x[1][1], x[0]))
    return {t: w for t, (_, w) in best}


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50,
                 rows: np.ndarray | None = None) -> np.ndarray:
    """Weights and (last) intercept by Newton's method; the intercept is not shrunk.

    ``rows`` says how many rows each row stands for (default: itself).
    """
    rows = np.ones(len(y)) if rows is None else rows
    x1 = np.column_stack((x, np.ones(len(x))))
    beta, shrink = np.zeros(x1.shape[1]), ridge * np.eye(x1.shape[1])
    shrink[-1, -1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ beta, -30, 30)))
        h = (x1 * (rows * p * (1 - p))[:, None]).T @ x1 + shrink
        d = np.linalg.solve(h, x1.T @ (rows * (y - p)) - shrink @ beta)
        beta += d
        if np.abs(d).max() < 1e-6:
            break
    return beta


def sample_labels(labels: DataFrame, sample_rows: int) -> DataFrame:
    """doc_id, toxic (0 / 1) and stands_for of at most about ``sample_rows`` labelled rows a class, outside fold 1 of 3.

    Rows are taken by a hash of the id; a document with several labels counts as toxic if one says so.
    ``stands_for`` is the inverse of the class's sampling share: 1 where the class is taken whole.
    """
    rows = (labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(fold("doc_id", 3) != 1)
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    taken = [min(1_000_000, math.ceil(1_000_000 * sample_rows / max(n.get(y, 0), 1))) for y in (0, 1)]
    of_class = F.when(F.col("toxic") == 1, F.lit(taken[1])).otherwise(F.lit(taken[0]))
    return (rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < of_class)
            .withColumn("stands_for", 1_000_000 / of_class))


class ToxicityModel:
    """The learned lexicon (term -> weight; the short terms that take an edit) and logistic weights."""

    def __init__(self, weights: dict[str, float], beta: np.ndarray, short: frozenset[str] = frozenset()):
        self.weights, self.beta, self.short = weights, beta, short
        self._matcher: Matcher | None = None

    def __getstate__(self):
        return {"weights": self.weights, "beta": self.beta, "short": self.short, "_matcher": None}

    @property
    def matcher(self) -> Matcher:
        if self._matcher is None:
            self._matcher = Matcher(self.weights, self.short)
        return self._matcher

    def score(self, text: str) -> float:
        z = float(np.dot(self.beta[:-1], self.matcher.features(text)) + self.beta[-1])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def near_free(sample: DataFrame, weights: dict[str, float]) -> frozenset[str]:
    """The terms of ``SHORT`` letters of which no other word within one edit stands in a clean text.

    ``sample``: y and t of the labelled rows.  Words that are terms themselves do not count as neighbours.
    """
    short = [t for t in weights if len(t.rstrip("*")) == SHORT]
    if not short:
        return frozenset()

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Lexicon(sorted(weights))
        apart = {t: Lexicon([t], SHORT) for t in short}
        seen, met = set(), set()
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), texts(b.column(1))):
                new = set() if y else set(_WORD.findall(t.lower())) - seen
                if len(seen) > CACHE_WORDS:
                    seen = set()
                seen |= new
                # a longer word matches like its first letters: never a whole term, a stem if they do
                for w in {w[:SHORT + 2] for w in new if (known.match(w) or ("", 1))[1]}:
                    met.update([t for t, x in apart.items() if t not in met and x.match(w)])
        yield pa.RecordBatch.from_arrays([pa.array(sorted(met), pa.string())], names=["term"])

    met = sample.select("y", "t").mapInArrow(neighbours, "term string").distinct().collect()
    return frozenset(short) - {r["term"] for r in met}


def learn_toxicity(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS,
                   text_col: str = "text") -> ToxicityModel:
    """Learn lexicon and model from labelled rows outside fold 1 of 3.

    At most about ``sample_rows`` rows a class: a bound that makes the id list
    broadcastable and the texts one small table, read up to three times.  The classes are thinned apart, so
    the logistic fit counts each row for as many as it stands for: scores keep the true share of toxic rows.
    The terms' evidence compares rates within the classes, which thinning leaves alone, and is counted in sampled
    rows.  Without toxic or without clean rows the model has no terms and scores everything 0.
    """
    ids = sample_labels(labels, sample_rows).select(F.col("doc_id").alias("_id"), F.col("toxic").alias("y"),
                                                    F.col("stands_for").alias("n"))
    sample = cut(docs.select(F.col("doc_id").alias("_id"), F.col(text_col).alias("t")).where("t IS NOT NULL")
                 .join(F.broadcast(ids), "_id").select("y", "t", "n"), "labelled")
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y, rows = b.column(0).to_pylist(), texts(b.column(1))
            seen, words = (Counter(), Counter()), [0, 0]
            for label, t in zip(y, rows):
                found, n = terms_of(t)
                seen[label].update(found)
                words[label] += n
            keys = list(seen[1].keys() | seen[0].keys())
            yield pa.RecordBatch.from_arrays(       # the words of either class travel under an empty term
                [pa.array([*keys, ""], pa.string()), pa.array([*(seen[1][k] for k in keys), words[1]], pa.int64()),
                 pa.array([*(seen[0][k] for k in keys), words[0]], pa.int64())], names=["term", "a", "b"])

    counts = cut(sample.mapInArrow(count, "term string, a long, b long").groupBy("term")
                 .agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where("a >= 3 OR term = ''"), "terms")
    words = counts.where("term = ''").first()
    if words is None or not words["a"] or not words["b"]:
        return ToxicityModel({}, np.array([0.0] * FEATURES + [-30.0]))
    n1, n0 = words["a"], words["b"]
    # the conditions of pick_terms that keep what reaches the driver small
    counts = counts.where((F.col("term") != "") & (F.col("a") / n1 >= MIN_RATIO * (F.col("b") + 0.5) / n0)
                          & (F.col("a") * math.log((n1 + n0) / n1) >= 18))
    weights = pick_terms([(r["term"], r["a"], r["b"]) for r in counts.collect()], n1, n0)
    short = near_free(sample, weights) if n0 >= SHORT_WORDS else frozenset()

    columns = [f"f{i}" for i in range(FEATURES)]

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(weights, short)
        for b in batches:
            x = np.array([matcher.features(t) for t in texts(b.column(1))]).reshape(b.num_rows, FEATURES)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *[pa.array(x[:, i]) for i in range(FEATURES)]],
                                             names=["y", "n", *columns])

    rows = sample.mapInArrow(featurise, T.StructType(
        [sample.schema["y"], sample.schema["n"],
         *[T.StructField(f"f{i}", T.DoubleType()) for i in range(FEATURES)]])).toPandas()
    x, y, n = (rows[c].to_numpy(dtype=float) for c in (columns, "y", "n"))
    return ToxicityModel(weights, fit_logistic(x, y, rows=n / n.min()), short)


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text",
                   score_col: str = "score") -> DataFrame:
    """Adds the score (0 to 1) of every whole text; a null text scores like an empty one.

    All rows and columns stay; a column named like the new one is replaced.  No shuffle.
    """
    keep = [c for c in docs.columns if c != score_col]
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField(score_col, T.DoubleType())])
    at = keep.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [model.score(t) for t in texts(b.column(at))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], names=schema.names)

    return docs.select(*keep).mapInArrow(run, schema)


def toxicity_predictions(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    model = learn_toxicity(docs, labels)
    rows = docs.select("doc_id", "text", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"))
    return score_toxicity(rows, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
