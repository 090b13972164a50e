"""Ranked lexical search of all documents for a set of items, by an exact dual-tree search.

A document is the vector of its terms' impacts, an item the vector of its terms' repeats; their product is the score.
Both sides form hierarchies whose nodes hold coordinate maxima: the product of two nodes' maxima bounds the score of
every pair below them.  A pair of nodes whose bound lies under the weakest kth best score among the node's items holds
no answer and is left out whole; what remains at the leaves is scored exactly.

The Spark work: the items' terms (a block of items at a time, so that what tasks get with the function has a bounded size)
are looked up in every text by one scan, which writes (id, length, terms, counts) to the shared folder; document
frequencies are one aggregation over it; each task then builds the hierarchy of a bounded number of documents at a
time and searches it with the kth scores it has so far.  A task sends at most ``k`` rows an item; the last
ranking is a window over these.  Nothing else is shuffled, and no task holds more than a batch of documents.

Defined results: null or empty texts have no terms (no score, not counted in N or L); repeated rows of items count once,
repeated rows of documents each on its own; equal scores go by ascending document id, null ids last; an item
without terms, or an empty table on either side, has no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomlake.llm.common import cut

#: bytes of item texts searched with at once, and of a batch's dense maxima in a task
BLOCK_BYTES = 256 << 10
DENSE_BYTES = 48 << 20
SLICE_BYTES = 4 << 20
LEAF_DOCS, LEAF_ITEMS, FAN = 32, 8, 8
NULL_ID = np.iinfo(np.int64).max      # sorts null document ids last; no other id may have this value

# a term's bytes: 0-9, A-Z, a-z and everything beyond ASCII
_TERM = np.zeros(256, dtype=bool)
_TERM[128:] = True
for _a, _b in (b"09", b"AZ", b"az"):
    _TERM[_a:_b + 1] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def text_terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of several texts as one binary array, and the number of terms of each text."""
    texts = pc.fill_null(pc.cast(texts, pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    ends = offsets[1:] - offsets[0]
    inside = _TERM[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    first = np.unique(offsets[:-1] - offsets[0])
    first = first[first < len(data)]
    start[first] = inside[first]                       # no term runs from one text into the next
    at = np.flatnonzero(start)
    per_text = np.diff(np.searchsorted(at, ends), prepend=0)
    place = np.cumsum(inside)                          # bytes of terms up to and including each byte
    bounds = np.append(place[at] - 1, place[-1] if len(place) else 0).astype(np.int64)
    body = _LOWER[data[inside]]
    terms = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(body)])
    return terms, per_text


def item_vectors(rows: list) -> tuple[list, list[bytes], np.ndarray]:
    """(item ids, vocabulary, items x vocabulary repeats) of one block of items with at least a term."""
    ids, counts, vocabulary = [], [], {}
    for item_id, text in rows:
        terms, _ = text_terms(pa.array([text], pa.large_string()))
        if len(terms):
            ids.append(item_id)
            counts.append(Counter(vocabulary.setdefault(t, len(vocabulary)) for t in terms.to_pylist()))
    q = np.zeros((len(ids), len(vocabulary)), dtype=np.int64)
    for i, c in enumerate(counts):
        q[i, list(c)] = list(c.values())
    return ids, list(vocabulary), q


def _entries(vocabulary: list[bytes]):
    """Batches of (doc_id, text) -> (doc_id, n, terms, tfs) of documents with a term; terms of the vocabulary only."""
    values = pa.array(vocabulary, pa.large_binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(size.astype(np.int64))
            a = 0
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SLICE_BYTES, side="right")))
                part = batch.slice(a, b - a)
                a = b
                terms, n = text_terms(part.column(1))
                found = pc.index_in(terms, value_set=values).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                doc = np.repeat(np.arange(len(n)), n)
                keep = found >= 0
                pair, tf = np.unique(doc[keep] * max(len(vocabulary), 1) + found[keep], return_counts=True)
                docs, term = np.divmod(pair, max(len(vocabulary), 1))
                has = np.flatnonzero(n > 0)
                ptr = np.searchsorted(docs, np.append(has, len(n))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(has)), pa.array(n[has], pa.int64()),
                    pa.ListArray.from_arrays(ptr, pa.array(term.astype(np.int32))),
                    pa.ListArray.from_arrays(ptr, pa.array(tf.astype(np.int32)))], names=["doc_id", "n", "terms", "tfs"])
    return run


def _hierarchy(q: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """An order of the items and the levels of a hierarchy over it: node bounds, root first.

    A node is cut in two halves around its two most unlike items, down to ``LEAF_ITEMS``.
    """
    unit = q / np.maximum(np.sqrt((q * q).sum(1, keepdims=True)), 1e-9)

    def halves(idx: np.ndarray) -> np.ndarray:
        one = idx[np.argmin(unit[idx] @ unit[idx[0]])]
        other = idx[np.argmin(unit[idx] @ unit[one])]
        return idx[np.argsort(unit[idx] @ (unit[other] - unit[one]), kind="stable")]

    order, levels = np.arange(len(q)), [np.array([0, len(q)])]
    while np.diff(levels[-1]).max() > LEAF_ITEMS:
        cuts = [0]
        for a, b in zip(levels[-1][:-1], levels[-1][1:]):
            if b - a > LEAF_ITEMS:
                order[a:b] = halves(order[a:b])
                cuts.append((a + b) // 2)
            cuts.append(b)
        levels.append(np.array(cuts))
    return order, levels


class Search:
    """The k best documents of every item among those fed so far; ``scored`` counts exact scores computed."""

    def __init__(self, q: np.ndarray, k: int):
        order, self.levels = _hierarchy(q)
        self.q, self.place, self.k = q[order], order, k
        self.maxima = [np.maximum.reduceat(self.q, lv[:-1], axis=0).astype(np.float64) for lv in self.levels]
        self.item, self.doc, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.kth = np.ones(len(q), dtype=np.int64)     # a score must be above 0
        self.scored = 0

    def feed(self, ids: np.ndarray, ptr: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        """Search documents given as rows ``ptr`` of (term, impact) entries."""
        n = len(ids)
        if not n or not len(term):
            return
        size = np.diff(ptr)
        doc = np.repeat(np.arange(n), size)
        # documents whose heaviest terms agree share a leaf
        by_weight = np.lexsort((-impact, doc))
        lead = np.full(n, -1)
        some = size > 0
        lead[some] = term[by_weight[ptr[:-1][some]]]
        order = np.lexsort((size, lead))
        order = order[size[order] > 0]                 # the others score nothing
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.arange(len(order))
        at = np.argsort(rank[doc], kind="stable")
        term, impact, doc = term[at], impact[at], rank[doc[at]]
        ids, n = ids[order], len(order)
        ptr = np.concatenate([[0], np.cumsum(size[order])])

        nodes = [np.zeros((-(-n // LEAF_DOCS), self.q.shape[1]))]
        np.maximum.at(nodes[0], (doc // LEAF_DOCS, term), impact)
        while len(nodes[0]) > 1:
            nodes.insert(0, np.maximum.reduceat(nodes[0], np.arange(0, len(nodes[0]), FAN), axis=0))
        self._score_leaves(self._descend(nodes), ids, ptr, term, impact)

    def _weakest(self, level: int) -> np.ndarray:
        return np.minimum.reduceat(self.kth, self.levels[level][:-1])

    def _descend(self, nodes: list[np.ndarray]) -> np.ndarray:
        """Bounds of (item leaf, document leaf); -1 where a pair of nodes above was pruned."""
        i = j = 0
        alive = np.ones((1, 1), dtype=bool)
        while True:
            rows, cols = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
            bound = np.full(alive.shape, -1.0)
            bound[np.ix_(rows, cols)] = self.maxima[i][rows] @ nodes[j][cols].T
            # sums beyond 2^53 may round: a hair's breadth on the safe side
            alive &= bound * (1 + 1e-9) >= self._weakest(i)[:, None]
            if i == len(self.maxima) - 1 and j == len(nodes) - 1:
                return np.where(alive, bound, -1.0)
            if i < len(self.maxima) - 1:
                parents = np.searchsorted(self.levels[i], self.levels[i + 1][:-1], side="right") - 1
                alive, i = alive[parents], i + 1
            if j < len(nodes) - 1:
                alive, j = alive[:, np.arange(len(nodes[j + 1])) // FAN], j + 1

    def _score_leaves(self, bound, ids, ptr, term, impact) -> None:
        leaf_of = np.searchsorted(self.levels[-1], np.arange(len(self.q)), side="right") - 1
        best = bound.max(0)
        order = np.argsort(-best, kind="stable")
        order = order[best[order] >= 0]
        for a in range(0, len(order), FAN):
            weakest, found = self._weakest(len(self.levels) - 1), []
            for leaf in order[a:a + FAN]:
                items = np.flatnonzero((bound[:, leaf] * (1 + 1e-9) >= weakest)[leaf_of])
                if not len(items):
                    continue
                lo, hi = leaf * LEAF_DOCS, min((leaf + 1) * LEAF_DOCS, len(ids))
                e = slice(ptr[lo], ptr[hi])
                scores = np.add.reduceat(self.q[items][:, term[e]] * impact[e], ptr[lo:hi] - ptr[lo], axis=1)
                self.scored += scores.size
                x, y = np.nonzero(scores >= self.kth[items][:, None])
                found.append((items[x], ids[lo + y], scores[x, y]))
            if found:
                self._merge(found)

    def _merge(self, found: list) -> None:
        item = np.concatenate([self.item, *[f[0] for f in found]])
        doc = np.concatenate([self.doc, *[f[1] for f in found]])
        score = np.concatenate([self.score, *[f[2] for f in found]])
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        top = rank < self.k
        self.item, self.doc, self.score = item[top], doc[top], score[top]
        full = rank == self.k - 1
        self.kth[item[full]] = np.maximum(score[full], 1)

    def answers(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item position, document id, score)"""
        return self.place[self.item], self.doc, self.score


def impacts(term: np.ndarray, tf: np.ndarray, n: np.ndarray, weights: np.ndarray, docs: int, total: int) -> np.ndarray:
    """Whole-number impact of each entry: weight times saturated, length-normalised count."""
    m = 100 - 25 + (25 * n * docs) // total
    return weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def _search(q: np.ndarray, weights: np.ndarray, docs: int, total: int, k: int):
    """Batches of entries -> at most ``k`` (pos, doc_id, score) an item."""
    most = max(1, DENSE_BYTES // (8 * q.shape[1] * LEAF_DOCS)) * LEAF_DOCS
    most = min(most, 1 << 13)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(q, k)
        for whole in batches:
            for a in range(0, whole.num_rows, most):
                batch = whole.slice(a, most)
                terms, tfs = batch.column(2), batch.column(3)
                ptr = np.concatenate([[0], np.cumsum(pc.list_value_length(terms).to_numpy(zero_copy_only=False))]).astype(np.int64)
                term = terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                tf = tfs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                n = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), np.diff(ptr))
                ids = pc.fill_null(batch.column(0), NULL_ID).to_numpy(zero_copy_only=False)
                value = impacts(term, tf, n, weights, docs, total)
                some = value > 0                           # a term of weight 0 adds nothing
                if not some.all():
                    ptr = np.concatenate([[0], np.cumsum(some)])[ptr]
                    term, value = term[some], value[some]
                search.feed(ids, ptr, term, value)
        pos, doc, score = search.answers()
        yield pa.RecordBatch.from_arrays([
            pa.array(pos.astype(np.int32)), pa.array(doc, mask=doc == NULL_ID), pa.array(score)],
            names=["pos", "doc_id", "score"])
    return run


def _search_block(docs: DataFrame, rows: list, k: int) -> DataFrame | None:
    ids, vocabulary, q = item_vectors(rows)
    if not ids:
        return None
    spark = docs.sparkSession
    entries = cut(docs.mapInArrow(_entries(vocabulary), "doc_id long, n long, terms array<int>, tfs array<int>"),
                  "lexical-entries")
    n_docs, total = entries.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for term, n in entries.select(F.explode("terms").alias("t")).groupBy("t").count().collect():   # of this vocabulary
        df[term] = n
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)
    found = entries.mapInArrow(_search(q, weights, n_docs, total, k), "pos int, doc_id long, score long")
    best = Window.partitionBy("pos").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "pos int, item_id long")     # one block's
    return ranked.join(F.broadcast(names), "pos").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents with a score above 0 of every item."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = (items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
                  .where(F.col("text").isNotNull()).distinct())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out = None
    for b in range(blocks):
        found = _search_block(docs, items.where(block == b).orderBy("item_id", "text").collect(), k)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame(
        [], "item_id long, rank int, doc_id long, score long")
