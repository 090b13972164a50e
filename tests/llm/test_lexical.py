"""Operator 11 against brute force, and what its bounds leave out."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

import roomlake.llm.lexical as L
from roomlake.llm.lexical import Search, ranked_search, text_terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, c, sum(c.values())) for i, c in bags if c]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    out = Counter()
    for item, text in {(i, t) for i, t in items if t is not None}:
        scores = []
        for i, c, n in bags:
            m = 100 - 25 + (25 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        for rank, (s, _, _, i) in enumerate(sorted(scores)[:k], 1):
            out[(item, rank, i, -s)] += 1
    return out


def test_terms():
    import pyarrow as pa

    texts = ["Ab-cd", None, "", "x", "yÉz 9 Ünd q", "  ", "\x7f{A}[b]`c@d:e/f", "日本 語"]
    got, n = text_terms(pa.array(texts))
    assert n.tolist() == [len(terms(t)) for t in texts]
    assert [t.decode() for t in got.to_pylist()] == [t for x in texts for t in terms(x)]
    assert len(text_terms(pa.array([], pa.string()))[0]) == 0


@pytest.mark.parametrize("k,block", [(20, 1 << 18), (3, 200)])
def test_small_documents(spark, docs, doc_rows, k, block):
    items = [(7, "the Cat sat"), (1, "été größer naïve the the"), (2, None), (3, ""), (4, "nothingofthiskind"), (7, "the Cat sat"),
             (9, " ".join(f"w{i}" for i in range(20))), (None, "niño 42"), (5, "!!"), (6, "日本語 x1 y z")]
    df = spark.createDataFrame(items, ITEMS)
    got = Counter(map(tuple, ranked_search(docs, df, k, block_bytes=block).collect()))
    assert got == brute([r[:2] for r in doc_rows], items, k)


def test_empty(spark, docs, no_docs):
    assert ranked_search(no_docs, spark.createDataFrame([(1, "the")], ITEMS)).collect() == []
    assert ranked_search(docs, spark.createDataFrame([], ITEMS)).collect() == []


def corpus(rnd, n):
    vocab = [f"t{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    topics = [rnd.sample(vocab, 12) for _ in range(30)]
    rows = [(i, " ".join(rnd.choices(vocab, weights, k=rnd.randint(1, 80)) + rnd.choices(topics[i % 30], k=15))) for i in range(n)]
    rows += [(n + i, rows[5][1]) for i in range(40)]                   # ties beyond k
    items = [(j, " ".join(rnd.choices(topics[j % 30], k=8) + rnd.choices(vocab, weights, k=4))) for j in range(60)]
    return rows, items + [(100, rows[5][1])]


def test_many_documents(spark):
    rows, items = corpus(random.Random(3), 1500)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter(map(tuple, ranked_search(docs, spark.createDataFrame(items, ITEMS)).collect()))
    assert got == brute(rows, items, 20)


def test_bounds_prune_and_stay_exact():
    rnd = np.random.default_rng(1)
    topics, docs, items = 40, 8000, 64
    q = np.zeros((items, topics * 5), dtype=np.int64)
    for i in range(items):
        q[i, (i % topics) * 5:(i % topics) * 5 + 5] = 1 + rnd.integers(0, 3, 5)
    search, dense = Search(q, 10), np.zeros((docs, topics * 5), dtype=np.int64)
    for d in range(docs):
        own = rnd.integers(0, topics)
        dense[d, own * 5 + rnd.integers(0, 5, 3)] = rnd.integers(1, 10 ** 9, 3)
    for a in range(0, docs, 2000):
        x, y = np.nonzero(dense[a:a + 2000])
        ptr = np.searchsorted(x, np.arange(2001))
        search.feed(np.arange(a, a + 2000), ptr, y, dense[a:a + 2000][x, y])
    pos, doc, score = search.answers()
    true = q @ dense.T
    for i in range(items):
        best = sorted((-s, d) for d, s in enumerate(true[i]) if s > 0)[:10]
        assert sorted(zip((-score[pos == i]).tolist(), doc[pos == i].tolist())) == best
    assert search.scored < 0.3 * items * docs


def test_dense_maxima_are_bounded(monkeypatch, spark):
    monkeypatch.setattr(L, "DENSE_BYTES", 1)                           # one leaf of documents at a time
    rows, items = corpus(random.Random(4), 200)
    run = L._search(*_block(rows, items), 20)
    assert sum(b.num_rows for b in run(iter(_batches(rows, items)))) == sum(brute(rows, items, 20).values())


def _block(rows, items):
    _, vocabulary, q = L.item_vectors(sorted(set(items)))
    n = [len(terms(t)) for _, t in rows]
    df = Counter(t for _, x in rows for t in set(terms(x)))
    w = [math.floor(1000 * math.log((2 * len(rows) + 2) / (2 * df[v.decode()] + 1))) for v in vocabulary]
    return q, np.array(w, dtype=np.int64), len(rows), sum(n)


def _batches(rows, items):
    import pyarrow as pa

    _, vocabulary, _ = L.item_vectors(sorted(set(items)))
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["doc_id", "text"])
    return L._entries(vocabulary)(iter([batch]))
