"""Operators 2, 4 and 5 against brute force."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

import roomlake.llm.embeddings as E
import roomlake.llm.simhash as S
import roomlake.llm.substrings as B
from roomlake.llm.components import components

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


class Classes(dict):
    def root(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self[max(a, b)] = min(a, b)


def brute_substrings(rows, window):
    seen, words = Counter(), [WORDS.findall((t or "").encode()) for _, t in rows]
    for w in words:
        seen.update(tuple(w[i:i + window]) for i in range(len(w) - window + 1))
    out = Counter()
    for (id_, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[(id_, len(w), len(gone), hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("window,mer", [(35, 8), (5, 2), (3, 3)])
def test_substrings(docs, doc_rows, window, mer):
    got = Counter(map(tuple, B.substring_dedup(docs, window=window, mer=mer).collect()))
    assert got == brute_substrings([r[:2] for r in doc_rows], window)


def test_substrings_random_and_large_buckets(spark, monkeypatch):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 60)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_substrings(rows, 7)
    assert Counter(map(tuple, B.substring_dedup(df, window=7, mer=3).collect())) == want
    monkeypatch.setattr(B, "BUCKET_STRINGS", 2)         # counted as rows instead
    assert Counter(map(tuple, B.substring_dedup(df, window=7, mer=3).collect())) == want


def test_substrings_empty(no_docs):
    assert B.substring_dedup(no_docs).collect() == []


def test_remove_repeats(docs, doc_rows):
    got = B.remove_repeats(docs)
    assert got.columns == docs.columns and got.count() == len(doc_rows)
    texts = {r["doc_id"]: r["text"] for r in got.collect() if r["doc_id"] is not None}
    by_id = {r[0]: r[1] for r in doc_rows}
    marked = [i for i, t in by_id.items() if t and t.startswith("before w0")]
    assert texts[marked[0]] == "before after words"
    assert texts[24] == by_id[24]


def brute_fingerprint(text):
    w = WORDS.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs, doc_rows, no_docs):
    fps = [brute_fingerprint(r[1]) for r in doc_rows]
    classes = Classes()
    for a in fps:
        for b in fps:
            if bin(a ^ b).count("1") <= 2:
                classes.link(a, b)
    least = {}
    for r, f in zip(doc_rows, fps):
        if r[0] is not None:
            least[classes.root(f)] = min(r[0], least.get(classes.root(f), r[0]))
    want = Counter((r[0], f, least.get(classes.root(f))) for r, f in zip(doc_rows, fps))
    got = S.simhash_groups(docs).collect()
    assert Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got) == want
    assert S.simhash_groups(no_docs).collect() == []
    kept = S.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({classes.root(f) for f in fps})


@pytest.mark.parametrize("limit", [1500, 12])
def test_hamming_links(spark, monkeypatch, limit):
    """Large buckets are split, and every class stays whole."""
    monkeypatch.setattr(S, "BUCKET_ROWS", limit)
    rnd = random.Random(4)
    seeds = [rnd.getrandbits(64) for _ in range(20)]
    fps = sorted({s ^ (1 << rnd.randrange(8)) ^ (1 << rnd.randrange(64)) * rnd.randrange(2) for s in seeds for _ in range(15)})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    for parts in ((2,), (3,), (4,)):
        classes, want = Classes(), Classes()
        for r in S.hamming_links(df, 2, parts).collect():
            u, v = r["u"] % (1 << 64), r["v"] % (1 << 64)
            assert bin(u ^ v).count("1") <= 64 and u in fps and v in fps
            classes.link(u, v)
        for i, a in enumerate(fps):
            for b in fps[:i]:
                if bin(a ^ b).count("1") <= 2:
                    want.link(a, b)
        assert {f: classes.root(f) for f in fps} == {f: want.root(f) for f in fps}


def test_thresholds_are_optimal():
    costs = [[0, 5, 9, 30], [0, 1, 2, 3], [0, 8, 8, 8]]
    best = S.allocate(costs, 0)
    assert sum(best) == 0
    every = [(a, b, c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == 0]
    price = lambda t: sum(costs[i][x + 1] for i, x in enumerate(t))
    assert price(best) == min(map(price, every))


def test_components(spark):
    rnd = random.Random(6)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    classes = Classes()
    for a, b in edges:
        classes.link(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: classes.root(x) for x in nodes}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def vectors():
    rng = np.random.default_rng(8)
    base = rng.normal(size=(12, 24))
    rows = [b + rng.normal(scale=s, size=24) for b in base for s in (0, 0.02, 0.1, 0.2, 0.3)]
    rows += [rows[0], rows[0], 3.0 * rows[5], -rows[7]]
    rows = [[float(np.float32(x)) for x in r] for r in rows]
    odd = [None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] * 24, [float("inf")] + [0.0] * 23, [1.0, 2.0]]
    return [(i, r) for i, r in enumerate(rows + odd)] + [(3, rows[2]), (None, rows[4])]


@pytest.mark.parametrize("cell_rows", [10_000, 5])
def test_embeddings(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(E, "CELL_ROWS", cell_rows)
    rows = vectors()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, node string, links int")
    got = E.embedding_duplicates(df).collect()
    fine = [(i, k) for k, (i, x) in enumerate(rows) if x and len(x) == 24 and None not in x
            and np.isfinite(x).all() and any(x)]
    unit = {k: np.array(rows[k][1]) / np.linalg.norm(rows[k][1]) for _, k in fine}
    classes, links = Classes(), Counter()
    for _, a in fine:
        for _, b in fine:
            if a != b and float(unit[a] @ unit[b]) >= 0.95:
                links[a] += 1
                classes.link(a, b)
    least = {}
    for i, k in fine:
        if i is not None:
            least[classes.root(k)] = min(i, least.get(classes.root(k), i))
    want = Counter()
    for k, (i, _) in enumerate(rows):
        c = least.get(classes.root(k)) if links[k] else i
        want[(i, links[k], c, i is not None and i == c)] += 1
    assert Counter(tuple(r) for r in got) == want
    assert E.embedding_duplicates(df.limit(0)).collect() == []
