"""Operator 5: what it writes and shuffles, its cells, parts and rounds, against brute force."""
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import roomlake.llm.embeddings as E


def near_copies(seed, dims, groups, loose=8):
    """Rows (id, vector): groups of near and of exact copies around random vectors, and vectors of their own."""
    rng = np.random.default_rng(seed)
    rows = []
    for d in dims:
        for g in groups:
            base = rng.normal(size=d)
            for i in range(g):
                rows.append(base + rng.normal(scale=(0, 0.1, 0.25, 0.35)[i % 4], size=d))
        rows += list(rng.normal(size=(loose, d)))
    return [(i, [float(np.float32(x)) for x in rows[j]]) for i, j in enumerate(rng.permutation(len(rows)))]


def brute(rows, cosine=0.95):
    links, component = Counter(), {i: i for i, _ in rows}
    for d in {len(x) for _, x in rows}:
        ids = np.array([i for i, x in rows if len(x) == d])
        u = np.array([x for _, x in rows if len(x) == d])
        u /= np.sqrt((u * u).sum(axis=1, keepdims=True))
        hit = u @ u.T >= cosine
        np.fill_diagonal(hit, False)
        links.update(dict(zip(ids.tolist(), hit.sum(axis=1).tolist())))
        label = ids.copy()
        while True:
            new = np.array([min(label[i], *label[h]) if h.any() else label[i] for i, h in enumerate(hit)])
            if (new == label).all():
                break
            label = new
        component.update(zip(ids.tolist(), label.tolist()))
    return Counter((i, links[i], component[i], component[i] == i) for i, _ in rows)


@pytest.mark.parametrize("cells,classes,digests", [(150_000, 4096, None), (25, 4096, None), (25, 2, 3), (150_000, 2, 1)])
def test_cells_rounds_and_large_classes(spark, monkeypatch, cells, classes, digests):
    """Cells dealt to several tasks and rounds, large classes by cells again, vectors that share a digest."""
    monkeypatch.setattr(E, "CELL_ROWS", cells)
    monkeypatch.setattr(E, "ROUND_LEAST", 1)
    monkeypatch.setattr(E, "CLASS_ROWS", classes)
    if digests:
        monkeypatch.setattr(E, "_digest", lambda v: F.pmod(F.xxhash64(v), F.lit(digests)))
    rows = near_copies(3, (24, 64, 3, 1, 70), (2, 5, 40), loose=30)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    assert Counter(map(tuple, E.embedding_duplicates(df).collect())) == brute(rows)


@pytest.mark.parametrize("cosine", [1.0, 0.99, 0.6])
def test_other_thresholds(spark, monkeypatch, cosine):
    monkeypatch.setattr(E, "CELL_ROWS", 40)
    rows = near_copies(4, (16, 600), (3, 12))
    rows += [(len(rows), rows[0][1]), (len(rows) + 1, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = Counter(map(tuple, E.embedding_duplicates(df, cosine=cosine).collect()))
    assert got == brute(rows, min(cosine, 1 - 1e-12))


@pytest.mark.parametrize("probes", [0, 900])
def test_shells_meet_every_near_pair_once(monkeypatch, probes):
    monkeypatch.setattr(E, "CHUNK", 128)
    monkeypatch.setattr(E, "SHELL", 16)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700 + probes, 12)).astype(np.float32) / 8
    own, probe = x[:700], x[700:] if probes else None
    order, tiles = E._shells(own, probe, 0.2)
    met = Counter()
    for near, s, e in tiles:
        for p in near.tolist():
            met.update((p, y) for y in range(s, e) if probes or p < y)
    other = probe if probes else own[order]
    far = np.sqrt(((other[:, None] - own[order]) ** 2).sum(axis=2))
    close = {(p, y) for p, y in zip(*map(np.ndarray.tolist, np.nonzero(far <= 0.2))) if probes or p < y}
    assert close and close <= set(met) and max(met.values()) == 1
    assert len(met) < 0.8 * len(own) * (probes or len(own) / 2)


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    paths = [files.apply(i).getPath() for i in range(files.size())]
    return {p: os.path.getsize(p) for p in paths if "shuffle_" in p and os.path.exists(p)}


def _bytes(path):
    path = path.removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs)


def test_disk_stays_within_a_few_times_the_vectors(spark, monkeypatch):
    """Tables written and shuffles kept, whenever a table is written and at the end (F1, round 4)."""
    n, d = 6000, 64
    rng = np.random.default_rng(6)
    x = rng.normal(size=(n, d))
    x[n // 2:n // 2 + 900] = x[:900] + rng.normal(scale=0.1, size=(900, d))
    df = spark.createDataFrame([(i, r) for i, r in enumerate(x.astype(np.float32).tolist())],
                               "vec_id long, embedding array<float>").repartition(4).persist()
    df.count()
    before, kept, real = set(_shuffle_files(spark)), {}, E.cut
    most = []

    def cut(frame, name, **options):
        out = real(frame, name, **options)
        kept[out._cut_path] = 0
        shuffled = sum(s for p, s in _shuffle_files(spark).items() if p not in before)
        most.append(sum(_bytes(p) for p in kept) + shuffled)
        return out

    monkeypatch.setattr(E, "cut", cut)
    monkeypatch.setattr(E, "ROUND_LEAST", 1, raising=False)
    monkeypatch.setattr(E, "CELL_ROWS", 2000)
    out = E.embedding_duplicates(df)
    assert max(most) < 4 * n * (4 * d + 8)
    assert sum(s for p, s in _shuffle_files(spark).items() if p not in before) < n * (4 * d + 8) / 4
    assert out.where("n_links > 0").count() == 1800
    df.unpersist()
