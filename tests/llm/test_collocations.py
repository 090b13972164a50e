"""Operator 12 against brute force; the filters it counts with."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import roomlake.llm.collocations as C
from roomlake.llm import quotient as Q

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, max_words, min_count, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = Counter()
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) >= 2 and a >= min_count}
        covered = {}
        for p, a in cand.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        covered[p[i:j]] = max(covered.get(p[i:j], 0), a)
        best = []
        for p, a in cand.items():
            if 100 * covered.get(p, -1) >= 100 * a:
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(best)[:top], 1):
            out[(lang, rank, p.decode(), -a, l, r, n[lang], -s)] += 1
    return out


@pytest.mark.parametrize("bits", [64, 63, 40, 23, 13])
def test_filters_are_lossless(bits):
    rnd = np.random.default_rng(2)
    top = (1 << bits) - 1
    keys = np.unique(np.concatenate([rnd.integers(0, min(top, 1 << 62), 5000).astype(np.uint64), np.arange(300, dtype=np.uint64),
                                     np.array([0, top, 1 << (bits - 1)], dtype=np.uint64)]))
    x = np.sort(Q.permute(keys, bits))
    assert len(np.unique(x)) == len(keys) and x.max() <= top
    assert (np.sort(Q.restore(x, bits)) == keys).all() and (Q.restore(Q.permute(keys, bits), bits) == keys).all()
    for range_bits in (0, 3, 9):
        counts = rnd.integers(1, 400, len(x))
        counts[7] = 10 ** 15
        ranges = Q.range_of(x, range_bits, bits)
        for r in range(1 << range_bits):
            own = ranges == r
            got, n = Q.decode(Q.encode(x[own], counts[own], range_bits, bits), r)
            assert (got == x[own]).all() and (n == counts[own]).all()
    plain = len(Q.encode(x, np.ones(len(x), np.int64), 0, bits))
    assert plain < (bits / 8 - 0.4) * len(x)                 # less than the keys alone


def test_filters_merge():
    rnd = np.random.default_rng(3)
    shards, true = [], Counter()
    for _ in range(9):
        keys, counts = np.unique(rnd.integers(0, 500, 300).astype(np.uint64), return_counts=True)
        true.update(dict(zip(keys.tolist(), counts.tolist())))
        x = Q.permute(keys)
        order = np.argsort(x)
        shards.append((x[order], counts[order]))
    x, total, place = Q.merge(shards)
    assert dict(zip(Q.restore(x).tolist(), total.tolist())) == true
    assert (x[place] == np.concatenate([s[0] for s in shards])).all()
    assert len(Q.merge([])[0]) == 0


def corpus(rnd):
    vocab = ["new", "York", "city", "hall", "the", "of", "a", "süß", "niño", "x-1", "9"]
    rows = []
    for i in range(400):
        words = []
        for _ in range(rnd.randint(0, 60)):
            words.append(rnd.choice(vocab) + rnd.choice(["", "", "", "", ",", ". ", "\n", "\t", "!", " \x0b"]))
            if rnd.random() < 0.2:
                words.append("new york city hall")
            if rnd.random() < 0.05:
                words.append("one two three four five six seven")
        rows.append((" ".join(words), ["en", "de", None, "und"][i % 4]))
    return rows + [rows[0]] * 30 + [(None, "en"), ("", None), ("   ", "xx"), ("...", "xx"), ("lonely", "xx")]


@pytest.mark.parametrize("max_words,min_count,top,shard,words", [(5, 10, 2000, 1 << 23, 1 << 21), (5, 3, 40, 700, 100), (3, 1, 2000, 2000, 500),
                                                              (2, 5, 10, 300, 1 << 21)])
def test_collocations(spark, max_words, min_count, top, shard, words):
    rows = corpus(random.Random(6))
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = Counter(map(tuple, C.collocations(df, max_words=max_words, min_count=min_count, top=top,
                                               shard_bytes=shard, range_words=words).collect()))
    assert got == brute(rows, max_words, min_count, top)


def test_odd_documents(docs, doc_rows, no_docs):
    got = Counter(map(tuple, C.collocations(docs, min_count=2).collect()))
    assert got == brute([(r[1], r[2]) for r in doc_rows], 5, 2, 2000)
    assert C.collocations(no_docs).collect() == []


def test_products_beyond_64_bits(spark):
    phrases = spark.createDataFrame([("en", 1, "a", 10 ** 13), ("en", 1, "b", 3 * 10 ** 12), ("en", 2, "a b", 2 * 10 ** 12 + 1)],
                                    "lang string, size int, phrase string, a long")
    totals = spark.createDataFrame([("en", 10 ** 15 + 7)], "lang string, n long")
    r = C.scored_phrases(phrases, totals).first()
    assert r.score == 1000 * (2 * 10 ** 12 + 1) * (10 ** 15 + 7) // (3 * 10 ** 25)
