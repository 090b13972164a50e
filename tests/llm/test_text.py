"""Operators 6, 8, 9 and 10."""
import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from roomlake.llm import queries as Q
from roomlake.llm.language import GramVectors, grams, identify, language_predictions, learn_prototypes
from roomlake.llm import lzprint as L
from roomlake.llm.lzprint import likeness, neighbour_likeness, parse, signature, to_text
from roomlake.llm.oracle import ORACLE_SQL
from roomlake.llm.toxicity import (Lexicon, Matcher, fit_logistic, learn_toxicity, pick_terms, sample_labels,
                                   toxicity_predictions)
from roomlake.llm.urls import url_verdicts


def test_language_held_out(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    got = language_predictions(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert len(got) == docs.count()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() >= 0.95 and got.score.between(0, 1).all()


def test_language_edge_cases(docs, no_docs, doc_rows):
    got = language_predictions(docs).collect()
    assert len(got) == len(doc_rows)
    letters = {r[0]: any(c.isalpha() for c in r[1] or "") for r in doc_rows if r[0] is not None}
    for r in got:
        if r["doc_id"] is not None:
            assert (r["lang_pred"] == "und") == (not letters[r["doc_id"]])
    assert language_predictions(no_docs).collect() == []
    named = identify(docs, {}).select("doc_id", "lang_pred", "score").collect()
    assert {(r["lang_pred"], r["score"]) for r in named} == {("und", 0.0)}


def test_gram_vectors_bind_and_bundle():
    v = GramVectors(64)
    codes, n = grams("Abc abd")
    got = v.bundle(codes, n)
    seq = [0, *map(ord, "abc"), 0, *map(ord, "abd"), 0]
    want = sum((np.roll(v.letter(a), 2) * np.roll(v.letter(b), 1) * v.letter(c) for a, b, c in zip(seq, seq[1:], seq[2:])),
               np.zeros(64))
    assert (got == want).all()


def test_prototypes_match_brute_force(spark):
    rows = [("en", "the cat"), ("en", "a hat"), ("de", "die Katze"), (None, "xx"), ("fr", None), ("es", "123")]
    got = learn_prototypes(spark.createDataFrame(rows, "lang string, text string"), dimensions=128)
    v = GramVectors(128)
    assert sorted(got) == ["de", "en"]
    for lang in got:
        total = np.zeros(128)
        for x, t in rows:
            if x == lang:
                codes, n = grams(t)
                total += v.bundle(codes, n / n.sum())
        assert np.allclose(got[lang], total / np.linalg.norm(total), atol=1e-5)


def test_url_verdicts(spark):
    urls = [None, "", "nothing", "http://", "http://a.net", "http://a.net/", "HTTP://X.A.NET/q?x#y", "https://example.net/en/1",
            "https://www.example.net/en/1?z", "https://badexample.net/en/", "https://example.com/de/x", "https://example.com/de",
            "http://x.org/fr/", "http://x.org/fr", "http://org/fr/a", "http://a.net?x=/", "http://a.net:80/", "a://b://net/",
            "http://u@example.com/de/", "http://.net/", "http://a..net/x", "http://a.net/", "http://é.net/ü"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(5, urls[5]), (None, urls[7])]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS host", "'y' AS verdict")
    rules = spark.createDataFrame(Q.URL_RULES + [Q.URL_RULES[0], (None, "/", "block")],
                                  "rule_host string, rule_path string, action string")
    got = url_verdicts(pages, rules).select("page_id", "host", "path", "rule", "verdict").collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", rows)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, con.execute(ORACLE_SQL["op8_url_filters"]).fetchall()))
    assert url_verdicts(pages.limit(0), rules).collect() == []
    assert {r["verdict"] for r in url_verdicts(pages, rules.limit(0), default="block").collect()} == {"block"}


def test_urls_of_many_slashes_and_labels(spark):
    """What a URL expands to depends on the rules' lengths, not on its slashes or labels."""
    from roomlake.llm.urls import expand

    rules = spark.createDataFrame([("net", "/", "block"), ("b.net", "/////", "allow"), ("a.b.net", "//x", "block")],
                                  "rule_host string, rule_path string, action string")
    pages = spark.createDataFrame([(1, "http://c.b.net" + "/" * 100_000), (2, "http://" + "l." * 5_000 + "a.b.net//x" + "/y" * 5_000),
                                   (3, "http://b.net////x"), (4, "http://xb.net/"), (5, "http://net"), (6, "http:///////")],
                                  "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_verdicts(pages, rules).collect()}
    assert got == {1: ("b.net/////", "allow"), 2: ("a.b.net//x", "block"), 3: ("net/", "block"), 4: ("net/", "block"), 5: (None, "allow"),
                   6: (None, "allow")}
    pairs = spark.createDataFrame([("l." * 5_000 + "b.net", "/" * 100_000)], "_host string, _path string")
    assert expand(pairs, [3, 5, 7], [1, 3, 5]).count() == 9


def test_url_rules_without_final_slash(spark):
    pages = spark.createDataFrame([(1, "http://a.com/abcd/e"), (2, "http://a.com/ab"), (3, "http://a.com/a")], "page_id long, url string")
    rules = spark.createDataFrame([("com", "/ab", "block"), ("a.com", "/abc", "allow")], "rule_host string, rule_path string, action string")
    got = {r["page_id"]: r["rule"] for r in url_verdicts(pages, rules).collect()}
    assert got == {1: "a.com/abc", 2: "com/ab", 3: None}


def brute_phrases(text):
    seen, a = set(), 0
    for b in range(1, len(text) + 1):
        if text[a:b] not in seen:
            seen.add(text[a:b])
            a = b
    return seen


def test_parse_is_lz78():
    rnd = random.Random(1)
    for n in (0, 1, 2, 3, 10, 100, 2000):
        text = "".join(rnd.choice("abcé") for _ in range(n))
        seen, ends = set(), []
        parse(text, 0, seen, ends)
        assert seen == brute_phrases(text) and len(ends) == len(seen)


def test_likeness_estimates_phrase_overlap():
    rnd = random.Random(2)
    a = "".join(rnd.choice("abcd ") for _ in range(6000))
    b = a[:4000] + "".join(rnd.choice("wxyz ") for _ in range(2000))
    x, y = brute_phrases(a), brute_phrases(b)
    assert abs(likeness(signature(a), signature(b)) - len(x & y) / len(x | y)) < 0.15
    assert likeness(signature(""), signature("")) == 1.0
    assert likeness(signature(""), signature("abc")) == 0.0


def test_signature_is_the_least_hash_of_each_bin():
    text = "abé日 abé 😀 abab é"
    phrases = brute_phrases(text)
    want = np.full(L.BINS, L.EMPTY)
    for x in phrases:
        h = int(L.hash_spans(x.encode(), np.array([0]), np.array([len(x.encode())]))[0])
        want[h >> 57] = min(want[h >> 57], min(h >> 41 & 0xFFFF, L.EMPTY - 1))
    assert (signature(text) == want).all()


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_neighbours(docs, doc_rows, ranges, monkeypatch):
    import xxhash

    monkeypatch.setattr(L, "GROUP_CHARS", 300)

    got = neighbour_likeness(docs, ranges=ranges).collect()
    key = lambda r: (-(1 << 63) if r[0] is None else r[0],
                     np.uint64(xxhash.xxh64_intdigest((r[1] or "").encode(), 42)).astype(np.int64))
    order = sorted(doc_rows, key=key, reverse=True)
    want = []
    for i, r in enumerate(order):
        text, after = r[1] or "", order[(i + 1) % len(order)][1] or ""
        k = len(text) // 3
        edited = text[:len(text) - k] + after[:k]
        p, e = signature(text), signature(edited)
        want.append((r[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), to_text(p),
                     to_text(e), likeness(p, e), likeness(p, signature(after))))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_neighbours_of_one_and_none(spark, no_docs):
    one = neighbour_likeness(spark.createDataFrame([(4, "abcdef")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()
    assert neighbour_likeness(no_docs).collect() == []


def edits(word):
    letters = "abcdefghijklmnopqrstuvwxyz"
    out = {word[:i] + word[i + 1:] for i in range(len(word))}
    out |= {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in letters}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return out | {word[:i] + word[i + 1] + word[i] + word[i + 2:] for i in range(len(word) - 1)}


def test_automaton_accepts_exactly_one_edit():
    terms = ["idiot", "scum", "stupid", "lowei*", "tri", "trial"]
    lexicon = Lexicon(terms)
    near = {x for t in ("idiot", "stupid", "trial") for x in edits(t)} | {"scum", "tri"}
    rnd = random.Random(3)
    some = {"".join(rnd.choice("idotscumprla") for _ in range(rnd.randint(1, 7))) for _ in range(3000)}
    stem = edits("lowei") | {"lowei"}
    for w in near | some:
        found = lexicon.match(w)
        starts = any(w.startswith(s) for s in stem)
        assert (found is not None) == (w in near or starts), w
    assert lexicon.match("idiot") == ("idiot", 0) and lexicon.match("loweischaft") == ("lowei*", 0)


def test_quotation_weighs_less():
    m = Matcher({"idiot": 5.0})
    abuse = m.features("you are an idiot and that is all")
    quoted = m.features('she wrote "you are an idiot" in the book')
    reported = m.features('he called him an idiot, said the "paper" there')
    assert abuse[0] > quoted[0] and abuse[0] > reported[0] > 0


def test_terms_need_evidence():
    assert pick_terms([("rare", 3, 0), ("good", 400, 1), ("both", 300, 900)], 20_000, 80_000).keys() == {"good"}


def test_toxicity_held_out(spark, doc_rows):
    rnd = random.Random(9)
    words = ["bread", "house", "river", "green", "walk", "seven", "music", "paper", "stone", "light"]
    rows, labels = [], []
    for i in range(900):
        t = [rnd.choice(words) for _ in range(rnd.randint(5, 60))]
        bad = i % 5 == 0
        for _ in range(4 if bad else 0):
            t.insert(rnd.randrange(len(t)), rnd.choice(["idiot", "moron", "scum"]))
        rows.append((i, " ".join(t), "en", "s", 0))
        labels.append((i, 1, int(bad)))
    rows += [(10_000 + k, r[1], r[2], r[3], r[4]) for k, r in enumerate(doc_rows)]
    rows.append((20_000, "the idoit and the morom are scum moron", "en", "s", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lab = spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity_predictions(docs, lab).collect()}
    assert len(got) == len(rows)
    for i, _, bad in labels:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert got[i]["predicted"] == bad
    assert got[20_000]["predicted"] == 1
    assert all(got[10_000 + k]["predicted"] == 0 for k in range(len(doc_rows)))


def test_toxicity_without_labels(docs, no_docs, spark, labels_schema):
    none = spark.createDataFrame([], labels_schema)
    assert {r["predicted"] for r in toxicity_predictions(docs, none).collect()} == {0}
    assert toxicity_predictions(no_docs, none).collect() == []


def test_fit_counts_a_row_for_those_it_stands_for():
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(300, 2))
    y = (x[:, 0] + rnd.normal(size=300) > 0.5).astype(float)
    n = rnd.integers(1, 6, 300)
    assert np.allclose(fit_logistic(x, y, rows=n.astype(float)), fit_logistic(np.repeat(x, n, 0), np.repeat(y, n)))
    assert np.allclose(fit_logistic(x, y), fit_logistic(x, y, rows=np.ones(300)))


def test_thinning_a_class_leaves_scores(spark):
    """Clean labels beyond the cap: a text's log-odds stay near those learned from all labels."""
    rnd = random.Random(12)
    words = ["bread", "house", "river", "green", "walk", "seven", "music", "paper", "stone", "light"]
    rows, labels = [], []
    for i in range(12_000):
        t = [rnd.choice(words) for _ in range(rnd.randint(10, 60))]
        bad = i % 20 == 0
        for _ in range(rnd.randint(0, 3) if bad else int(rnd.random() < 0.05)):
            t.insert(rnd.randrange(len(t)), rnd.choice(["idiot", "moron", "stupid"]))
        rows.append((i, " ".join(t)))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    cap = 600                                           # all toxic training rows, about a thirteenth of the clean ones
    thin = sample_labels(lab, cap).toPandas()
    clean = thin[thin.toxic == 0]
    want = sum(1 for i, _, bad in labels if not bad and zlib.crc32(str(i).encode()) % 3 != 1)
    assert (thin[thin.toxic == 1].stands_for == 1).all() and len(clean) < 2 * cap
    assert abs(clean.stands_for.iloc[0] - want / cap) < 0.01 * want / cap
    whole, thinned = learn_toxicity(docs, lab), learn_toxicity(docs, lab, sample_rows=cap)
    assert whole.weights.keys() == thinned.weights.keys()
    for text in ("bread house river " * 9, "bread house river " * 9 + "idiot", "idiot moron " + "green walk " * 12):
        odds = [float(np.dot(m.beta[:-1], m.matcher.features(text)) + m.beta[-1]) for m in (whole, thinned)]
        assert abs(odds[0] - odds[1]) < 0.8, (text, odds)


def test_short_terms_without_clean_neighbours_take_an_edit(spark):
    """Of two four-letter terms, one has a clean word one edit away and stays exact."""
    rnd = random.Random(13)
    words = ["bread", "house", "river", "green", "walk", "seven", "music", "paper", "stone", "dolt"]
    rows, labels = [], []
    for i in range(900):
        t = [rnd.choice(words) for _ in range(250)]
        bad = i % 5 == 0
        for _ in range(4 if bad else 0):
            t.insert(rnd.randrange(len(t)), rnd.choice(["scum", "dola"]))
        rows.append((i, " ".join(t)))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = learn_toxicity(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert {"scum", "dola"} <= model.weights.keys() and model.short == {"scum"}
    for w in edits("scum") - {"scum"}:
        assert model.matcher.lexicon.match(w) == ("scum", 1), w
    assert all(model.matcher.lexicon.match(w) is None for w in (edits("dola") - {"dola"}) | {"walk", "dolt", "skom"})
    assert model.score("bread house skum river " * 9 + "scumm") > 0.7 > model.score("bread house dolt river " * 9)


def test_every_term_with_evidence_stays():
    counts = [(f"{i:03x}", 20, 0) for i in range(3000)]
    assert len(pick_terms(counts, 100_000, 400_000)) == 3000
