"""Operators 1, 3 and 7 against the tokenizer libraries."""
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from roomlake.llm.bpe import RecursiveBPE, bpe_round_trip, read_ranks
from roomlake.llm.packing import best_fit_decreasing, best_fit_pack, bin_lower_bound, pack_documents, token_pieces
from roomlake.llm.tokens import PrefixCounter, fitting_chars, prefix_tokens, token_counts

TRICKY = st.text(alphabet=st.sampled_from(list("abthe  \n\t12éü你😀<s>▁.,'\x00\xa0\u2003")), max_size=60)


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def coder():
    return RecursiveBPE("byte_bpe_multi_50k.tiktoken", P.PATTERN)


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks("byte_bpe_multi_50k.tiktoken"),
                             special_tokens={})


@settings(max_examples=300, deadline=None)
@given(TRICKY)
def test_every_prefix_count(counter, sp, text):
    d = counter.deltas(text)
    for n in range(len(text) + 1):
        assert prefix_tokens(d, n) == len(sp.encode(text[:n]))


def test_fitting_prefix(counter, sp):
    text = "the cat sat on the mat " * 20
    d = counter.deltas(text)
    for budget in (0, 1, 7, 50, 10_000):
        best = max(n for n in range(len(text) + 1) if len(sp.encode(text[:n])) <= budget)
        assert fitting_chars(d, budget) == best


def test_token_counts(docs, no_docs, doc_rows, sp):
    got = Counter(tuple(r) for r in token_counts(docs, budget=100).select("doc_id", "n_bytes", "n_tokens").collect())
    assert got == Counter((r[0], len((r[1] or "").encode()), len(sp.encode(r[1] or ""))) for r in doc_rows)
    kept = token_counts(docs, budget=100, keep_prefixes=True).collect()
    assert all(prefix_tokens(r["prefix_deltas"], 1 << 30) == r["n_tokens"] for r in kept)
    assert token_counts(no_docs).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(TRICKY, max_size=5))
def test_bpe_equals_library(coder, tik, texts):
    for t, (ids, back) in zip(texts, coder.texts(texts)):
        assert ids == ",".join(map(str, tik.encode_ordinary(t))).encode()
        assert back == t.encode()


def test_bpe_long_words(coder, tik):
    rnd = random.Random(3)
    for w in ("a" * 4000, "ab" * 300 + "x" * 77, "".join(rnd.choice("abcdet") for _ in range(600))):
        assert next(coder.texts([w]))[0] == ",".join(map(str, tik.encode_ordinary(w))).encode()


@pytest.mark.parametrize("kind", ["random", "one letter", "two letters", "word", "accents", "mixed"])
def test_bpe_very_long_words(coder, tik, kind):
    rnd = random.Random(kind)
    letters = "abcdefghijklmnopqrstuvwxyz"
    text = {"random": "".join(rnd.choice(letters) for _ in range(50_000)), "one letter": "z" * 50_000, "two letters": "ab" * 20_000,
            "word": "the" * 9_001, "accents": "éàñ" * 4_000,
            "mixed": "".join(rnd.choice(["ing", "tion", "aab", "st", rnd.choice(letters) * rnd.randint(1, 90)]) for _ in range(2_000))}[kind]
    (ids, decoded), = coder.texts([text])
    assert [int(i) for i in ids.split(b",")] == tik.encode_ordinary(text) and decoded == text.encode()


def test_bpe_a_million_letters_in_bounded_memory(coder, tik):
    rnd = random.Random(9)                                   # the coder's database may hold 512 MB
    text = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
    assert [int(i) for i in next(coder.texts([text]))[0].split(b",")] == tik.encode_ordinary(text)


def test_bpe_cache_overflow(coder, tik):
    limit, coder.cache.limit, coder.pieces.limit = coder.cache.limit, 30, 40
    try:
        rows = [" ".join(f"w{i}q{j}" for j in range(9)) for i in range(40)]
        assert [x[0].decode() for x in coder.texts(rows)] == [",".join(map(str, tik.encode_ordinary(t))) for t in rows]
    finally:
        coder.cache.limit = coder.pieces.limit = limit


def test_bpe_round_trip(docs, no_docs, doc_rows, tik):
    got = Counter(tuple(r) for r in bpe_round_trip(docs).collect())
    want = Counter()
    for r in doc_rows:
        ids = tik.encode_ordinary(r[1] or "")
        want[(r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
              hashlib.sha256((r[1] or "").encode()).hexdigest())] += 1
    assert got == want
    assert bpe_round_trip(no_docs).collect() == []


def test_word_ids_equal_library():
    from roomlake.llm.packing import WordEncoder

    rnd, own = random.Random(3), WordEncoder("word_bpe_49k.json")
    letters = "aBcZé ÉßñŒ½²'’.,;:!?…\"-_09٣日本  \t\n\x1c\x85İ<|>ſs"
    rows = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    for group in (rows[:500], *[[t] for t in rows[500:]], [t.replace("|", "") for t in rows], [], [""]):
        for text, ids in zip(group, own.texts(group), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_pieces(docs, doc_rows):
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = Counter()
    for r in doc_rows:
        ids = np.array([*tok.encode(r[1] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for k, a in enumerate(range(0, len(ids), 512)):
            part = ids[a:a + 512]
            want[(r[0], k, a, len(part), zlib.crc32(part.tobytes()))] += 1
    got = token_pieces(docs, capacity=512).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert Counter(map(tuple, got)) == want


def check_packing(rows, capacity):
    """Sequences gapless from 0 and within capacity."""
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pack_documents(docs, no_docs, doc_rows):
    rows = pack_documents(docs, capacity=512, group_size=7).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    assert check_packing(rows, 512) >= -(-sum(r["length"] for r in rows) // 512)
    assert pack_documents(no_docs).collect() == []


def test_exchange_reaches_the_bound(spark):
    rnd = random.Random(1)
    pieces = spark.createDataFrame([(i, rnd.randint(1, 100)) for i in range(3000)], "slot long, length long")
    alone = best_fit_pack(pieces, capacity=100, group_size=60, rounds=0).collect()
    packed = best_fit_pack(pieces, capacity=100, group_size=60, rounds=4).collect()
    n = check_packing(packed, 100)
    counts = np.bincount([r["length"] for r in packed], minlength=101)
    assert len(packed) == 3000 and {r["slot"] for r in packed} == set(range(3000))
    assert bin_lower_bound(counts, 100) <= n < check_packing(alone, 100)


def test_exchange_goes_on_while_it_gains(spark):
    rnd = random.Random(1)
    pieces = spark.createDataFrame([(i, rnd.randint(1, 100)) for i in range(1500)], "slot long, length long")
    three = best_fit_pack(pieces, capacity=100, group_size=20, rounds=3).collect()
    packed = best_fit_pack(pieces, capacity=100, group_size=20).collect()
    n = check_packing(packed, 100)
    assert len(packed) == 1500 and {r["slot"] for r in packed} == set(range(1500))
    assert bin_lower_bound(np.bincount([r["length"] for r in packed], minlength=101), 100) <= n < check_packing(three, 100)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_bound_is_a_bound(sizes):
    def optimal(rest, free):
        if not rest:
            return len(free)
        best = len(rest) + len(free)
        for i, f in enumerate(free):
            if f >= rest[0] and f not in free[:i]:
                best = min(best, optimal(rest[1:], [*free[:i], f - rest[0], *free[i + 1:]]))
        return min(best, optimal(rest[1:], [*free, 20 - rest[0]]))

    sizes = sorted(sizes, reverse=True)
    best = optimal(sizes, [])
    assert bin_lower_bound(np.bincount(sizes, minlength=21), 20) <= best
    bins, offsets, free = best_fit_decreasing(np.array(sizes), 20)
    assert best <= len(free) and (free >= 0).all()
