"""Small documents with every odd case."""
import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: names that the operators use inside or return
CLASHES = ["id", "t", "k", "h", "fp", "v", "node", "score", "n_tokens", "n_words", "host", "path", "rule", "piece", "slot",
           "place", "lang_pred", "y", "toxic", "rid", "length", "start"]


def small_docs():
    """Nulls, empty and odd texts, ties, repeated rows, near copies, a long text and a text of one long word."""
    rnd = random.Random(5)
    vocab = ["the", "cat", "sat", "on", "Mat.", "été", "größer", "niño", "naïve", "42", "x", "ab-c", "日本語", "I'm", "it's"]
    base = [" ".join(rnd.choice(vocab) for _ in range(n)) for n in (1, 2, 3, 10, 40, 80, 200)]
    passage = " ".join(f"w{i}" for i in range(60))
    texts = [None, "", " ", "\n\t  \n", "!!! 123", "a", "aa", "aaaa", *base, base[4], base[5] + " tail", "head " + base[5],
             passage, "before " + passage + " after words", "x " * 50 + "\u00a0y\u2003z  end", "z" * 3000,
             "ab" * 700, " ".join(rnd.choice(vocab) + str(rnd.randint(0, 9)) for _ in range(6000)),
             "tab\tand\x0bvt\x0cff\r\nnl  two  spaces ", "<s> <|endoftext|> </s> ▁ ▁▁x", "same words " * 40]
    rows = [(i * 3, t, ["en", "de", "fr", None][i % 4], f"src{i % 3}", len(t) if t else 0) for i, t in enumerate(texts)]
    rows += [rows[14], rows[14], (None, base[6], "en", "src0", 5), (None, None, None, None, None), (None, base[6], "en", "src0", 5)]
    return rows
