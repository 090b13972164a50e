"""Operator 13 against brute force, its limits and its cleaned texts."""
import re
from collections import Counter, defaultdict

import pytest

from roomlake.llm.linefreq import quality_rules, without_frequent_lines

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def normal(line):
    return re.sub("[0-9]", "0", re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip(" "))


def brute(rows, min_docs, max_share, max_loss):
    held, texts = defaultdict(set), defaultdict(set)
    for _, text, _, host, *_ in rows:
        t = text or ""
        texts[host].add(t)
        for line in t.split("\n"):
            if WORD.search(line):
                held[host, normal(line)].add(t)
    hot = {k for k, v in held.items() if len(v) > min_docs and len(v) > max_share * len(texts[k[0]])}
    out = Counter()
    for id_, text, _, host, *_ in rows:
        t = text or ""
        w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        repeat = {i + j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in range(3)}
        lost = sum(len(WORD.findall(x)) for x in lines if (host, normal(x)) in hot)
        failed = len(w) < 50 or 100 * len(repeat) > 50 * len(w)
        out[(id_, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeat),
             failed, not failed and lost <= max_loss * len(w), lost)] += 1
    return out


@pytest.mark.parametrize("limits", [(10, 0.01, 0.5), (0, 0.0, 0.5), (1, 0.05, 0.1)])
def test_small_documents(docs, doc_rows, limits):
    got = Counter(map(tuple, quality_rules(docs, min_docs=limits[0], max_share=limits[1], max_loss=limits[2]).collect()))
    assert got == brute(doc_rows, *limits)


def boilerplate_rows():
    body = lambda i, n: " ".join(chr(97 + j // 26) + chr(97 + j % 26) + f"_{chr(97 + int(i) // 26) + chr(97 + int(i) % 26) if str(i).isdigit() else i}" for j in range(n))
    rows = []
    for i in range(40):                                    # a footer in every page of one host, digits differ
        rows.append((i, f"{body(i, 60)}\nCopyright {2000 + i},  All Rights\treserved\n\n", "en", "a", 0))
    rows += [(100 + i, f"{body('s', 60)}\nanother line of the page", "en", "a", 0) for i in range(60)]   # exact copies
    rows += [(200 + i, "short note\n" + " ".join(["cookie notice and more"] * 20) + f"\n{body(i, 30)}", "en", "b", 0)
             for i in range(30)]
    rows += [(300, body("z", 80) + "\nCopyright 1999, all rights reserved", "en", "c", 0),
             (301, body("n", 80), None, None, None)]
    return rows


def test_lines_above_the_limits(spark):
    rows = boilerplate_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert Counter(map(tuple, quality_rules(df).collect())) == brute(rows, 10, 0.01, 0.5)
    by_id = {r.doc_id: r for r in quality_rules(df).collect()}
    assert all(by_id[i].kept and by_id[i].n_line_words == 5 for i in range(40))
    assert all(by_id[100 + i].kept and not by_id[100 + i].n_line_words for i in range(60))
    assert not any(by_id[200 + i].kept for i in range(30))
    texts = {r.doc_id: r.cleaned_text for r in without_frequent_lines(df).collect()}
    assert set(texts) == {i for i, r in by_id.items() if r.kept}
    assert all(texts[i] == rows[i][1].replace(f"Copyright {2000 + i},  All Rights\treserved\n", "") for i in range(40))
    assert texts[300] == rows[-2][1]


def test_empty_and_clashing(no_docs, docs, doc_rows):
    assert quality_rules(no_docs).collect() == []
    assert without_frequent_lines(no_docs).collect() == []
    out = without_frequent_lines(docs, min_docs=0, max_share=0.0, max_loss=1.0)
    assert out.columns == docs.columns + ["cleaned_text"]
    kept = sum(n for r, n in brute(doc_rows, 0, 0.0, 1.0).items() if r[7])
    assert out.count() == kept and not any(r.cleaned_text.split() for r in out.collect())


def test_no_python_in_the_plan(docs):
    plan = quality_rules(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
