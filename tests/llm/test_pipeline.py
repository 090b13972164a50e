"""The pipeline's stages on small tables."""
import os
import random
import shutil

import corpus_pipeline as P
import pytest
from llm_rows import small_docs


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sf"))
    rnd = random.Random(11)
    words = [f"word{i}" for i in range(80)]
    rows = [r for r in small_docs() if r[0] is not None]
    labels = []
    for i in range(1000, 1600):
        t = [rnd.choice(words) for _ in range(rnd.randint(20, 60))]
        bad = i % 6 == 0
        for _ in range(4 if bad else 0):
            t.insert(rnd.randrange(len(t)), rnd.choice(["idiot", "moron", "scum"]))
        rows.append((i, " ".join(t), "en", "s", 0))
        labels.append((i, 1, int(bad)))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        os.path.join(root, "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(os.path.join(root, "labels.parquet"))
    yield root
    shutil.rmtree(root)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"] for r in docs.collect()}
    kept = {}
    for name, stage in P.STAGES[:-1]:
        docs = P.cut(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        kept[name] = {r["doc_id"] for r in docs.collect()}
    assert before - kept["toxicity"] == {i for i in range(1000, 1600) if i % 6 == 0}
    gone = kept["toxicity"] - kept["language_id"]
    texts = {r[0]: r[1] for r in small_docs()}
    assert gone == {i for i, t in texts.items() if i is not None and not any(c.isalpha() for c in t or "")}
    assert kept["simhash_dedup"] < kept["language_id"] and kept["substring_dedup"] == kept["simhash_dedup"]
    pieces = P.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r["doc_id"] for r in pieces} == kept["substring_dedup"]
    assert len(P.run(spark, sf_dir).collect()) == len(pieces)


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert P.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("lang", [None, "und"])
def test_no_language_to_learn(spark, lang, tmp_path):
    """Without a language to learn, only documents without a letter go."""
    rows = [(i, t, lang, "s", 0) for i, t, *_ in small_docs() if i is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = {i for i, t, *_ in rows if any(c.isalpha() for c in t or "")}
    kept = P.language_id(spark, docs, "")
    assert kept.columns == docs.columns and kept.count() == sum(1 for i, *_ in rows if i in want)
    assert {r["doc_id"] for r in kept.collect()} == want
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert P.run(spark, str(tmp_path)).count() > 0


def test_rows_named_und_stay(spark):
    rows = [(1, "the cat sat on the mat", "en"), (2, "die Katze auf der Matte", "und"), (3, "12 34", "und")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in P.language_id(spark, docs, "").collect()} == {1, 2}
