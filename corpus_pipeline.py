"""Training-corpus pipeline over ``documents``: filter, deduplicate and pack.

Each stage takes (spark, docs, sf_dir), calls one operator of ``roomlake.llm`` on all
its predecessor kept, and returns rows with the columns of ``documents``; the last one returns
the packed pieces.  Between stages ``run`` writes Parquet to the shared folder and rereads it.

Null, empty and very long texts, repeated rows, empty tables and extra columns pass as the
operators' docstrings say; a document without any letter is the only kind that a filter takes for
its emptiness (no language).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomlake.llm.common import cut
from roomlake.llm.language import UNKNOWN, identify, learn_prototypes, with_letter
from roomlake.llm.packing import pack_documents
from roomlake.llm.simhash import keep_one_per_group
from roomlake.llm.substrings import remove_repeats
from roomlake.llm.toxicity import learn_toxicity, score_toxicity

TOXIC_FROM = 0.7


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose toxicity score is at least 0.7 (learned from ``labels`` outside fold 1 of 3)."""
    model = learn_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_toxicity(docs, model, score_col="_toxicity")
    return scored.where(F.col("_toxicity") < TOXIC_FROM).select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told: those without a letter.

    Rows named ``und`` teach no language; where no row teaches one, every document with a letter stays.
    """
    prototypes = learn_prototypes(docs.where(F.col("lang") != UNKNOWN))
    if not prototypes:
        return with_letter(docs)
    named = identify(docs, prototypes, pred_col="_language", score_col="_cosine")
    return named.where(F.col("_language") != UNKNOWN).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash class (3-word shingles, links at 2 or fewer bits)."""
    return keep_one_per_group(docs, shingle=3, distance=2)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes the words of repeated 35-word windows; every document stays."""
    return remove_repeats(docs, window=35)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 4096 tokens: one row per piece."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_stage),
    ("packing", packing),
]

#: Learned models, XXH64 and the tokenizer are not expressible in SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs, name)
    return docs
