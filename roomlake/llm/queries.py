"""The subpackage's contract queries: ``(spark, sf_dir) -> DataFrame`` over the whole given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomlake.llm.bpe import bpe_round_trip
from roomlake.llm.collocations import collocations
from roomlake.llm.embeddings import embedding_duplicates
from roomlake.llm.language import language_predictions
from roomlake.llm.lexical import ranked_search
from roomlake.llm.linefreq import quality_rules
from roomlake.llm.lzprint import neighbour_likeness
from roomlake.llm.packing import pack_documents
from roomlake.llm.simhash import simhash_groups
from roomlake.llm.substrings import substring_dedup
from roomlake.llm.tokens import token_counts
from roomlake.llm.toxicity import toxicity_predictions
from roomlake.llm.urls import url_verdicts

#: (host, path, action) of the contract
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return pack_documents(_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words outside repeated 35-word windows of every document."""
    return substring_dedup(_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of whole texts; ``fit_chars``: code points that fit 4096 tokens."""
    counts = token_counts(_table(spark, sf_dir, "documents"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"), "fit_chars")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes: 3-word shingles, links at 2 or fewer differing bits."""
    out = simhash_groups(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and classes of all embeddings at cosine 0.95."""
    return embedding_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned outside fold 0 of 5."""
    return language_predictions(_table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of whole texts and the bytes decoded from them, as digests."""
    return bpe_round_trip(_table(spark, sf_dir, "documents"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the contract's four rules for every page."""
    rules = spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, action string")
    out = url_verdicts(_table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return out.select("page_id", "host", "path", "rule", "verdict")


def op9_lz_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lempel-Ziv fingerprints of whole texts, compared with the edited text and the next document."""
    return neighbour_likeness(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text, learned outside fold 1 of 3."""
    return toxicity_predictions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 strongest phrases of two to five words that occur 100 times or more."""
    return collocations(_table(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of whole texts, the base rule, and the verdict of cross-document line frequency per source."""
    return quality_rules(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_simhash": op4_simhash,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_language_id": op6_language_id,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_url_filters": op8_url_filters,
    "op9_lz_fingerprints": op9_lz_fingerprints,
    "op10_toxicity": op10_toxicity,
    "op11_ranked_search": op11_ranked_search,
    "op12_collocations": op12_collocations,
    "op13_quality_rules": op13_quality_rules,
}
