"""Quality rules with cross-document line frequency, in DataFrame functions only.

A line is a ``\\n``-split part of a text that has a word; it is normalised (lower case, digits as ``0``, runs of
separators as one space) and hashed.  Per host, the documents that hold a line are counted; a line that more than
``min_docs`` documents and more than the share ``max_share`` of the host's documents hold is taken out, and a document
that loses more than the share ``max_loss`` of its words that way is depleted and rejected.  Exact copies count
as one document: a text that a host repeats says nothing about its lines.

The text is scanned once: the per-document counts and the lines' hashes (no text) are written to the shared folder.  Line
counts are combined on every task before the shuffle, so a line that a third of all documents hold
arrives as one row a task; lines above the limits are joined back without a hint (adaptive execution broadcasts
them if their measured size allows, and splits skewed partitions otherwise).

Defined results: a null text has no words (every count 0, ``base_failed``); a null host is a host of its own;
documents with equal or null ids are judged each on its own row; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomlake.llm.common import cut

#: word separators, as the contract's words ``[^\x20\x09-\x0D]+`` leave them
SEPS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50


def words(text: Column) -> Column:
    """The words of a text, in order; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPS), lambda w: w != F.lit(""))


def normalised(line: Column) -> Column:
    """A line as it is compared across documents."""
    one_space = F.trim(F.regexp_replace(F.lower(line), SEPS, " "))
    return F.regexp_replace(one_space, r"\d", "0")


def repeat_words(w: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the array ``w``, the first occurrence included."""
    n = F.size(w)
    starts = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(starts, lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(win: Column) -> Column:
        pairs = F.sort_array(F.transform(win, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda a, b: F.get(s, a)["x"] == F.get(s, b)["x"]  # noqa: E731  (null past either end)
            hit = F.filter(F.transform(s, lambda p, j: F.when(
                F.coalesce(same(j, j - 1), F.lit(False)) | F.coalesce(same(j, j + 1), F.lit(False)), p["i"])),
                lambda i: i.isNotNull())
            return F.sort_array(hit)

        def union(at: Column) -> Column:
            # every window adds the words up to the next one's start, three at most
            return F.aggregate(
                at, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
                lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
                lambda acc: acc["n"])

        return _bind(_bind(pairs, places), union)

    return _bind(windows, lambda win: F.when(F.size(F.array_distinct(win)) < F.size(win), covered(win))
                 .otherwise(F.lit(0).cast("long")))


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def line_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  host_col: str = "source") -> DataFrame:
    """One row per document: id, host, counts, text digest, and per line with a word its hashes and number of words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"), text.alias("t"))
    base = base.withColumn("w", words(F.col("t")))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = base.withColumn("ls", lines)
    hashed = F.transform("ls", lambda x: _bind(normalised(x), lambda y: F.struct(
        F.xxhash64(y).alias("h1"), F.hash(y).alias("h2"), F.size(F.split(y, " ")).alias("n"))))
    return base.select(
        "doc_id", "host",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("w")).alias("n_repeat_words"),
        F.xxhash64("t").alias("t1"), F.hash("t").alias("t2"),
        hashed.alias("lines"),
        F.monotonically_increasing_id().alias("rid"))


def frequent_lines(features: DataFrame, min_docs: int, max_share: float) -> DataFrame:
    """Lines (host, h1, h2) that more documents of their host hold than both limits allow, with their number ``n``."""
    # one row per host and distinct text; equal texts have equal lines
    once = features.groupBy("host", "t1", "t2").agg(F.any_value("lines").alias("lines"))
    sizes = once.groupBy(F.col("host").alias("_h")).agg(F.count(F.lit(1)).alias("docs"))
    held = (once.select("host", F.explode(F.array_distinct(F.transform(
                "lines", lambda x: F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"))))).alias("l"))
                .groupBy("host", "l.h1", "l.h2").agg(F.count(F.lit(1)).alias("n"))
                .where(F.col("n") > min_docs))
    return (held.join(sizes, F.col("host").eqNullSafe(F.col("_h")))
                .where(F.col("n") > max_share * F.col("docs")).select("host", "h1", "h2", "n"))


def _judged(features: DataFrame, min_docs: int, max_share: float, max_loss: float) -> DataFrame:
    """``features`` with ``lost`` (words in lines above the limits), their hashes ``gone``, ``base_failed``, ``kept``."""
    hot = frequent_lines(features, min_docs, max_share).select(F.col("host").alias("_h"), "h1", "h2")
    each = features.select("rid", "host", F.explode("lines").alias("l")).select("rid", "host", "l.h1", "l.h2", "l.n")
    hits = (each.join(hot, ["h1", "h2"]).where(F.col("host").eqNullSafe(F.col("_h")))
                .groupBy("rid").agg(F.sum("n").cast("long").alias("lost"),
                                    F.collect_set(F.struct("h1", "h2")).alias("gone")))     # of one document
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (features.join(hits, "rid", "left")
                    .withColumn("lost", F.coalesce("lost", F.lit(0).cast("long")))
                    .withColumn("base_failed", failed)
                    .withColumn("kept", ~failed & (F.col("lost") <= max_loss * F.col("n_words"))))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  min_docs: int = 10, max_share: float = 0.01, max_loss: float = 0.5) -> DataFrame:
    """Counts, base rule and verdict of every document.

    ``base_failed``: under 50 words, or more than half of the words in repeated 3-word windows.  ``kept``: not
    ``base_failed``, and at most ``max_loss`` of the words in lines above the limits (``n_line_words``).
    """
    features = cut(line_features(docs, id_col, text_col, host_col), "line-features")
    return _judged(features, min_docs, max_share, max_loss).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.col("lost").alias("n_line_words"))


def without_frequent_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                           min_docs: int = 10, max_share: float = 0.01, max_loss: float = 0.5,
                           out_col: str = "cleaned_text") -> DataFrame:
    """The kept documents with all their columns and ``out_col``: the text without lines above the limits.

    Lines without a word stay as they are.  Documents meet their verdicts by a row number written with them.
    """
    whole = F.struct(*docs.columns).alias("doc")
    numbered = cut(docs.select(whole, F.monotonically_increasing_id().alias("rid")), "line-documents")
    features = cut(line_features(numbered.select("rid", F.col("doc")[text_col].alias("text"),
                                                 F.col("doc")[host_col].alias("host")),
                                 "rid", "text", "host").withColumn("rid", F.col("doc_id")), "line-features")
    verdict = _judged(features, min_docs, max_share, max_loss).where("kept").select("rid", "gone")
    lines = F.filter(F.split(F.coalesce(F.col("doc")[text_col], F.lit("")), "\n"), lambda x: _bind(
        normalised(x), lambda y: ~x.rlike(r"[^\x20\x09-\x0D]") | F.col("gone").isNull()
        | ~F.array_contains(F.col("gone"), F.struct(F.xxhash64(y).alias("h1"), F.hash(y).alias("h2")))))
    return numbered.join(verdict, "rid").select(*[F.col("doc")[c].alias(c) for c in docs.columns],
                                                F.array_join(lines, "\n").alias(out_col))
