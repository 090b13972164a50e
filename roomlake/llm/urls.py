"""URL filters (operator 8): host-suffix and path-prefix expressions, hash prefixes, full digests.

Like a safe-browsing list: every URL is expanded into the expressions
``host suffix + path prefix`` that a rule could be written as; expressions and
rules meet in an equi-join on the first bytes of their SHA-256, the full
digests confirm the match, and of the confirmed rules the longest wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.expr("substring(_url, locate('://', _url) + 3)"))


def with_host_path(urls: DataFrame, url_col: str) -> DataFrame:
    """Adds ``_host`` (A-Z lower-cased) and ``_path``; both empty for a null url or one without ``://``."""
    rest = _rest(F.col("_url"))
    df = urls.withColumn("_url", F.col(url_col)).withColumn("_rest", F.coalesce(rest, F.lit("")))
    host = F.regexp_extract("_rest", r"^([^/?#]*)", 1)
    path = F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)
    return (df.withColumn("_host", F.translate(host, ASCII_UPPER, ASCII_LOWER))
            .withColumn("_path", path).drop("_url", "_rest"))


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def expand(targets: DataFrame, host_lengths: list[int], path_lengths: list[int]) -> DataFrame:
    """One row per expression of each (host, path) that a rule could be written as.

    Host suffixes start at a label and have the length of some rule's host; path prefixes have the length of some
    rule's path.  So a row has as many expressions as the rules have lengths at most, however many labels and
    slashes it has.
    """
    whole = lambda xs: F.array(*[F.lit(int(x)) for x in sorted(set(xs))]).cast("array<int>")
    host, path = F.col("_host"), F.col("_path")
    label = lambda n: (n == F.length(host)) | (F.substring(host, F.length(host) - n, F.lit(1)) == ".")
    suffixes = F.filter(whole(host_lengths), lambda n: (n <= F.length(host)) & (n > 0) & label(n))
    prefixes = F.filter(whole(path_lengths), lambda n: n <= F.length(path))
    rows = targets.withColumn("_size", F.explode(suffixes)).withColumn("_upto", F.explode(prefixes))
    return (rows.withColumn("_suffix", F.expr("right(_host, _size)"))
            .withColumn("_prefix", F.expr("substring(_path, 1, _upto)")))


def url_verdicts(urls: DataFrame, rules: DataFrame, *, url_col: str = "url", default: str = "allow",
                 prefix_bytes: int = 4) -> DataFrame:
    """Adds host, path, rule and verdict to ``urls`` (all its rows and other columns stay).

    ``rules``: rule_host, rule_path, action ('block' / 'allow').  A rule fits
    its host and all subdomains if the url's path starts with the rule's.  The
    longest rule text wins; of equal lengths the longer host, then 'block', then
    the smaller text.  Without a fitting rule: null and ``default``.  A null url or
    one without ``://`` has an empty host and path, and no rule fits it.  Input columns named
    host, path, rule or verdict are replaced.  Null rule fields and repeated
    rules match like the rules without them.

    Only distinct (host, path) pairs are expanded and joined, so a host or URL with a third
    of the rows costs one; pairs rejoin the rows by (host, path), where
    adaptive execution splits a hot pair.
    """
    keep = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    parsed = with_host_path(urls, url_col).select(*keep, F.col("_host").alias("host"), F.col("_path").alias("path"))
    list_ = (rules.where("rule_host IS NOT NULL AND rule_path IS NOT NULL AND action IN ('allow', 'block')")
             .select(F.translate("rule_host", ASCII_UPPER, ASCII_LOWER).alias("_rh"), F.col("rule_path").alias("_rp"),
                     F.col("action").alias("_action")).distinct()
             .withColumn("_rd", _digest(F.concat_ws("\n", "_rh", "_rp")))
             .withColumn("_key", F.substring("_rd", 1, 2 * prefix_bytes)))
    # a number per length that occurs: no more than the longest rule has characters
    sizes = list_.agg(F.collect_set(F.length("_rh")), F.collect_set(F.length("_rp"))).first()
    pairs = parsed.select(F.col("host").alias("_host"), F.col("path").alias("_path")).distinct()
    hits = (expand(pairs, *sizes)
            .withColumn("_d", _digest(F.concat_ws("\n", "_suffix", "_prefix")))
            .withColumn("_key", F.substring("_d", 1, 2 * prefix_bytes))
            .join(list_, "_key")
            .where("_d = _rd AND _suffix = _rh AND _prefix = _rp"))
    text = F.concat("_rh", "_rp")
    rank = F.struct(F.length(text).alias("l"), F.length("_rh").alias("h"),
                    (F.col("_action") == "block").alias("b"),
                    F.struct(text.alias("rule"), F.col("_action").alias("action")).alias("v"))
    best = (hits.groupBy("_host", "_path").agg(F.max(rank).alias("_best"))
            .select("_host", "_path", F.col("_best.v.rule").alias("rule"), F.col("_best.v.action").alias("_action")))
    return (parsed.join(best, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")), "left")
            .select(*keep, "host", "path", "rule", F.coalesce("_action", F.lit(default)).alias("verdict")))
