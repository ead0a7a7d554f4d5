"""URL filters: host-suffix and path-prefix expressions, short hash prefixes, full digests, precedence.

A url's distinct (host, path) is expanded into its host suffixes of as many labels as some rule's host has,
joined with every path prefix of a length that some rule has. The expressions meet the rules by the first 32
bits of their SHA-256 (an equi-join), are confirmed by the whole digest, and the longest rule wins
(by characters; then by host; then block before allow). Urls that no rule fits get the default.

Edges: null urls and urls without `://` have empty host and path, so that only a rule with both
empty would fit; repeated rows each get their verdict; an empty rule table gives the default to all; an empty
table gives an empty result. Very long urls cost in proportion to their length times the rules' distinct label
counts and path lengths. Columns of pages named host, path, rule or verdict are replaced; others, whatever
their names, are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulith.llm.common import bounded_broadcast, boxed, stored, unboxed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """rules: (verdict, host, path)."""
    return spark.createDataFrame(rules, "verdict string, rule_host string, rule_path string")


def _labels(host: Column) -> Column:
    """The number of labels of a host: one more than its dots."""
    return F.length(host) - F.length(F.replace(host, F.lit("."))) + 1


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """pages with host, path, rule (or null) and verdict; columns of these names are replaced, all others stay."""
    keyed = rules.select(
        F.col("verdict").alias("_verdict"),
        F.concat("rule_host", "rule_path").alias("_rule"),
        F.length("rule_host").alias("_host_len"),
        _digest(F.col("rule_host"), F.col("rule_path")).alias("_full"),
    ).withColumn("_short", F.substring("_full", 1, 8))
    # distinct path lengths and label counts: at most as many as the longest rule has characters and labels
    lengths = sorted(r[0] for r in rules.select(F.length("rule_path")).distinct().collect())
    counts = sorted(r[0] for r in rules.select(_labels(F.col("rule_host"))).distinct().collect())
    split = boxed(pages, _host=host_of(F.col(url)), _path=path_of(F.col(url)))
    suffixes = F.array_compact(F.array(*[F.when(_labels(F.col("_host")) >= c, F.substring_index("_host", ".", -c)) for c in counts] or [F.lit(None).cast("string")]))
    cuts = F.filter(F.array(*[F.lit(n) for n in lengths] or [F.lit(0)]), lambda n: n <= F.length("_path"))
    expressions = (
        split.select("_host", "_path")
        .distinct()
        .select("_host", "_path", F.explode(suffixes).alias("_suffix"), cuts.alias("_cuts"))
        .select("_host", "_path", "_suffix", F.explode("_cuts").alias("_cut"))
        .select("_host", "_path", _digest(F.col("_suffix"), F.expr("substring(_path, 1, _cut)")).alias("_seen"))
    )
    won = F.max_by(F.struct("_rule", "_verdict"), F.struct(F.length("_rule").alias("a"), F.col("_host_len").alias("b"), (F.col("_verdict") == "block").alias("c"), F.col("_rule").alias("d")))
    hits = (
        expressions.withColumn("_short", F.substring("_seen", 1, 8))
        .join(bounded_broadcast(keyed), "_short")
        .filter(F.col("_seen") == F.col("_full"))
        .groupBy("_host", "_path")
        .agg(won.alias("_won"))
        # a key of its own: both sides are dealt anew, so that Spark can split a hot url
        .select(F.xxhash64("_host", "_path").alias("_url"), F.col("_host").alias("_h"), F.col("_path").alias("_p"), "_won")
    )
    same = (F.col("_of") == F.col("_url")) & (F.col("_host") == F.col("_h")) & (F.col("_path") == F.col("_p"))
    judged = split.withColumn("_of", F.xxhash64("_host", "_path")).join(stored(hits, "url-hits"), same, "left")
    return unboxed(judged, pages.columns, host=F.col("_host"), path=F.col("_path"), rule=F.col("_won._rule"), verdict=F.coalesce(F.col("_won._verdict"), F.lit(default)))
