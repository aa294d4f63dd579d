"""Allow and block rules on URLs.

A URL is expanded into expressions: each suffix of its host at a dot, joined with
each prefix of its path that is as long as some rule's path. An expression meets
the rules through the first bytes of its digest, an equi-join on short keys; then
the whole digest must agree. Of the rules that fit, the longest wins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hexadecimal digits of a digest that the join compares.
SHORT = 8
#: Up to so many rules go to every task; more are dealt out by the short key, as the expressions are.
SENT_RULES = 20_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    rule: str

    def __post_init__(self):
        if self.verdict not in ("allow", "block") or "/" not in self.rule or self.rule.startswith("/"):
            raise ValueError(f"a rule allows or blocks host/path: {self}")

    @property
    def path(self) -> str:
        return self.rule[self.rule.index("/"):]


def host(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: str | Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1)


def _expressions(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    labels = F.split(host, r"\.")
    starts = F.sequence(F.lit(1), F.size(labels))
    suffixes = F.transform(starts, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]), lambda p: p.isNotNull())
    both = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(both)


def judge(pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: the key, ``host``, ``path``, ``rule`` (null if none fits), ``verdict``.

    A rule ``host/path`` fits the host and its subdomains when the URL's path
    starts with the rule's. The longest fitting rule wins; of equally long ones
    the one with the longer host, then the blocking one. URLs without a fitting
    rule, null ones and ones without ``://`` get ``default``. Rules given twice
    count once. Other columns are ignored; repeated rows stay.
    """
    spark = pages.sparkSession
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    listed = spark.createDataFrame(sorted({(r.verdict, r.rule, len(r.path)) for r in rules}), "verdict string, rule string, path_length int")
    listed = listed.withColumn("digest", digest("rule")).select(
        F.substring("digest", 1, SHORT).alias("short"), F.col("digest").alias("rule_digest"),
        F.struct(F.length("rule").alias("length"), (F.length("rule") - F.col("path_length")).alias("host_length"),
                 F.when(F.col("verdict") == "block", 1).otherwise(0).alias("blocks"), "rule", "verdict").alias("fit"))
    if len(rules) <= SENT_RULES:
        listed = F.broadcast(listed)
    lengths = sorted({len(r.path) for r in rules})

    parsed = pages.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    asked = (parsed.withColumn("expression", F.explode_outer(_expressions(F.col("host"), F.col("path"), lengths)))
             .withColumn("digest", digest("expression")).withColumn("short", F.substring("digest", 1, SHORT)))
    met = asked.join(listed, "short", "left")
    best = met.groupBy("row").agg(
        F.first("key").alias(key), F.first("host").alias("host"), F.first("path").alias("path"),
        F.max(F.when(F.col("digest") == F.col("rule_digest"), F.col("fit"))).alias("fit"))
    return best.select(key, "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", F.lit(default)).alias("verdict"))
