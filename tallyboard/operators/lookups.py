"""Version dimension and name matching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import drop_wildcard, os_code
from ..functions.values import INTEGRATION_TERMS, SUPPORT_OVERRIDES


def release_lines(version_support: DataFrame) -> DataFrame:
    """Support level per platform code and release line.

    ``3.7.x`` names the line 3.7 and wins over a plain 3.7 entry.
    """
    wild = F.col("version").contains(".x")
    return (version_support.filter(F.col("current_level").isNotNull())
            .select(os_code(F.col("os")).alias("os_code"), drop_wildcard(F.lower("version")).alias("line"),
                    F.struct(wild, "eol", "extended", "standard", "current_level").alias("_entry"))
            .groupBy("os_code", "line").agg(F.max("_entry")["current_level"].alias("support_level")))


def longest_prefix(versions: DataFrame, lines: DataFrame, include_exact: bool = False, fallback: str = "EOL") -> DataFrame:
    """Support level of the longest release line that is a prefix of the version.

    Each distinct version is expanded to its prefixes and met with the lines by
    equality; only proper prefixes count unless ``include_exact``. The versions are
    carried through, so they are read once.
    """
    longest = F.length("version") - (0 if include_exact else 1)
    prefixes = F.when(longest > 0, F.transform(F.sequence(F.lit(1), longest), lambda n: F.substring("version", F.lit(1), n)))
    tried = versions.select("*", os_code(F.col("os")).alias("os_code"), F.explode_outer(prefixes).alias("line"))
    match = F.when(F.col("support_level").isNotNull(), F.struct(F.length("line").alias("n"), "support_level"))
    return (tried.join(lines, ["os_code", "line"], "left").groupBy(*versions.columns)
            .agg(F.coalesce(F.max(match)["support_level"], F.lit(fallback)).alias("support_level")))


def downloadable(versions: DataFrame, kits: DataFrame) -> DataFrame:
    """Whether the version is published for its platform (J14); Linux kits are published as ubuntu."""
    published = (kits.filter(F.lower("os") != "linux")
                 .select(F.when(F.lower("os") == "ubuntu", "linux").otherwise(F.lower("os")).alias("_os"), "version")
                 .distinct().withColumn("_listed", F.lit(True)))
    return (versions.withColumn("_os", F.lower("os")).join(published, ["_os", "version"], "left")
            .withColumn("dl_available", F.col("_listed").isNotNull()).drop("_os", "_listed"))


def override_levels(lookup: DataFrame) -> DataFrame:
    """Correct levels the published matrix has wrong."""
    level = F.col("support_level")
    for os, pattern, right in SUPPORT_OVERRIDES:
        level = F.when((F.col("os") == os) & F.col("version").like(pattern), right).otherwise(level)
    return lookup.withColumn("support_level", level)


def sensor_lookup(endpoints: DataFrame, kits: DataFrame, version_support: DataFrame, include_exact: bool = False) -> DataFrame:
    """One row per distinct platform and version in use (J22, A17): availability and support level."""
    versions = (endpoints.filter((F.col("fetch_status") == "OK") & (F.col("sensor_version") != ""))
                .select(F.col("sensor_version").alias("version"), "os").distinct())
    rated = longest_prefix(downloadable(versions, kits), release_lines(version_support), include_exact)
    return override_levels(rated).select("version", "os", "dl_available", "support_level")


def _found(term: str) -> str:
    """SQL test whether a pattern of literals joined by ``.*`` occurs in a ``line``.

    Looking for each literal after the first place of the one before is linear in
    the line; a backtracking ``a.*b`` would be quadratic on long text.
    """
    tests, start = [], "1"
    for literal in term.split(".*"):
        at = f"locate('{literal}', line, {start})"
        tests.append(f"{at} > 0")
        start = f"{at} + {len(literal)}"
    return " and ".join(tests)


def matched_terms(lines: str, terms: list[str] = INTEGRATION_TERMS) -> Column:
    """Labels of all patterns found in the lines of a lower-case name.

    A projection: the terms are never joined with the names.
    """
    hits = [f"case when exists({lines}, line -> {_found(t)}) then '{t.replace('.*', '')}' end" for t in terms]
    return F.expr(f"array_compact(array({', '.join(hits)}))")


def all_names(forwarders: DataFrame, connectors: DataFrame) -> DataFrame:
    """Names of forwarders and connectors, as they come: for uses that make what they find distinct."""
    return reduce(DataFrame.union, [t.select("inst_id", "name") for t in (forwarders, connectors)])


def connection_names(forwarders: DataFrame, connectors: DataFrame) -> DataFrame:
    """Distinct names of forwarders and connectors."""
    return all_names(forwarders, connectors).distinct()


def integrations(names: DataFrame, terms: list[str] = INTEGRATION_TERMS) -> DataFrame:
    """Sorted distinct integrations recognised in an installation's names (A23), '' when none.

    Terms are made distinct per installation before they are gathered, so a list
    holds at most one entry per term.
    """
    lines = names.select("inst_id", F.split(F.lower("name"), "\n").alias("lines"))
    hits = lines.select("inst_id", F.explode_outer(matched_terms("lines", terms)).alias("term")).distinct()
    return hits.groupBy("inst_id").agg(F.array_join(F.array_sort(F.collect_list("term")), ", ").alias("integrations"))
