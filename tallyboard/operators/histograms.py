"""Histograms (A10-A14, A24-A30): long tables first, wide ones only with a given column list."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import percent
from ..functions.text import version_family
from ..functions.time import as_of_ntz
from .devices import number, since_newest, within_run
from .endpoints import fetched, is_deployed


def version_label(version: Column, os: Column, available: Column, level: Column) -> Column:
    """``3.9.0.1 (windows) (Unavailable) (eol)``; the availability is named only when missing."""
    parts = F.concat(F.lower(version), F.lit(" ("), F.lower(os), F.lit(") "),
                     F.when(available, "").otherwise("(Unavailable) "), F.lit("("), F.lower(level), F.lit(")"))
    return F.coalesce(parts, F.lit("unknown"))


def live_devices(endpoints: DataFrame) -> DataFrame:
    return endpoints.filter(fetched() & is_deployed() & since_newest(endpoints, 30))


def sensor_versions(endpoints: DataFrame, lookup: DataFrame) -> DataFrame:
    """Deployed devices per installation and version label (A10), long form."""
    counts = (live_devices(endpoints).groupBy("inst_id", "os", F.col("sensor_version").alias("version"))
              .agg(number(endpoints, F.col("sensor_version").isNotNull()).alias("n")))
    label = version_label(F.col("version"), F.col("os"), F.col("dl_available"), F.col("support_level"))
    return (counts.join(lookup, ["os", "version"], "left")
            .groupBy("inst_id", label.alias("label")).agg(F.sum("n").alias("n")))


def os_versions(endpoints: DataFrame) -> DataFrame:
    """Deployed devices per installation and OS version (A11), long form."""
    return (live_devices(endpoints).filter(F.col("os_version").isNotNull())
            .groupBy("inst_id", F.lower("os_version").alias("label")).agg(number(endpoints).alias("n")))


def deployment_summary(endpoints: DataFrame, lookup: DataFrame) -> DataFrame:
    """Deployed devices per installation by platform, version family and support level.

    The three counts come from one pass: every (installation, platform, version)
    count is passed on under three headings.
    """
    counts = (live_devices(endpoints).groupBy("inst_id", "os", F.col("sensor_version").alias("version"))
              .agg(number(endpoints).alias("n")))
    heading = lambda kind, key: F.struct(F.lit(kind).alias("kind"), F.lower(key).alias("key"))
    kinds = F.array(heading("os", F.col("os")), heading("family", version_family(F.col("version"))),
                    heading("support", F.col("support_level")))
    return (counts.join(lookup, ["os", "version"], "left")
            .select("inst_id", "n", F.explode(kinds).alias("k"))
            .filter(F.col("k.key").isNotNull() & (F.col("k.key") != ""))
            .groupBy("inst_id", "k.kind", "k.key").agg(F.sum("n").alias("n")))


def widen(long: DataFrame, columns: list[str], by: list[str], label: str = "label", n: str = "n") -> DataFrame:
    """One column per label, 0 where a group has none. The labels are given, so no extra job runs."""
    wide = long.groupBy(*by).pivot(label, columns).agg(F.sum(n))
    return wide.select(*by, *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) for c in columns])


def nonzero(long: DataFrame, label: str = "label") -> DataFrame:
    """Labels that occur at all in the selection (F15); in long form a zero column is simply absent."""
    return long.filter(F.col("n") > 0)


def zero_columns(wide: DataFrame, keep: list[str]) -> DataFrame:
    """The wide table without the columns that sum to zero (F15); one aggregated row reaches the driver."""
    numeric = [c for c in wide.columns if c not in keep]
    sums = wide.agg(*[F.sum(F.col(f"`{c}`")).alias(f"s{i}") for i, c in enumerate(numeric)]).first()
    return wide.drop(*[c for i, c in enumerate(numeric) if not sums[i]])


def ordered_columns(columns: list[str]) -> list[str]:
    """Summary columns by class: owner facts, platforms, support levels, then versions (F16)."""
    versions = sorted(c for c in columns if c.replace(".", "").isnumeric())
    platforms = sorted(c for c in columns if c.lower() in ("windows", "linux", "mac"))
    levels = sorted(c for c in columns if c.lower() in ("st", "ex", "eol"))
    facts = [c for c in ("account_name", "csm", "arr", "licenses", "deployment") if c in columns]
    return facts + platforms + levels + versions


def _level(name: str) -> Column:
    return F.sum(F.when(F.col("support_level") == name, F.col("n")).otherwise(0))


def deployment_archive(endpoints: DataFrame, lookup: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Devices of the last 30 days per installation and platform by support level."""
    counts = _recent_by(endpoints, as_of)
    return (counts.join(lookup, ["os", "version"], "left").groupBy("inst_id", "os")
            .agg(_level("ST").alias("standard"), _level("EX").alias("extended"), _level("EOL").alias("eol"),
                 F.sum("n").alias("total"))
            .select(F.to_date(as_of_ntz(as_of)).alias("date"), "inst_id", "os", "standard", "extended", "eol", "total"))


def deployment_trend(endpoints: DataFrame, roster: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Deployed devices per backend and version, and over all backends as ``all``.

    Devices of an unnamed backend count in ``all`` only.
    """
    counts = (live_devices(endpoints).groupBy("inst_id", F.col("sensor_version").alias("version"))
              .agg(number(endpoints, F.col("sensor_version").isNotNull()).alias("n"))
              .join(roster.select("inst_id", "backend"), "inst_id", "left"))
    grouped = (counts.groupingSets([["backend", "version"], ["version"]], "backend", "version")
               .agg(F.sum("n").alias("n"), F.grouping("backend").alias("_all")))
    return (grouped.withColumn("backend", F.when(F.col("_all") == 1, "all").otherwise(F.col("backend")))
            .filter(F.col("backend").isNotNull())
            .select(F.to_date(as_of_ntz(as_of)).alias("date"), "backend", "version", "n"))


def trend_wide(trend: DataFrame, versions: list[str]) -> DataFrame:
    """One row per backend and day, one column per version."""
    wide = widen(trend, versions, ["date", "backend"], "version")
    return wide.withColumn("unique_id", F.concat("backend", F.col("date").cast("string")))


def share_of_total(long: DataFrame, group: list[str], n: str = "n") -> DataFrame:
    """Each value as a percentage of its group's total.

    The input is already one row per group and label, so a window holds labels, not raw rows.
    """
    whole = F.sum(n).over(Window.partitionBy(*group))
    return long.withColumn("perc", F.coalesce(percent(F.col(n), whole), F.lit(0.0)))


def _status(name: str) -> Column:
    return F.sum(F.when(F.col("status") == name, F.col("n")).otherwise(0))


def _recent_by(endpoints: DataFrame, as_of: dt.datetime, *cols: str) -> DataFrame:
    return (endpoints.filter(fetched() & within_run(endpoints, as_of))
            .groupBy("inst_id", "os", F.col("sensor_version").alias("version"), *cols).agg(number(endpoints).alias("n")))


def version_status(endpoints: DataFrame, lookup: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Bypassed and active devices per installation and version."""
    return (_recent_by(endpoints, as_of, "status").join(lookup, ["os", "version"])
            .groupBy("inst_id", "version", "os", "dl_available", "support_level")
            .agg(_status("BYPASS").alias("bypass"), _status("REGISTERED").alias("active")))


def os_status(endpoints: DataFrame, lookup: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Bypassed, active and all devices per installation and OS version."""
    return (_recent_by(endpoints, as_of, "os_version", "status")
            .join(lookup.select("os", "version"), ["os", "version"], "left_semi")
            .groupBy("inst_id", "os_version")
            .agg(_status("BYPASS").alias("bypass"), _status("REGISTERED").alias("active"), F.sum("n").alias("total")))


def os_support(endpoints: DataFrame, lookup: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Devices per installation and platform by support level."""
    return deployment_archive(endpoints, lookup, as_of).drop("date")


def signature_versions(endpoints: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Devices per installation and signature version."""
    return (endpoints.filter(fetched() & within_run(endpoints, as_of) & F.col("av_vdf_version").isNotNull())
            .groupBy("inst_id", "av_vdf_version").agg(number(endpoints).alias("n")))


def archive_pivot(archive: DataFrame, platforms: list[str]) -> DataFrame:
    """Deployment archive as one row per installation and day, three columns per platform."""
    wide = archive.groupBy("inst_id", "date").pivot("os", platforms).agg(
        F.sum("standard").alias("st"), F.sum("extended").alias("ex"), F.sum("eol").alias("eol"))
    cols = [f"{p}_{level}" for p in platforms for level in ("st", "ex", "eol")]
    return wide.na.fill(0, subset=cols)
