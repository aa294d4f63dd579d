"""Metrics of the endpoint table (A5-A9): one scan for all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import percent
from ..functions.values import DEPLOYED_STATUSES
from .devices import anchored, number, since_newest


def is_deployed() -> Column:
    """Status whitelist."""
    return F.col("status").isin(DEPLOYED_STATUSES)


def fetched() -> Column:
    """Rows that describe a device, not a failed or empty fetch."""
    return F.col("fetch_status") == "OK"


def endpoint_counts(endpoints: DataFrame) -> DataFrame:
    """Counts per installation and live platform and version, the grain at which the lookup is joined.

    A third of all devices may run one version, so rows are counted before any join
    on the version.
    """
    devices = anchored(endpoints)
    recent, day, week = (since_newest(devices, days) for days in (30, 1, 7))
    device, deployed = fetched(), is_deployed()
    empty = F.col("fetch_status") == "NO_DEPLOYMENT"
    other = F.col("deployment_type") != "WORKLOAD"
    live = device & recent & deployed
    # Only live devices are told apart by version: all others of an installation share one group.
    return devices.groupBy("inst_id", F.when(live, F.col("os")).alias("os"),
                            F.when(live, F.col("sensor_version")).alias("version")).agg(
        number(endpoints, (device & recent) | empty).alias("seen"),
        number(endpoints, live).alias("deployed"),
        number(endpoints, live & (F.col("deployment_type") == "WORKLOAD")).alias("workload"),
        number(endpoints, device & recent & F.col("status").ilike("BYPASS")).alias("bypass"),
        number(endpoints, (device & other) | empty).alias("seen_other"),
        number(endpoints, device & other & deployed & day).alias("contact_1d"),
        number(endpoints, device & other & deployed & week).alias("contact_7d"),
    )


def endpoint_totals(endpoints: DataFrame, lookup: DataFrame) -> DataFrame:
    """Contact, bypass and support-level metrics per installation; everything but the licence share.

    A metric nobody could compute is NULL (no row in its window); a ratio whose
    denominator is zero is 0.
    """
    rated = endpoint_counts(endpoints).join(lookup, ["os", "version"], "left")
    level = lambda name: F.sum(F.when(F.col("support_level") == name, F.col("deployed")).otherwise(0))
    totals = rated.groupBy("inst_id").agg(
        F.sum("seen").alias("seen"), F.sum("seen_other").alias("seen_other"),
        F.sum("deployed").alias("deployed"), F.sum("workload").alias("workload"), F.sum("bypass").alias("bypass"),
        F.sum("contact_1d").alias("contact_1d"), F.sum("contact_7d").alias("contact_7d"),
        F.sum(F.when(F.col("version").isNotNull(), F.col("deployed")).otherwise(0)).alias("versions"),
        level("ST").alias("st"), level("EX").alias("ex"), level("EOL").alias("eol"),
        F.sum(F.when(~F.col("dl_available"), F.col("deployed")).otherwise(0)).alias("no_dl"))
    seen, other, live = F.col("seen") > 0, F.col("seen_other") > 0, F.col("deployed") > 0

    def share(n: str, whole: str, when: Column, name: str) -> Column:
        return F.when(when, F.coalesce(percent(F.col(n), F.col(whole)), F.lit(0.0))).alias(name)

    return totals.select(
        "inst_id",
        F.when(seen, F.col("deployed")).alias("deployment"),
        F.when(F.col("workload") > 0, F.col("workload")).alias("workload_deployment"),
        F.when(other, F.col("contact_1d")).alias("last_24_contact"),
        F.when(other, F.col("contact_7d")).alias("last_7d_contact"),
        F.when(seen, F.col("bypass")).alias("bypass"),
        share("bypass", "deployed", seen, "bypass_perc"),
        F.when(live, F.col("st")).alias("sensor_standard_support"), share("st", "versions", live, "standard_perc"),
        F.when(live, F.col("ex")).alias("sensor_extended_support"), share("ex", "versions", live, "extended_perc"),
        F.when(live, F.col("eol")).alias("sensor_eol_support"), share("eol", "versions", live, "eol_perc"),
        F.when(live, F.col("no_dl")).alias("sensor_download_unavailable"),
        share("no_dl", "versions", live, "download_unavailable_perc"))


def deployment_share(licences: str) -> Column:
    """Deployment as a percentage of the licences: 0 when these are unknown, NULL without a deployment count."""
    return F.when(F.col("deployment").isNotNull(), F.coalesce(percent(F.col("deployment"), F.col(licences)), F.lit(0.0)))


def endpoint_metrics(endpoints: DataFrame, licences: DataFrame, lookup: DataFrame) -> DataFrame:
    """All endpoint metrics, the licence share among them (J8: joined after aggregating)."""
    return (endpoint_totals(endpoints, lookup).join(licences.select("inst_id", "licenses_purchased"), "inst_id", "left")
            .withColumn("deployment_perc", deployment_share("licenses_purchased")).drop("licenses_purchased"))
