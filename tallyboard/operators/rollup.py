"""Installations -> accounts, from a list of column rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import percent, ratio
from ..functions.values import INTEGRATION_TERMS

# Account columns by how they are made, in report order.
SPEC: list[tuple[str, str]] = [
    ("csm", "max"), ("csm_manager", "max"), ("cse", "max"), ("csm_role", "max"), ("cs_tier", "max"),
    ("prev_cs_tier", "max"), ("csm_comments", "max"), ("gs_adoption_comments", "max"), ("arr", "max"), ("acv", "max"),
    ("opportunity_ct", "max"), ("forecast", "max"), ("products", "max"), ("next_renewal", "max"),
    ("next_renewal_qt", "max"), ("gs_meter", "max"), ("gs_overall", "max"), ("gs_last_updated", "max"),
    ("last_cua_cta", "max"), ("cua_status", "max"), ("last_ta", "max"), ("last_wb", "max"),
    ("last_cse_timeline", "max"), ("last_login", "max"), ("days_since_login", "min"),
    ("last_30d_login_count", "sum"), ("last_30d_connector_count", "sum"), ("integrations", "terms"),
    ("last_added_user", "min"), ("last_created_policy", "min"), ("last_modified_policy", "min"),
    ("created_date", "max"), ("days_to_50perc", "max"), ("licenses", "max"), ("deployment", "sum"),
    ("deployment_perc", "of licenses"), ("last_24_contact", "sum"), ("last_7d_contact", "sum"),
    ("workload_deployment", "sum"), ("bypass", "sum"), ("bypass_perc", "bypass"), ("last_30d_bypass_count", "sum"),
    ("sensor_download_unavailable", "sum"), ("download_unavailable_perc", "sensor_download_unavailable"),
    ("sensor_standard_support", "sum"), ("standard_perc", "sensor_standard_support"),
    ("sensor_extended_support", "sum"), ("extended_perc", "sensor_extended_support"),
    ("sensor_eol_support", "sum"), ("eol_perc", "sensor_eol_support"), ("total_cases_30d", "max"),
    ("cbc_cases_30d", "max"), ("open_cases", "max"), ("open_cbc_cases", "max"), ("open_alerts", "sum"),
    ("dismissed_alerts", "sum"), ("terminated_alerts", "sum"), ("denied_alerts", "sum"),
    ("allow_and_log_alerts", "sum"), ("ran_alerts", "sum"), ("not_ran_alerts", "sum"),
    ("policy_applied_alerts", "sum"), ("policy_not_applied_alerts", "sum"), ("prod", "max"),
    ("account_id", "max"), ("members", "members"), ("peak_daily_consumption", "sum"),
    ("average_monthly_consumption", "mean"),
]
# Beyond the report: what the rules need at account grain.
RULE_SPEC = [("cbc_cases_90d", "min"), ("bypass_all", "any")]


TERM_LABELS = sorted({t.replace(".*", "") for t in INTEGRATION_TERMS})


def _column(name: str, kind: str) -> Column:
    simple = {"max": F.max, "min": F.min, "sum": F.sum, "any": F.bool_or}
    if kind in simple:
        return simple[kind](name)
    if kind == "mean":
        return ratio(F.sum(name), F.count("inst_id"))
    if kind == "of licenses":
        return percent(F.sum("deployment"), F.max("licenses"))
    if kind == "members":
        return F.count("inst_id")
    if kind == "terms":
        # A flag for each known term: the cell is bounded whatever the account holds.
        has = lambda t: F.bool_or(F.array_contains(F.split(name, ", "), t))
        found = F.array_join(F.array_compact(F.array(*[F.when(has(t), F.lit(t)) for t in TERM_LABELS])), ", ")
        return F.nullif(found, F.lit(""))
    return percent(F.sum(kind), F.sum("deployment"))


def account_members(master: DataFrame) -> DataFrame:
    """The installations and organisations of each account, a row each."""
    return master.filter(F.col("account_name").isNotNull()).select("account_name", "inst_id", "orgid", "account__c")


def account_rollup(master: DataFrame) -> DataFrame:
    """One row per account, from one pass: every cell is a pre-aggregated max, min, sum or flag.

    ``members`` counts the installations; ``account_members`` has them.
    """
    aggs = [_column(name, kind).alias(name) for name, kind in SPEC + RULE_SPEC]
    return master.filter(F.col("account_name").isNotNull()).groupBy("account_name").agg(*aggs)
