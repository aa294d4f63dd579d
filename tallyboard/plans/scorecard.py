"""The scorecard: typed tables -> master -> account_master."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.audit import audit_metrics
from ..operators.endpoints import deployment_share, endpoint_totals
from ..operators.history import with_decline, with_previous
from ..operators.lookups import all_names, integrations
from ..operators.rollup import account_rollup
from ..operators.rules import score
from ..sources.warehouse import with_last_activity

# Warehouse column -> master column.
MASTER_NAMES = {
    "inst_id": "inst_id", "backend": "prod", "org_id": "orgid", "account_name": "account_name", "arr": "arr",
    "csm": "csm", "csm_manager": "csm_manager", "cse": "cse", "csm_role": "csm_role", "gsm_score": "gs_meter",
    "gs_overall": "gs_overall", "gs_last_update_date": "gs_last_updated", "account_id": "account_id",
    "tier": "cs_tier", "previous_tier": "prev_cs_tier", "csm_comments": "csm_comments",
    "gs_adoption_comments": "gs_adoption_comments", "cse_email": "cse_email", "licenses_purchased": "licenses",
    "account__c": "account__c", "created_date": "created_date", "days_to_50perc": "days_to_50perc",
    "products": "products", "acv": "acv", "opp_ct": "opportunity_ct", "forecast": "forecast",
    "renewal_date": "next_renewal", "renewal_quar": "next_renewal_qt", "total_cases_30d": "total_cases_30d",
    "cbc_cases_30d": "cbc_cases_30d", "open_cases": "open_cases", "open_cbc_cases": "open_cbc_cases",
    "last_cua": "last_cua_cta", "cua_status": "cua_status", "last_ta": "last_ta", "last_wb": "last_wb",
}
ALERT_NAMES = {
    "open": "open_alerts", "dismissed": "dismissed_alerts", "terminated": "terminated_alerts",
    "denied": "denied_alerts", "allow_log": "allow_and_log_alerts", "ran": "ran_alerts", "not_ran": "not_ran_alerts",
    "policy_applied": "policy_applied_alerts", "policy_not_applied": "policy_not_applied_alerts",
}


def base_master(sf_data: DataFrame, alerts: DataFrame, consumption: DataFrame) -> DataFrame:
    """Warehouse facts under their report names, alert counters and consumption."""
    extra = [c for c in ("total_cases_90d", "cbc_cases_90d") if c in sf_data.columns]
    base = sf_data.select(*[F.col(old).alias(new) for old, new in MASTER_NAMES.items()], *extra)
    counters = alerts.select("inst_id", *[F.col(old).alias(new) for old, new in ALERT_NAMES.items()])
    return base.join(counters, "inst_id", "left").join(consumption, "inst_id", "left")


def installation_facts(t: dict[str, DataFrame], lookup: DataFrame, as_of: dt.datetime, newest_event: Column | None = None) -> dict[str, DataFrame]:
    """What the feeds tell of an installation: tables of one row each."""
    return {
        "audit_facts": audit_metrics(t["audit"], as_of, newest_event),
        "integration_facts": integrations(all_names(t["forwarders"], t["connectors"])),
        "endpoint_facts": endpoint_totals(t["endpoints"], lookup),
    }


def activity_facts(sf_data: DataFrame, activities: DataFrame) -> DataFrame:
    """Newest activity by installation: met by account name in two columns, so that the wide rows need not move."""
    return with_last_activity(sf_data.select("inst_id", "account_name"), activities).select("inst_id", "last_cse_timeline")


def assemble(t: dict[str, DataFrame], facts: dict[str, DataFrame]) -> DataFrame:
    """One left join per source, each side one row per installation (K3).

    All joins are by ``inst_id``: over tables in buckets of it (``stored.write_bucketed``) none of them shuffles.
    """
    base = base_master(t["sf_data"], t["alerts"], t["new_deployment"])
    return reduce(lambda left, right: left.join(right, "inst_id", "left"), facts.values(), base)


def with_deployment_share(assembled: DataFrame) -> DataFrame:
    return assembled.withColumn("deployment_perc", deployment_share("licenses"))


def master_metrics(t: dict[str, DataFrame], lookup: DataFrame, as_of: dt.datetime, newest_event: Column | None = None) -> DataFrame:
    """Master without scores, in one plan from the typed tables."""
    joined = assemble(t, installation_facts(t, lookup, as_of, newest_event))
    return with_deployment_share(with_last_activity(joined, t["cse_activity"]))


def score_installations(metrics: DataFrame, archive: DataFrame | None, as_of: dt.datetime) -> DataFrame:
    """Scores, bands and band decline per installation."""
    scored = score(with_previous(metrics, archive, as_of), as_of)
    return with_decline(scored)


def score_accounts(master: DataFrame, archive: DataFrame | None, as_of: dt.datetime) -> DataFrame:
    """Account rollup with its own scores; band decline is not followed at this grain."""
    rolled = account_rollup(master)
    scored = score(with_previous(rolled, archive, as_of, "account_name"), as_of)
    return scored.drop("previous_deployment", "previous_brag", "first_run").withColumn("brag_decrease", F.lit("NA"))
