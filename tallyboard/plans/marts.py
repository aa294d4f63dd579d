"""Report marts (M1-M10) and their writers (K6, K7): all owners and accounts in one job each."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.time import ms_to_date
from ..operators import histograms as h
from ..operators.audit import bypass_display
from ..operators.history import archive_series
from ..operators.keyed import in_band, owned_by, tolerant_select
from ..operators.ranking import position
from ..operators.rollup import account_members
from ..operators.series import activity_series

# Report columns in order, with heading and number format.
REPORT_COLUMNS = [
    ("account_name", "Account Name", "plain"), ("csm", "CSM", "plain"), ("csm_manager", "CSM Manager", "plain"), ("cse", "CSE", "plain"),
    ("cs_tier", "CS Tier", "plain"), ("prev_cs_tier", "Prev CS Tier", "plain"), ("arr", "ARR", "money"), ("acv", "ACV", "money"),
    ("products", "Products", "plain"), ("next_renewal", "Next Renewal", "plain"), ("next_renewal_qt", "Next Renewal Qt", "plain"),
    ("forecast", "Forecast", "plain"), ("gs_meter", "GS Meter", "plain"), ("gs_overall", "GS Overall", "plain"),
    ("csm_comments", "CSM Comments", "plain"), ("gs_adoption_comments", "GS Adoption Comments", "plain"), ("last_cua_cta", "Last CUA CTA", "plain"),
    ("cua_status", "CUA Status", "plain"), ("last_ta", "Last TA", "plain"), ("last_wb", "Last WB", "plain"),
    ("last_cse_timeline", "Last CSE Timeline", "plain"), ("cua_brag", "CUA Brag", "plain"), ("count_of_violations", "CUA Score", "plain"),
    ("violations_triggered", "Score Detail", "plain"), ("brag_decrease", "BRAG Decrease", "plain"), ("last_login", "Last Login", "plain"),
    ("days_since_login", "Days Since Login", "plain"), ("last_30d_login_count", "Last 30d Login Count", "plain"),
    ("last_30d_connector_count", "Last 30d Connector Count", "plain"), ("integrations", "Integrations", "plain"),
    ("last_added_user", "Last Added User", "plain"), ("last_created_policy", "Last Created Policy", "plain"),
    ("last_modified_policy", "Last Modified Policy", "plain"), ("created_date", "Created Date", "plain"), ("days_to_50perc", "Days To 50%", "plain"),
    ("licenses", "Licenses", "plain"), ("deployment", "Deployment", "plain"), ("deployment_perc", "Deployment %", "percent"),
    ("peak_daily_consumption", "Peak Daily Consumption", "plain"), ("average_monthly_consumption", "Average Monthly Consumption", "plain"),
    ("last_7d_contact", "Last 7d contact", "plain"), ("last_24_contact", "Last 24 contact", "plain"),
    ("workload_deployment", "Workload Deployment", "plain"), ("bypass", "Bypass", "plain"), ("bypass_perc", "Bypass %", "percent"),
    ("last_30d_bypass_count", "Last 30d Bypass Count", "plain"), ("sensor_download_unavailable", "Sensor Download Unavailable", "plain"),
    ("download_unavailable_perc", "Download Unavailable %", "percent"), ("sensor_standard_support", "Sensor Standard Support", "plain"),
    ("standard_perc", "Standard %", "percent"), ("sensor_extended_support", "Sensor Extended Support", "plain"),
    ("extended_perc", "Extended %", "percent"), ("sensor_eol_support", "Sensor EOL Support", "plain"), ("eol_perc", "EOL %", "percent"),
    ("total_cases_30d", "Total Cases 30D", "plain"), ("cbc_cases_30d", "Cbc Cases 30D", "plain"), ("open_cases", "Open Cases", "plain"),
    ("open_cbc_cases", "Open Cbc Cases", "plain"), ("open_alerts", "Open Alerts", "plain"), ("dismissed_alerts", "Dismissed Alerts", "plain"),
    ("terminated_alerts", "Terminated Alerts", "plain"), ("denied_alerts", "Denied Alerts", "plain"),
    ("allow_and_log_alerts", "Allow and Log Alerts", "plain"), ("ran_alerts", "Ran Alerts", "plain"), ("not_ran_alerts", "Not Ran Alerts", "plain"),
    ("policy_applied_alerts", "Policy Applied Alerts", "plain"), ("policy_not_applied_alerts", "Policy Not Applied Alerts", "plain"),
    ("prod", "Prod", "plain"), ("orgid", "OrgID", "plain"), ("account_id", "Account ID", "plain"), ("inst_id", "Inst Id", "plain"),
]
MASTER_FIELDS = [name for name, _, _ in REPORT_COLUMNS]
#: An account has no installation of its own, but a number of them.
ACCOUNT_FIELDS = [f for f in MASTER_FIELDS if f not in ("orgid", "inst_id")] + ["members"]
EVENT_TIMES = ["last_login", "last_added_user", "last_created_policy", "last_modified_policy"]
# Row order of the account report sections.
SECTION_ORDER = {"version_status": ("os", "version"), "os_status": ("os_version",), "signatures": ("av_vdf_version",), "activity": ("bucket",),
                 "master_trend": ("date",), "consumption": ("date",), "deployment_archive": ("date", "os"), "os_support": ("os",)}
# BI export column -> source column.
BI_FIELDS = {
    "account_name": "account_name", "csm": "csm", "cse": "cse", "last_cua_cta": "last_cua_cta",
    "cua_status": "cua_status", "last_ta": "last_ta", "cua_brag": "cua_brag", "CUA Score": "count_of_violations",
    "CUA Score Reasons": "violations_triggered", "licenses": "licenses", "deployment": "deployment",
    "deployment_perc": "deployment_perc", "last_7d_contact": "last_7d_contact", "prod": "prod", "orgid": "orgid",
}


def master_sheet(table: DataFrame, owner: str = "all", fields: list[str] = MASTER_FIELDS) -> DataFrame:
    """Ordered report columns of one owner's rows (M1): event times as dates, bypass as shown."""
    shown = owned_by(table, owner)
    for c in EVENT_TIMES:
        if c in shown.columns:
            shown = shown.withColumn(c, ms_to_date(F.col(c)))
    if "bypass_all" in shown.columns:
        shown = shown.withColumn("last_30d_bypass_count", bypass_display())
    return tolerant_select(shown, fields)


def column_metadata() -> list[tuple[str, str, str]]:
    """(column, heading, number format) of every report column."""
    return list(REPORT_COLUMNS)


def with_account(long: DataFrame, accounts: DataFrame, owner: str = "all") -> DataFrame:
    """Histogram rows with account name and owner, for one owner or all."""
    return owned_by(long.join(accounts.select("inst_id", "account_name", "csm"), "inst_id", "left"), owner)


def versions_sheet(long: DataFrame, accounts: DataFrame, owner: str = "all") -> DataFrame:
    """Account x version (or OS version) counts; versions without a device do not appear."""
    return h.nonzero(with_account(long, accounts, owner)).select("account_name", "inst_id", "csm", "label", "n")


def deployment_sheet(summary: DataFrame, master: DataFrame, keys: list[str], owner: str = "all") -> DataFrame:
    """Account facts and one column per given platform, support level and version family (M4, F16)."""
    wide = h.widen(summary, keys, ["inst_id"], "key")
    facts = master.select("inst_id", "account_name", "csm", "arr", "licenses", "deployment")
    joined = owned_by(facts.join(wide, "inst_id", "left"), owner)
    cell = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) if c in keys else F.col(c)
    return joined.select("inst_id", *[cell(c) for c in h.ordered_columns([*facts.columns, *keys])])


def deployment_rows(summary: DataFrame, master: DataFrame, owner: str = "all") -> DataFrame:
    """Account facts and a row per platform, support level and version family, whatever they are (M4); installations without devices have one row."""
    facts = master.select("inst_id", "account_name", "csm", "arr", "licenses", "deployment")
    return owned_by(facts.join(summary, "inst_id", "left"), owner)


def trend_sheet(trend: DataFrame, major: str = "3") -> DataFrame:
    """Trend rows of the versions of one major line (M5); the section is the backend."""
    return trend.filter(F.col("version").like(f"{major}%")).select(F.col("backend").alias("section"), "date", "version", "n")


def trend_percent_sheet(trend: DataFrame, major: str = "3") -> DataFrame:
    """Trend as percentages of the backend's day (M6)."""
    return h.share_of_total(trend_sheet(trend, major), ["section", "date"])


def consumption_series(archive: DataFrame) -> DataFrame:
    """Month, peak consumption and deployment per snapshot (M8)."""
    return archive.select("inst_id", F.date_format("date", "yyyy-MM").alias("month"), "date",
                          "peak_daily_consumption", "deployment")


def account_sections(t: dict[str, DataFrame], lookup: DataFrame, as_of: dt.datetime) -> dict[str, DataFrame]:
    """The sections of every account's report (M7), one table per section over all accounts."""
    sections = {
        "version_status": h.version_status(t["endpoints"], lookup, as_of),
        "os_status": h.os_status(t["endpoints"], lookup, as_of),
        "os_support": h.os_support(t["endpoints"], lookup, as_of),
        "signatures": h.signature_versions(t["endpoints"], as_of),
        "activity": activity_series(t["audit"], t["sf_data"], as_of),
    }
    if "master_archive" in t:
        sections["master_trend"] = archive_series(t["master_archive"], MASTER_FIELDS)
        sections["consumption"] = consumption_series(t["master_archive"])
    if "deployment_archive" in t:
        sections["deployment_archive"] = t["deployment_archive"].select("inst_id", "date", "os", "standard", "extended", "eol")
    return {name: df.withColumn("section", F.lit(name)) for name, df in sections.items()}


def engineer_packs(master: DataFrame, accounts: DataFrame) -> dict[str, DataFrame]:
    """Master, account master, reds and yellows keyed by engineer, names in any case."""
    keyed = lambda df: (df.filter(F.col("cse").isNotNull() & (F.col("cse") != "None"))
                        .withColumn("cse_key", F.lower("cse")))
    sheet = lambda df, fields=ACCOUNT_FIELDS: tolerant_select(keyed(df), ["cse_key", *fields])
    return {"master": sheet(master, MASTER_FIELDS), "account_master": sheet(accounts), "reds": sheet(in_band(accounts, "Red")),
            "yellows": sheet(in_band(accounts, "Yellow"))}


def engineer_installations(sf_data: DataFrame) -> DataFrame:
    """Installations of each engineer, names in any case, one row each."""
    return (sf_data.filter(F.col("cse").isNotNull() & (F.col("cse") != "None"))
            .select(F.lower("cse").alias("cse_key"), "inst_id"))


def bi_export(account_master: DataFrame, master: DataFrame, sf_data: DataFrame) -> DataFrame:
    """17 columns per account and installation, joined on the installation itself (K6).

    Every account comes from its members, so the members lead: the side with the hot accounts is one that can be split.
    """
    ids = sf_data.select("inst_id", "account__c")
    rows = (account_members(master).drop("account__c").join(account_master, "account_name").join(ids, "inst_id", "left"))
    return rows.select(*[F.col(old).alias(new) for new, old in BI_FIELDS.items()], "account__c", "inst_id")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_by_owner(df: DataFrame, owner: str, path: str, order: tuple[str, ...] = ("account_name",)) -> None:
    """One folder per owner (K7), in report order (O1).

    The rebalance hint gathers an owner's rows into few files and splits an owner
    that holds too many rows for one task. A mart without rows has no folders, so
    its columns are kept beside it (K10).
    """
    (df.hint("rebalance", owner).sortWithinPartitions(owner, *order)
     .write.mode("overwrite").partitionBy(owner).parquet(path))
    df.limit(0).write.mode("overwrite").parquet(f"{path}.columns")


def write_by_installation(df: DataFrame, path: str, order: tuple[str, ...] = ()) -> None:
    """Files of adjoining installations, so that one account's report reads few of them (M7, O1)."""
    (df.repartitionByRange("inst_id", *order).sortWithinPartitions("inst_id", *order)
     .write.mode("overwrite").parquet(path))


def owner_positions(master: DataFrame) -> DataFrame:
    """Place of each installation in its owner's report (O3)."""
    named = master.filter(F.col("csm").isNotNull()).select("csm", "account_name", "inst_id")
    return position(named, "csm", ["account_name", "inst_id"])


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """A mart foldered by owner, with the columns and types it was written with."""
    return spark.read.schema(spark.read.parquet(f"{path}.columns").schema).parquet(path)


def read_owner(spark: SparkSession, path: str, owner: str, value: str) -> DataFrame:
    """An owner's mart: a partition-pruned read."""
    return read_mart(spark, path).filter(F.col(owner) == value)
