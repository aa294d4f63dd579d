"""Warehouse extracts: CRM tables -> per-installation facts.

Accounts own several installations. Every account fact is aggregated per account
first and fanned out afterwards, so an account's rows never meet all of its
installations inside a join.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import contains_any
from ..functions.time import calendar_days, iso_utc
from ..functions.values import (CSE_ACTIVITY, CTA_EXCLUDED, CTA_OPEN, CTA_TYPES, FISCAL_CALENDAR_END,
                                FISCAL_QUARTERS, LICENCE_STATUSES, RENEWAL_FAMILIES)
from ..operators.anchors import after_today, day_within, within_year
from ..operators.keyed import fan_out, latest_max, restrict_to
from ..operators.lists import set_list


def read_table(spark: SparkSession, source: str, format: str | None = None, **options: str) -> DataFrame:
    """A warehouse table: catalog name, or path plus format (parquet, csv, jdbc, ...)."""
    if format is None:
        return spark.table(source)
    reader = spark.read.format(format).options(**options)
    return reader.option("dbtable", source).load() if format == "jdbc" else reader.load(source)


def roster(installations: DataFrame) -> DataFrame:
    """Installations that can be asked for: known backend and organisation."""
    return (installations.filter(F.col("backend").isNotNull() & F.col("org_id").isNotNull())
            .select("inst_id", "backend", "org_id"))


def account_owners(accounts: DataFrame, users: DataFrame) -> DataFrame:
    """Account attributes with the names of its three owners: the user table joined three times."""
    person = lambda role, *cols: users.select(
        F.col("user_id").alias(f"{role}_id"), *[F.col(c).alias(f"{role}_{c}") for c in cols])
    return (accounts
            .join(person("csm", "name", "manager_id"), "csm_id", "left")
            .join(person("manager", "name"), F.col("csm_manager_id") == F.col("manager_id"), "left")
            .join(person("cse", "name", "email"), "cse_id", "left")
            .select("account_id", F.col("name").alias("account_name"), "arr", F.col("csm_name").alias("csm"),
                    F.col("manager_name").alias("csm_manager"), F.col("cse_name").alias("cse"), "csm_role",
                    "gsm_score", "gs_overall", "gs_last_update_date", "tier", "previous_tier",
                    "csm_comments", "gs_adoption_comments", "cse_email"))


def account_info(accounts: DataFrame, installations: DataFrame, users: DataFrame) -> DataFrame:
    """Account attributes and owners of each installation."""
    return installations.select("inst_id", "account_id").join(account_owners(accounts, users), "account_id")


def licensed(installations: DataFrame) -> DataFrame:
    """Installations that carry licences: live or unknown status, subscription, real organisation."""
    live = F.col("status").isin(LICENCE_STATUSES) | F.col("status").isNull()
    return installations.filter(F.col("org_id").isNotNull() & live & F.col("type").like("%Subscription%")
                                & (F.col("backend") != "None"))


def account_licences(installations: DataFrame, accounts: DataFrame) -> DataFrame:
    """Largest licence count among an account's licensed installations, and its parent account."""
    most = licensed(installations).groupBy("account_id").agg(F.max("licences").alias("licenses_purchased"))
    parents = accounts.select("account_id", F.col("parent_account").alias("account__c"))
    return most.join(parents, "account_id", "left")


def sibling_licences(installations: DataFrame, accounts: DataFrame) -> DataFrame:
    """The account's licence count for all of its installations."""
    return fan_out(account_licences(installations, accounts), installations)


def installation_info(installations: DataFrame, *more: Column) -> DataFrame:
    """Creation date and calendar days until half deployed."""
    return installations.select("inst_id", *more, F.to_date("created").alias("created_date"),
                                calendar_days(F.col("created"), F.col("half_deployed")).alias("days_to_50perc"))


def account_products(subscriptions: DataFrame) -> DataFrame:
    """Sorted distinct product groups of each account."""
    named = subscriptions.filter(F.col("product_group") != "")
    return set_list(named, ["account_id"], "product_group").withColumnRenamed("product_group", "products")


def products(subscriptions: DataFrame, installations: DataFrame) -> DataFrame:
    """Product groups of the account, for all of its installations."""
    return fan_out(account_products(subscriptions), installations)


def fiscal_quarter(day: Column) -> Column:
    """Fiscal quarter of a date, ``Unknown`` outside the calendar.

    The calendar is 24 closed, adjoining intervals: a branch per quarter in the
    projection, tried newest first, and no join.
    """
    label = F.when(day > F.lit(FISCAL_CALENDAR_END).cast("date"), "Unknown")
    for name, start in reversed(FISCAL_QUARTERS):
        label = label.when(day >= F.lit(start).cast("date"), name)
    return label.otherwise("Unknown")


def renewal_filter(opportunities: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Open renewals of the product families that matter."""
    return opportunities.filter(after_today(F.col("close_date"), as_of) & F.col("type").like("%Renewal%")
                                & contains_any(F.col("product_family"), RENEWAL_FAMILIES))


def account_forecasts(opportunities: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Renewals of each account by forecast category: how many, their value and first date (A18). The only pass."""
    return renewal_filter(opportunities, as_of).groupBy("account_id", "forecast").agg(
        F.count("opp_id").alias("n"), F.sum(F.col("amount").cast("decimal(18,2)")).alias("amount"), F.min("close_date").alias("first_date"))


def account_renewals(opportunities: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Renewal value, count, distinct forecasts and next date of each account."""
    names = F.array_sort(F.collect_list("forecast"))  # distinct already
    totals = account_forecasts(opportunities, as_of).groupBy("account_id").agg(
        F.sum("amount").cast("double").alias("acv"), F.sum("n").alias("opp_ct"), F.min("first_date").alias("renewal_date"),
        F.when(F.size(names) > 0, F.array_join(names, ",")).alias("forecast"))
    return totals.withColumn("renewal_quar", fiscal_quarter(F.col("renewal_date")))


def renewals(opportunities: DataFrame, installations: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Renewals of the account, for all of its installations."""
    return fan_out(account_renewals(opportunities, as_of), installations)


def account_cases(cases: DataFrame, as_of: dt.datetime, product_groups: list[str]) -> DataFrame:
    """Case counts of the last 30 and 90 days and of open cases, all and in the product groups.

    One pass over the cases. A window without any case gives NULL, not 0.
    """
    cases = cases.select("account_id", "product_group", "status", iso_utc(F.col("created")).alias("opened"))
    created = F.col("opened")
    windows = {"30d": day_within(created, as_of, 30), "90d": day_within(created, as_of, 90),
               "open": F.col("status") != "Closed"}
    ours = F.col("product_group").isin(product_groups)
    wanted = cases.filter(windows["90d"] | windows["open"])
    counts = []
    for name, inside in windows.items():
        total, subset = (("open_cases", "open_cbc_cases") if name == "open"
                         else (f"total_cases_{name}", f"cbc_cases_{name}"))
        counts += [F.sum(F.when(inside, 1)).alias(total),
                   F.sum(F.when(inside, F.when(ours, 1).otherwise(0))).alias(subset)]
    return wanted.groupBy("account_id").agg(*counts)


def zero_without_recent_cases(table: DataFrame, counts: DataFrame) -> DataFrame:
    """Zeros for every installation when no account has a case of the last 30 days: the feed has stopped."""
    recent = counts.select(F.coalesce(F.bool_or(F.col("total_cases_30d").isNotNull()), F.lit(False))).scalar()
    zeroed = ("total_cases_30d", "cbc_cases_30d")
    return table.withColumns({c: F.when(recent, F.col(c)).otherwise(F.lit(0)) for c in zeroed})


def case_counts(cases: DataFrame, installations: DataFrame, as_of: dt.datetime, product_groups: list[str]) -> DataFrame:
    """Case counts of the account, for all of its installations."""
    return fan_out(account_cases(cases, as_of, product_groups), installations)


def account_ctas(ctas: DataFrame) -> DataFrame:
    """Last closed date and status of each kind of call to action (A20); any open one makes ``Open``."""
    valid = ctas.filter(F.col("reason").isin(list(CTA_TYPES)) & ~F.col("status").isin(CTA_EXCLUDED))
    is_open = F.col("status").isin(CTA_OPEN)
    picks = [F.max(F.when(F.col("reason") == reason, F.col("closed_date"))).alias(f"last_{short}")
             for reason, short in CTA_TYPES.items()]
    cua = F.col("reason") == next(iter(CTA_TYPES))
    state = F.max(F.when(cua, F.when(is_open, 1).otherwise(0)))
    return (valid.groupBy("account_id").agg(*picks, state.alias("_open"))
            .withColumn("cua_status", F.when(F.col("_open") == 1, "Open").when(F.col("_open") == 0, "Closed"))
            .drop("_open"))


def cta_status(ctas: DataFrame, installations: DataFrame) -> DataFrame:
    """Calls to action of the account for each installation; NULLs where there is none."""
    return (installations.select("inst_id", "account_id").join(account_ctas(ctas), "account_id", "left")
            .select("inst_id", "last_cua", "cua_status", "last_ta", "last_wb"))


def latest_consumption(licences: DataFrame, installations: DataFrame) -> DataFrame:
    """Peak and monthly-average consumption from each organisation's newest snapshot."""
    newest = latest_max(licences, ["prodkey"], "calendarid",
                        {"peak_daily_consumption": "deployed_last_day", "average_monthly_consumption": "month_average"})
    return (installations.select("inst_id", F.concat("backend", F.lit("|"), "org_id").alias("prodkey"))
            .join(newest, "prodkey")
            .select("inst_id", "peak_daily_consumption",
                    F.round("average_monthly_consumption").alias("average_monthly_consumption")))


def activity(timeline: DataFrame, accounts: DataFrame, as_of: dt.datetime, type_name: str = CSE_ACTIVITY) -> DataFrame:
    """Staff activities of the last year with their account's name."""
    return (timeline.filter((F.col("type_name") == type_name) & within_year(F.col("activity_date"), as_of))
            .join(accounts.select("account_id", F.col("name").alias("account")), "account_id", "left")
            .select("account", "activity_date"))


DATE_PATTERNS = ["yyyy-MM-dd", "M/d/yyyy", "d MMM yyyy", "MMM d, yyyy"]


def activity_dates(rows: DataFrame) -> DataFrame:
    """Keep the activities whose date text can be read."""
    tries = [F.try_to_timestamp(F.col("activity_date"), F.lit(p)).cast("date") for p in DATE_PATTERNS]
    return (rows.select("account", F.coalesce(*tries).alias("activity_date"))
            .filter(F.col("activity_date").isNotNull()))


def activity_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Activities from exported CSV files: first and sixth column of every file matching the pattern."""
    raw = spark.read.schema("account string, c2 string, c3 string, c4 string, c5 string, activity_date string").csv(pattern)
    return activity_dates(raw)


def with_last_activity(table: DataFrame, activities: DataFrame) -> DataFrame:
    """Add the newest activity of the account to its installations (A16, J6); names match in any case."""
    newest = (activities.filter(F.col("account") != "")
              .groupBy(F.lower("account").alias("_account")).agg(F.max("activity_date").alias("last_cse_timeline")))
    return table.join(newest, F.lower("account_name") == F.col("_account"), "left").drop("_account")


def build_sf_data(roster: DataFrame, w: dict[str, DataFrame], as_of: dt.datetime, product_groups: list[str]) -> DataFrame:
    """The wide per-installation warehouse table (K3).

    All account facts are joined at account grain, where every side is already
    partitioned by account and unique on it; the installations meet them in one
    join at the end.
    """
    mine = restrict_to(w["installation"], roster)
    by_cases = account_cases(w["case"], as_of, product_groups)
    facts = [
        account_owners(w["account"], w["user"]).withColumn("_account", F.col("account_id")),
        *[f.withColumnRenamed("account_id", "_account") for f in (
            account_licences(w["installation"], w["account"]), account_products(w["subscription"]),
            account_renewals(w["opportunity"], as_of), by_cases,
            account_ctas(w["cta"]))],
    ]
    spine = mine.select(F.col("account_id").alias("_account")).distinct()
    by_account = reduce(lambda left, fact: left.join(fact, "_account", "left"), facts, spine)
    members = installation_info(mine, F.col("account_id").alias("_account"))
    wide = roster.join(members, "inst_id", "left").join(by_account, "_account", "left").drop("_account")
    return zero_without_recent_cases(wide, by_cases)
