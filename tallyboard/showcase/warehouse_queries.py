"""Warehouse extracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import keyed, lists
from ..plans import scorecard
from ..sources import warehouse as w
from . import oracle as o  # noqa: F401  (adds the larger tables to the oracle)
from .estate import AS_OF, PRODUCT_GROUPS, TODAY, oracle
from .registry import Query


def all_of(table: str) -> str:
    return oracle(f"select * from {table}", table)


def quarters(e):
    day = F.date_add(F.to_date("o_orderdate"), 8400)
    return e.raw("orders").select("o_orderkey", day.alias("day"), w.fiscal_quarter(day).alias("quarter"))


def last_activities(e):
    mine = keyed.restrict_to(e.installation, e.roster)
    named = w.account_info(e.account, mine, e.user).select("inst_id", "account_name")
    return (w.with_last_activity(named, w.activity(e.activity_timeline, e.account, AS_OF))
            .filter(F.col("last_cse_timeline").isNotNull()).drop("account_name"))


QUERIES = [
    Query("f01_on_roster", "F1", lambda e: keyed.restrict_to(e.endpoints, e.roster).groupBy("inst_id", "status").agg(F.count("*").alias("n")),
          oracle("select inst_id, status, count(*) as n from endpoints where inst_id in (select inst_id from roster) group by 1, 2", "roster", "endpoints")),
    Query("j01_account_info", "J1", lambda e: w.account_info(e.account, e.installation, e.user), all_of("account_info")),
    Query("j02_sibling_licences", "J2 F3 F6", lambda e: w.sibling_licences(e.installation, e.account), all_of("sibling_licences")),
    Query("f17_installation_info", "F17 X12", lambda e: w.installation_info(e.installation), all_of("installation_info")),
    Query("j20_products", "J20 A22 X7", lambda e: w.products(e.subscription, e.installation), all_of("products")),
    Query("j03_renewals", "J3 A18 F3 F4 F10 J15 X7", lambda e: w.renewals(e.opportunity, e.installation, AS_OF), all_of("renewals")),
    Query("a18_forecast_parts", "A18 X7", lambda e: w.account_forecasts(e.opportunity, AS_OF).select("account_id", "forecast", "n"),
          oracle(f"select account_id, forecast, count(*) as n from opportunity where close_date > {TODAY} and type like '%Renewal%' and ({o._FAMILY}) group by 1, 2", "opportunity")),
    Query("a18_account_forecasts", "A18 X7", lambda e: w.account_forecasts(e.opportunity, AS_OF).withColumn("amount", F.col("amount").cast("double")),
          oracle(f"select account_id, forecast, count(opp_id) as n, cast(sum(cast(amount as decimal(18,2))) as double) as amount, min(close_date) as first_date from opportunity where close_date > {TODAY} and type like '%Renewal%' and ({o._FAMILY}) group by 1, 2", "opportunity")),
    Query("j15_fiscal_quarter", "J15", quarters,
          oracle("""select o_orderkey, day, coalesce((select label from calendar where day between first_day and last_day), 'Unknown') as quarter
             from (select o_orderkey, cast(o_orderdate as date) + 8400 as day from orders) d""", "calendar")),
    Query("j04_case_counts", "J4 A19 F10 X13 K10", lambda e: w.case_counts(e.case, e.installation, AS_OF, PRODUCT_GROUPS), all_of("case_counts")),
    Query("a20_cta_status", "A20 J6 J7", lambda e: w.cta_status(e.cta, e.installation), all_of("cta_status")),
    Query("j05_latest_consumption", "J5 A21 W1 X6", lambda e: w.latest_consumption(e.deployed_licence, e.installation), all_of("new_deployment")),
    Query("a16_last_activity", "A16 J6", last_activities, all_of("last_activity")),
    Query("k03_sf_data", "K3 J1 J2 J3 J4", lambda e: e.sf_plan, all_of("sf_data")),
    Query("j21_base_master", "J21 K3", lambda e: scorecard.base_master(e.sf_plan, e.alerts, w.latest_consumption(e.deployed_licence, e.installation)), all_of("base_master")),
    Query("w01_latest_row", "W1 A17", lambda e: keyed.latest_row(e.raw("events").select("user_id", "ts", "event_id", "event_type", "value"), ["user_id"], ["ts", "event_id"]),
          "select user_id, max(ts) as ts, max_by(event_id, ts) as event_id, max_by(event_type, ts) as event_type, max_by(value, ts) as value from events group by 1"),
    Query("k03_duplicate_keys", "K3", lambda e: keyed.duplicates(e.raw("orders"), "o_custkey"),
          "select o_custkey, count(*) as rows from orders group by 1 having count(*) > 1"),
    Query("a22_set_list", "A22 X7", lambda e: lists.set_list(e.opportunity, ["account_id"], "forecast"),
          oracle("select account_id, string_agg(distinct forecast, ', ' order by forecast) as forecast from opportunity group by 1", "opportunity")),
]
