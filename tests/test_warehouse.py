import datetime as dt

import pytest
from pyspark.sql import functions as F

from estate_helpers import AS_OF, one, rows
from tallyboard.functions.values import FISCAL_CALENDAR_END, FISCAL_QUARTERS
from tallyboard.sources import warehouse as w


def inst(inst_id, account="A", **more):
    base = {"inst_id": inst_id, "account_id": account, "backend": "p", "org_id": "1" + inst_id, "status": "New", "type": "Subscription", "licences": 10}
    return {**base, **more}


def test_owner_hierarchy(table):
    accounts = table("account", {"account_id": "A", "name": "Acme", "csm_id": "u1", "cse_id": "u3", "arr": 5.0}, {"account_id": "B", "name": "Beta"})
    users = table("user", {"user_id": "u1", "name": "Ann", "manager_id": "u2"}, {"user_id": "u2", "name": "Max"}, {"user_id": "u3", "name": "Eve", "email": "e@x"})
    got = w.account_info(accounts, table("installation", inst("1"), inst("2", "B"), inst("3", "gone")), users)
    assert rows(got, "inst_id", "account_name", "csm", "csm_manager", "cse", "cse_email") == [
        ("1", "Acme", "Ann", "Max", "Eve", "e@x"), ("2", "Beta", None, None, None, None)]


def test_licences_come_from_any_live_sibling(table):
    installations = table("installation", inst("1", licences=5), inst("2", licences=900, status="Cancelled"), inst("3", licences=70, status=None),
                          inst("4", licences=800, org_id=None), inst("5", licences=700, type="Perpetual"), inst("6", licences=600, backend="None"),
                          inst("7", "B", status="Cancelled"))
    accounts = table("account", {"account_id": "A", "parent_account": "P"})
    got = w.sibling_licences(installations, accounts)
    assert rows(got) == [(str(i), 70, "P") for i in range(1, 7)]


def test_products_reach_every_installation(table):
    subs = table("subscription", *[{"account_id": "A", "product_group": p} for p in ("b", "a", "b", "", None)])
    assert rows(w.products(subs, table("installation", inst("1"), inst("2")))) == [("1", "a, b"), ("2", "a, b")]


def opp(id, **more):
    return {"opp_id": id, "account_id": "A", "amount": 10.0, "forecast": "Commit", "close_date": dt.date(2024, 2, 1),
            "type": "Renewal", "product_family": "x CBD", **more}


def test_renewals(table):
    opps = table("opportunity", opp("1"), opp("2", forecast="Best", close_date=dt.date(2024, 5, 1), product_family="Endpoint"),
                 opp("3", forecast=None, product_family="Workload"), opp("4", close_date=dt.date(2024, 1, 31)), opp("5", type="New"),
                 opp("6", product_family="cbd"), opp("7", product_family=None))
    got = w.renewals(opps, table("installation", inst("1"), inst("2"), inst("3", "B")), AS_OF)
    assert rows(got, "inst_id", "acv", "opp_ct", "forecast", "renewal_date", "renewal_quar") == [
        (i, 30.0, 3, "Best,Commit", dt.date(2024, 2, 1), "2025 Q1") for i in ("1", "2")]


@pytest.mark.parametrize("n", [3, 10_001])
def test_forecasts_have_one_shape_at_every_size(table, n):
    opps = table("opportunity", *[opp(str(i), forecast="Best" if i % 3 else "Commit") for i in range(n)])
    long = rows(w.account_forecasts(opps, AS_OF), "account_id", "forecast", "n")
    assert sum(r[2] for r in long) == n and [r[1] for r in long] == ["Best", "Commit"]
    got = one(w.renewals(opps, table("installation", inst("1")), AS_OF), inst_id="1")
    assert (got["opp_ct"], got["forecast"]) == (n, "Best,Commit")


@pytest.mark.parametrize("day, want", [
    ("2020-01-31", "Unknown"), ("2020-02-01", "2021 Q1"), ("2020-04-30", "2021 Q1"), ("2020-05-01", "2021 Q2"),
    ("2022-07-29", "2023 Q3"), ("2026-01-22", "2026 Q4"), ("2026-01-23", "Unknown"), (None, "Unknown")])
def test_fiscal_quarter_edges(spark, day, want):
    df = spark.createDataFrame([(day,)], "d string").select(w.fiscal_quarter(F.col("d").cast("date")))
    assert df.first()[0] == want


def test_fiscal_calendar_is_in_order():
    days = [d for _, d in FISCAL_QUARTERS] + [FISCAL_CALENDAR_END]
    assert days == sorted(days) and len(FISCAL_QUARTERS) == 24


def test_case_windows(table):
    case = lambda created, status, group="ours": {"account_id": "A", "product_group": group, "created": created, "status": status}
    cases = table("case", case("2024-01-30T00:00:00.000Z", "Open"), case("2024-01-01T00:00:00.000Z", "Closed"), case("2024-01-01T00:00:01Z", "Closed", "other"),
                  case("2023-11-10T00:00:00Z", "Closed"), case("2020-01-01T00:00:00Z", "Open", None),
                  {"account_id": "B", "created": "2020-01-01T00:00:00Z", "status": "Closed"})
    got = w.case_counts(cases, table("installation", inst("1"), inst("2", "B")), AS_OF, ["ours"])
    names = ["total_cases_30d", "cbc_cases_30d", "total_cases_90d", "cbc_cases_90d", "open_cases", "open_cbc_cases"]
    assert rows(got, "inst_id", *names) == [("1", 2, 1, 4, 3, 2, 1)]


def test_cta_status(table):
    cta = lambda account, day, status, reason="Product Usage Analytics": {
        "account_id": account, "closed_date": day and dt.date(2024, 1, day), "status": status, "reason": reason}
    ctas = table("cta", cta("A", 3, "Closed Success"), cta("A", None, "New"), cta("A", 9, "Closed Invalid"), cta("A", 5, "Closed Success", "Tech Assessment"),
                 cta("B", 4, "Closed Success"), cta("B", 4, "Closed Success", "Other"))
    got = w.cta_status(ctas, table("installation", inst("1"), inst("2", "B"), inst("3", "C")))
    assert rows(got) == [("1", dt.date(2024, 1, 3), "Open", dt.date(2024, 1, 5), None), ("2", dt.date(2024, 1, 4), "Closed", None, None), ("3", None, None, None, None)]


def test_consumption_from_the_latest_snapshot(table):
    lic = lambda key, day, n, avg: {"prodkey": key, "calendarid": day, "deployed_last_day": n, "month_average": avg}
    licences = table("deployed_licence", lic("p|11", 20240101, 999, 9.0), lic("p|11", 20240131, 5, 2.5), lic("p|11", 20240131, 7, 1.0), lic("q|11", 20240131, 1, 1.0))
    got = w.latest_consumption(licences, table("installation", inst("1"), inst("2"), inst("3", org_id=None)))
    assert rows(got) == [("1", 7, 3.0)]


def test_activity_of_the_last_year(table):
    timeline = table("activity_timeline", {"account_id": "A", "activity_date": dt.date(2023, 2, 1), "type_name": "CSE: Activity"},
                     {"account_id": "A", "activity_date": dt.date(2023, 1, 31), "type_name": "CSE: Activity"},
                     {"account_id": "A", "activity_date": dt.date(2024, 1, 1), "type_name": "Other"},
                     {"account_id": "?", "activity_date": dt.date(2024, 1, 1), "type_name": "CSE: Activity"})
    accounts = table("account", {"account_id": "A", "name": "Acme"})
    got = w.activity(timeline, accounts, AS_OF)
    assert rows(got) == [("Acme", dt.date(2023, 2, 1)), (None, dt.date(2024, 1, 1))]
    named = table("inst_id string, account_name string", {"inst_id": "1", "account_name": "ACME"}, {"inst_id": "2"})
    assert rows(w.with_last_activity(named, got), "inst_id", "last_cse_timeline") == [("1", dt.date(2023, 2, 1)), ("2", None)]


def test_sf_data_has_one_row_per_roster_installation(table):
    tables = {t: table(t) for t in ("account", "user", "subscription", "opportunity", "case", "cta", "deployed_licence", "activity_timeline")}
    tables["installation"] = table("installation", inst("1"), inst("2", "B"), inst("3", org_id=None))
    got = w.build_sf_data(w.roster(tables["installation"]), tables, AS_OF, [])
    assert rows(got, "inst_id", "account_name", "licenses_purchased") == [("1", None, 10), ("2", None, 10)]
    assert len(got.columns) == 38


def test_stopped_case_feed_gives_zeros_for_30_days_only(table):
    tables = {t: table(t) for t in ("account", "user", "subscription", "opportunity", "cta")}
    tables["installation"] = table("installation", inst("1"), inst("2", "B"))
    case = {"account_id": "A", "product_group": "ours", "status": "Open"}
    counts = ["inst_id", "total_cases_30d", "cbc_cases_30d", "total_cases_90d", "open_cases"]

    def build(*created):
        tables["case"] = table("case", *[{**case, "created": c} for c in created])
        return rows(w.build_sf_data(w.roster(tables["installation"]), tables, AS_OF, ["ours"]), *counts)

    assert build("2023-12-01T00:00:00Z") == [("1", 0, 0, 1, 1), ("2", 0, 0, None, None)]
    assert build("2024-01-30T00:00:00Z") == [("1", 1, 1, 1, 1), ("2", None, None, None, None)]
