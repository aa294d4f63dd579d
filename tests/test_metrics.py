import datetime as dt

import pytest
from pyspark.sql import functions as F

from estate_helpers import AS_OF, ms, one, rows
from tallyboard.operators import audit as a
from tallyboard.operators import endpoints as ep
from tallyboard.operators import histograms as h
from tallyboard.operators import lookups
from tallyboard.operators.series import activity_series


def event(text, *when, inst="1"):
    return {"inst_id": inst, "user": "u", "event_time": ms(*when) if when else None, "description": text}


def audit_of(table, *events):
    return one(a.audit_metrics(table("audit", *events), AS_OF), inst_id="1")


def test_logins_and_connectors(table):
    got = audit_of(table, event("Logged in successfully", 2024, 1, 30), event("LOGIN SUCCESSFUL", 2024, 1, 20), event("Connector 7 logged in successfully", 2024, 1, 29),
                   event("Logged in successfully", 2023, 6, 1), event("Log off", 2024, 1, 31))
    assert (got["last_30d_login_count"], got["last_30d_connector_count"], got["last_login"], got["days_since_login"]) == (2, 1, ms(2024, 1, 30), 1)


def test_recency_anchors_differ(table):
    """Logins count back from as_of, connector logins from the newest event."""
    got = audit_of(table, event("Logged in successfully", 2023, 12, 20), event("Connector 7 logged in successfully", 2023, 12, 1), event("x", 2023, 12, 30))
    assert got["last_30d_login_count"] is None and got["last_30d_connector_count"] == 1


def test_wall_clock_window_is_open_at_its_start(table):
    edge = dict(inst_id="1", description="Logged in successfully")
    assert audit_of(table, {**edge, "event_time": ms(2024, 1, 1, 12)})["last_30d_login_count"] is None
    assert audit_of(table, {**edge, "event_time": ms(2024, 1, 1, 12, 0, 1)})["last_30d_login_count"] == 1


def test_bypass_counts_devices(table):
    got = audit_of(table, event("BYPASS enabled for d1,d2,d3", 2024, 1, 30), event("bypass switched to ON d4", 2024, 1, 30), event("Bypass enabled (Policy Action)", 2024, 1, 30),
                   event("Bypass disabled d5", 2024, 1, 30), event("Bypass enabled for d6", 2023, 1, 1))
    assert (got["last_30d_bypass_count"], got["bypass_all"]) == (4, False)


def test_very_many_devices_are_not_everything(table):
    many = "Bypass enabled for " + "d," * 1_000_000 + "d"
    got = audit_of(table, event(many, 2024, 1, 30))
    assert (got["last_30d_bypass_count"], got["bypass_all"]) == (1_000_001, False)


def test_bypass_of_everything(table):
    events = table("audit", event("Bypass enabled for ALL", 2024, 1, 30), event("Bypass enabled for d1", 2024, 1, 30), event("x", 2024, 1, 30, inst="2"))
    got = a.audit_metrics(events, AS_OF)
    assert rows(got.select("inst_id", a.bypass_display())) == [("1", "All"), ("2", "0")]
    assert one(got, inst_id="1")["last_30d_bypass_count"] == 1


def test_last_of_kind_and_blank_times(table):
    got = audit_of(table, event("Created policy a", 2024, 1, 2), event("created POLICY b", 2024, 1, 3), event("Policy a was modified", 2024, 1, 4),
                   event("Added user x", 2024, 1, 5), event("Added user y"))
    assert [got[k] for k in ("last_created_policy", "last_modified_policy", "last_added_user")] == [ms(2024, 1, 3), ms(2024, 1, 4), ms(2024, 1, 5)]
    assert got["last_login"] is None and got["days_since_login"] is None


def ep_row(day, inst="1", status="REGISTERED", version="3.7.1.5", os="WINDOWS", kind="ENDPOINT", hour=0, **more):
    return {"inst_id": inst, "id": "d", "sensor_version": version, "os": os, "os_version": f"{os} 10", "status": status, "deployment_type": kind,
            "last_contact_time": dt.datetime(2024, 1, day, hour) if isinstance(day, int) else day, "fetch_status": "OK", **more}


LOOKUP = "version string, os string, dl_available boolean, support_level string"


@pytest.fixture
def lookup(table):
    return table(LOOKUP, {"version": "3.7.1.5", "os": "WINDOWS", "dl_available": True, "support_level": "ST"},
                 {"version": "3.7.1.5", "os": "MAC", "dl_available": False, "support_level": "EOL"},
                 {"version": "3.6.0.1", "os": "WINDOWS", "dl_available": False, "support_level": "EX"})


LICENCES = "inst_id string, licenses_purchased bigint"


def test_endpoint_metrics(table, lookup):
    endpoints = table("endpoints", ep_row(31, hour=9), ep_row(1, status="BYPASS", version="3.6.0.1"), ep_row(30, os="MAC", kind="WORKLOAD"), ep_row(25),
                      ep_row(31, status="DEREGISTERED"), ep_row(dt.datetime(2023, 12, 31, 23)))
    got = one(ep.endpoint_metrics(endpoints, table(LICENCES, {"inst_id": "1", "licenses_purchased": 6}), lookup), inst_id="1")
    assert (got["deployment"], got["deployment_perc"], got["workload_deployment"]) == (4, 66.67, 1)
    assert (got["last_24_contact"], got["last_7d_contact"]) == (1, 2)
    assert (got["bypass"], got["bypass_perc"]) == (1, 25.0)
    assert (got["sensor_standard_support"], got["standard_perc"], got["sensor_extended_support"], got["sensor_eol_support"]) == (2, 50.0, 1, 1)
    assert (got["sensor_download_unavailable"], got["download_unavailable_perc"]) == (2, 50.0)


def test_endpoint_windows_and_fetch_status(table, lookup):
    endpoints = table("endpoints", ep_row(31), ep_row(dt.datetime(2023, 6, 1), inst="stale"), {"inst_id": "none", "fetch_status": "NO_DEPLOYMENT"},
                      {"inst_id": "late", "fetch_status": "TIMEOUT"}, ep_row(31, inst="off", status="DEREGISTERED"))
    licences = table(LICENCES, {"inst_id": "none", "licenses_purchased": 5})
    got = ep.endpoint_metrics(endpoints, licences, lookup)
    assert rows(got, "inst_id", "deployment", "deployment_perc", "last_24_contact", "bypass_perc", "eol_perc") == [
        ("1", 1, 0.0, 1, 0.0, 0.0), ("late", None, None, None, None, None), ("none", 0, 0.0, 0, 0.0, None),
        ("off", 0, 0.0, 0, 0.0, None), ("stale", None, None, 0, None, None)]


def test_anchor_is_a_day_not_an_instant(table, lookup):
    """Newest contact 2024-01-31 18:00: midnight of 2024-01-01 is inside the 30 days."""
    endpoints = table("endpoints", ep_row(31, hour=18), ep_row(1, inst="2"), ep_row(dt.datetime(2023, 12, 31, 23, 59), inst="3"))
    got = ep.endpoint_metrics(endpoints, table(LICENCES), lookup)
    assert rows(got, "inst_id", "deployment") == [("1", 1), ("2", 1), ("3", None)]


def support(table, *rows_):
    return table("version_support", *[{"os": os, "version": v, "current_level": level} for os, v, level in rows_])


def test_sensor_lookup(table):
    endpoints = table("endpoints", *[ep_row(31, version=v, os=os) for v, os in (
        ("3.7.0.9", "WINDOWS"), ("3.7.5.1", "WINDOWS"), ("3.7", "WINDOWS"), ("9.9", "WINDOWS"), ("3.7.0.9", "LINUX"), ("3.7.3.1", "MAC"), ("3.7.2.1", "MAC"))],
        ep_row(31, version=""), {"inst_id": "x", "fetch_status": "TIMEOUT"})
    levels = support(table, ("tag_win", "3.7", "ST"), ("tag_win", "3.7.0", "EX"), ("tag_lin", "3.x", "ST"), ("tag_mac", "3.7", "EOL"), ("tag_mac", "3", None))
    kits = table("kits", {"os": "windows", "version": "3.7.0.9"}, {"os": "UBUNTU", "version": "3.7.0.9"}, {"os": "linux", "version": "9.9"})
    assert rows(lookups.sensor_lookup(endpoints, kits, levels)) == sorted([
        ("3.7.0.9", "WINDOWS", True, "EX"), ("3.7.5.1", "WINDOWS", False, "ST"), ("3.7", "WINDOWS", False, "EOL"), ("9.9", "WINDOWS", False, "EOL"),
        ("3.7.0.9", "LINUX", True, "ST"), ("3.7.3.1", "MAC", False, "ST"), ("3.7.2.1", "MAC", False, "EOL")])


def test_prefix_can_include_the_exact_version(table):
    versions = table("version string, os string", {"version": "3.7", "os": "WINDOWS"}, {"version": "3", "os": "WINDOWS"})
    lines = lookups.release_lines(support(table, ("tag_win", "3.7", "ST"), ("tag_win", "3.7.x", "EX")))
    assert rows(lookups.longest_prefix(versions, lines, include_exact=True), "version", "support_level") == [("3", "EOL"), ("3.7", "EX")]
    assert rows(lookups.longest_prefix(versions, lines), "version", "support_level") == [("3", "EOL"), ("3.7", "EOL")]


def test_integrations(table):
    names = lambda *rows_: table("inst_id string, name string", *[{"inst_id": i, "name": n} for i, n in rows_])
    got = lookups.integrations(lookups.connection_names(
        names(("1", "Splunk prod"), ("1", "to QRadar (Q-radar)"), ("2", "backup"), ("3", None)),
        names(("1", "splunk"), ("1", "Splunk prod"), ("4", "log and\nrhythm"), ("4", "rapid seven 7"))))
    assert rows(got) == [("1", "qradar, splunk"), ("2", ""), ("3", ""), ("4", "rapid7")]


def test_terms_agree_with_a_regex(spark):
    import re

    from tallyboard.functions.values import INTEGRATION_TERMS
    texts = ["insight to idr elastic", "idr insight", "zzscaler", "z\nscaler", "log rhythm log", "arc sight trust x wave", "qradar", "proof.point elk", "rapid 77"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.split("t", "\n").alias("lines"))
    for row in df.select("t", lookups.matched_terms("lines").alias("hits")).collect():
        assert row.hits == [x.replace(".*", "") for x in INTEGRATION_TERMS if re.search(x, row.t)], row.t


def test_sensor_version_labels(table, lookup):
    endpoints = table("endpoints", ep_row(31), ep_row(30), ep_row(31, os="MAC"), ep_row(31, version="1.0"), ep_row(31, version="2.0"), ep_row(31, status="DEREGISTERED"))
    got = h.sensor_versions(endpoints, lookup)
    assert rows(got) == [("1", "3.7.1.5 (mac) (Unavailable) (eol)", 1), ("1", "3.7.1.5 (windows) (st)", 2), ("1", "unknown", 2)]
    labels = ["3.7.1.5 (mac) (Unavailable) (eol)", "3.7.1.5 (windows) (st)", "unknown"]
    assert h.widen(got, labels, ["inst_id"]).columns == ["inst_id", *labels]


def test_deployment_summary(table, lookup):
    endpoints = table("endpoints", ep_row(31), ep_row(31, os="MAC"), ep_row(31, version="3.6.0.1"))
    assert rows(h.deployment_summary(endpoints, lookup)) == [
        ("1", "family", "3.6", 1), ("1", "family", "3.7", 2), ("1", "os", "mac", 1), ("1", "os", "windows", 2),
        ("1", "support", "eol", 1), ("1", "support", "ex", 1), ("1", "support", "st", 1)]


def test_trend_sets_and_shares(table, lookup):
    endpoints = table("endpoints", ep_row(31), ep_row(31, inst="2"), ep_row(31, inst="2", version="3.6.0.1"), ep_row(31, inst="lost"))
    roster = table("roster", {"inst_id": "1", "backend": "p"}, {"inst_id": "2", "backend": "q"})
    trend = h.deployment_trend(endpoints, roster, AS_OF)
    assert rows(trend, "backend", "version", "n") == [("all", "3.6.0.1", 1), ("all", "3.7.1.5", 3), ("p", "3.7.1.5", 1), ("q", "3.6.0.1", 1), ("q", "3.7.1.5", 1)]
    shares = h.share_of_total(trend, ["date", "backend"])
    assert rows(shares, "backend", "version", "perc") == [("all", "3.6.0.1", 25.0), ("all", "3.7.1.5", 75.0), ("p", "3.7.1.5", 100.0), ("q", "3.6.0.1", 50.0), ("q", "3.7.1.5", 50.0)]
    wide = h.trend_wide(trend, ["3.6.0.1", "3.7.1.5"])
    assert rows(wide.filter("backend = 'p'").select("unique_id", "`3.6.0.1`", "`3.7.1.5`")) == [("p2024-01-31", 0, 1)]


def test_status_tables_use_the_wall_clock(table, lookup):
    endpoints = table("endpoints", ep_row(31), ep_row(31, status="BYPASS"), ep_row(31, status="OTHER", os="MAC"), ep_row(31, version="1.0"),
                      ep_row(dt.datetime(2024, 1, 1, 12)), ep_row(31, av_vdf_version="8.1"))
    assert rows(h.version_status(endpoints, lookup, AS_OF), "version", "os", "bypass", "active") == [("3.7.1.5", "MAC", 0, 0), ("3.7.1.5", "WINDOWS", 1, 2)]
    assert rows(h.os_status(endpoints, lookup, AS_OF)) == [("1", "MAC 10", 0, 0, 1), ("1", "WINDOWS 10", 1, 2, 3)]
    assert rows(h.os_support(endpoints, lookup, AS_OF)) == [("1", "MAC", 0, 0, 1, 1), ("1", "WINDOWS", 3, 0, 0, 4)]
    assert rows(h.signature_versions(endpoints, AS_OF)) == [("1", "8.1", 1)]


def test_zero_columns_and_column_order(table):
    wide = table("inst_id string, `3.7` bigint, `mac` bigint, `st` bigint", {"inst_id": "1", "3.7": 0, "mac": 2, "st": 0}, {"inst_id": "2", "3.7": 1, "mac": 0, "st": 0})
    assert h.zero_columns(wide, ["inst_id"]).columns == ["inst_id", "3.7", "mac"]
    assert h.ordered_columns(["3.7", "arr", "st", "mac", "3.6", "csm", "extra"]) == ["csm", "arr", "mac", "st", "3.6", "3.7"]


def test_archive_pivot(table):
    row = lambda day, os, n: {"inst_id": "1", "date": dt.date(2024, 1, day), "os": os, "standard": n, "extended": 0, "eol": 1}
    archive = table("inst_id string, date date, os string, standard bigint, extended bigint, eol bigint", row(1, "MAC", 5), row(1, "WINDOWS", 6), row(2, "MAC", 7))
    got = h.archive_pivot(archive, ["MAC", "WINDOWS"])
    assert rows(got, "date", "MAC_st", "MAC_eol", "WINDOWS_st", "WINDOWS_eol") == [(dt.date(2024, 1, 1), 5, 1, 6, 1), (dt.date(2024, 1, 2), 7, 1, 0, 0)]


@pytest.mark.parametrize("start, buckets, first", [
    (dt.datetime(2023, 12, 2, 12), 62, "2023-12-02"), (dt.datetime(2023, 12, 1, 12), 4 - 1, "2023-12"), (dt.datetime(2023, 12, 1, 13), 62, "2023-12-01")])
def test_series_buckets_at_61_days(table, start, buckets, first):
    audit = table("audit", event("x", *start.timetuple()[:5]))
    got = activity_series(audit, table("roster", {"inst_id": "1"}), AS_OF)
    assert (got.count(), got.agg(F.min("bucket")).first()[0]) == (buckets, first)


def test_series_counts_and_empty_history(table):
    audit = table("audit", event("Logged in successfully", 2024, 1, 29), event("Connector 5 logged in successfully", 2024, 1, 29), event("Bypass enabled for all", 2024, 1, 30, 23, 59))
    got = activity_series(audit, table("roster", {"inst_id": "1"}, {"inst_id": "2"}), AS_OF)
    assert rows(got.filter("inst_id = '1'")) == [("1", "2024-01-29", 1, 0, "No", 1), ("1", "2024-01-30", 0, 1, "Yes", 0), ("1", "2024-01-31", 0, 0, "No", 0), ("1", "2024-02-01", 0, 0, "No", 0)]
    empty = rows(got.filter("inst_id = '2'"), "bucket", "logins", "all_in_bypass")
    assert len(empty) == 9 and empty[0] == ("2024-01-24", 0, "No") and empty[-1][0] == "2024-02-01"
