import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from estate_helpers import AS_OF, rows
from tallyboard.schemas import LANDED
from tallyboard.sources import landed, support, warehouse
from tallyboard.streaming.landing import land_new_files


@pytest.fixture
def feed(spark, tmp_path):
    """Land replies as JSON lines and read them back with the feed's schema."""

    def land(name, *replies):
        path = tmp_path / name
        path.mkdir(exist_ok=True)
        (path / f"{len(list(path.iterdir()))}.json").write_text("\n".join(json.dumps(r) for r in replies))
        return landed.read_feed(spark, name, str(path))

    return land


def device(**more):
    return {"id": "d", "sensor_version": "3.7.0.1", "status": "REGISTERED", "os": "WINDOWS", "sensor_out_of_date": True,
            "last_contact_time": "2024-01-30T10:00:00.000Z", **more}


def test_customers_keep_failed_lookups(table, feed):
    roster = table("roster", {"inst_id": "1", "backend": "p", "org_id": "10"}, {"inst_id": "2", "backend": "p", "org_id": "20"},
                   {"inst_id": "3", "backend": "p", "org_id": "30"})
    orgs = feed("orgs", {"inst_id": "1", "status": 200, "body": {"organization": {"orgKey": "K1"}}}, {"inst_id": "2", "status": 500, "body": None})
    got = landed.customers(roster, orgs)
    assert rows(got, "inst_id", "prod", "org_key") == [("1", "p", "K1"), ("2", "p", ""), ("3", "p", "")]
    assert rows(landed.with_org_key(got), "inst_id") == [("1",)]


def test_audit_tells_events_apart_by_whole_texts(feed):
    long = "<b>Bypass</b> " + "x" * 200
    entry = {"loginName": "u", "eventTime": 5, "description": long}
    other = {**entry, "description": long + " enabled for d1,d2"}
    replies = feed("audit", {"inst_id": "1", "search": "bypass", "status": 200, "body": {"entries": [entry, {**entry, "eventTime": 6}, other]}},
                   {"inst_id": "1", "search": "policy", "status": 200, "body": {"entries": [entry]}},
                   {"inst_id": "2", "search": "policy", "status": 200, "body": {"entries": []}}, {"inst_id": "3", "search": "policy"})
    whole = "Bypass " + "x" * 200
    assert rows(landed.audit(replies)) == [("1", "u", 5, whole), ("1", "u", 5, whole + " enabled for d1,d2"), ("1", "u", 6, whole)]
    assert rows(landed.audit(replies, max_chars=10), "description") == [("Bypass xxx",)] * 3


def test_audit_leaves_out_flagged_and_verbose(feed):
    entry = {"loginName": "u", "eventTime": 5, "description": "a"}
    replies = feed("audit", {"inst_id": "1", "search": "s", "status": 200, "body": {"entries": [
        entry, {**entry, "description": "b", "flagged": True}, {**entry, "description": "c", "verbose": True}, {**entry, "description": "d", "flagged": False, "verbose": False}]}})
    assert rows(landed.audit(replies), "description") == [("a",), ("d",)]


def test_endpoint_fetch_status(feed):
    replies = feed("endpoints",
                   {"inst_id": "ok", "page": 0, "status": 200, "body": {"num_found": 20000, "results": [device(id="a"), device(id="b")]}},
                   {"inst_id": "ok", "page": 1, "status": 502},
                   {"inst_id": "none", "page": 0, "status": 200, "body": {"num_found": 0, "results": []}},
                   {"inst_id": "late", "page": 0}, {"inst_id": "wrong", "page": 0, "status": 200, "body": {}})
    got = landed.endpoints(replies)
    assert rows(got, "inst_id", "id", "fetch_status") == [
        ("late", None, "TIMEOUT"), ("none", None, "NO_DEPLOYMENT"), ("ok", "a", "OK"), ("ok", "b", "OK"),
        ("ok", None, "PARTIAL"), ("wrong", None, "WRONG_BACKEND")]
    assert got.filter("id = 'a'").first()["last_contact_time"] == dt.datetime(2024, 1, 30, 10)


def test_contact_window_keeps_status_rows(feed):
    replies = feed("endpoints", {"inst_id": "1", "page": 0, "status": 200, "body": {"num_found": 2, "results": [
        device(id="new"), device(id="old", last_contact_time="2023-12-31T11:59:59Z")]}}, {"inst_id": "2", "page": 0})
    got = landed.in_contact(landed.endpoints(replies), AS_OF)
    assert rows(got, "inst_id", "id") == [("1", "new"), ("2", None)]


def test_alert_counters_default_to_zero(feed):
    facet = lambda f, **v: {"field": f, "values": [{"id": k, "total": n} for k, n in v.items()]}
    replies = feed("alerts", {"inst_id": "1", "status": 200, "body": {"results": [
        facet("workflow", OPEN=3, DISMISSED=4, OTHER=9), facet("run_state", RAN=5), facet("tag", OPEN=77)]}},
        {"inst_id": "2", "status": 200, "body": {"results": []}}, {"inst_id": "3"}, {"inst_id": "4", "status": 200, "body": None})
    got = landed.alerts(replies)
    assert rows(got, "inst_id", "open", "dismissed", "terminated", "ran", "not_ran", "fetch_status") == [
        ("1", 3, 4, 0, 5, 0, "OK"), ("2", 0, 0, 0, 0, 0, "OK"), ("3", None, None, None, None, None, "TIMEOUT"),
        ("4", None, None, None, None, None, "WRONG_BACKEND")]


def test_kits_take_the_first_build(feed):
    build = lambda h: {"hash": h, "createTime": 1, "status": "s"}
    replies = feed("kits", {"backend": "p", "status": 200, "body": {"publishedKits": {
        "WINDOWS": {"3.7": [build("a"), build("b")], "3.8": [build("c")]}, "MAC": {"1.0": []}}}})
    assert rows(landed.kits(replies), "os", "version", "hash") == [("MAC", "1.0", None), ("WINDOWS", "3.7", "a"), ("WINDOWS", "3.8", "c")]


def test_connector_last_event_by_type(feed):
    entry = lambda id, type, **more: {"connectorId": id, "connectorType": type, "name": id, **more}
    both = {"lastSimNotificationKey": {"eventTime": 11}, "lastAuditLogKey": {"eventTime": 22}}
    replies = feed("connectors", {"inst_id": "1", "status": 200, "body": {"entries": [
        entry("sim", "SIM", notificationState=both, stats={"lastReportedTime": 9}), entry("api", "API", notificationState=both),
        entry("custom", "CUSTOM", notificationState=both), entry("bare", "SIM", notificationState=None),
        entry("half", "SIM", notificationState={"lastSimNotificationKey": None})]}},
        {"inst_id": "2", "status": 200, "body": {"entries": []}}, {"inst_id": "3"})
    got = landed.connectors(replies)
    assert rows(got, "inst_id", "name", "last_event", "last_report", "fetch_status") == [
        ("1", "api", 22, None, "OK"), ("1", "bare", None, None, "OK"), ("1", "custom", None, None, "OK"),
        ("1", "half", None, None, "OK"), ("1", "sim", 11, 9, "OK"), ("2", None, None, None, "EMPTY"), ("3", None, None, None, "TIMEOUT")]


def test_forwarders_project_named_fields(feed):
    replies = feed("forwarders", {"inst_id": "1", "status": 200, "body": [
        {"id": "f", "name": "n", "enabled": True, "destination": "dropped", "create_time": "2024-01-01T00:00:00Z"}]},
        {"inst_id": "2", "status": 404}, {"inst_id": "3", "status": 200, "body": []})
    assert rows(landed.forwarders(replies), "inst_id", "id", "s3_prefix", "create_time", "fetch_status") == [
        ("1", "f", None, dt.datetime(2024, 1, 1), "OK"), ("2", None, None, None, "EMPTY")]


def test_dashboards_default_to_zero(feed):
    body = {"message": "success", "threatSummary": {"ATTACKS_STOPPED": {"UNKNOWN": {"count": 4, "percentage": 2.5}}}}
    got = landed.dashboards(feed("dashboards", {"inst_id": "1", "status": 200, "body": body}, {"inst_id": "2", "status": 200, "body": {"message": "no"}}))
    assert rows(got, "inst_id", "unknown_count", "unknown_perc", "unknown_perc_change", "pup_count") == [("1", 4, 2.5, 0.0, 0), ("2", None, None, None, None)]
    assert len(got.columns) == 17


def test_policies_and_rules_by_organisation(table, feed):
    customers = table("customers", {"inst_id": "1", "prod": "p", "org_id": "10"}, {"inst_id": "2", "prod": "q", "org_id": "10"})
    lists = feed("policies", {"prod": "q", "status": 200, "body": {"list": [{"orgId": 10, "id": 7, "name": "n", "priority": "HIGH", "numDevices": 3}]}},
                 {"prod": "p", "status": 200, "body": {"list": []}}, {"prod": "p", "status": 200, "body": {"message": "none"}})
    assert rows(landed.policy_ids(lists, customers)) == [("2", "10", "7", "n", "HIGH", 3)]
    rule = {"operation": "RUN", "action": "DENY", "application": {"type": "NAME", "value": "x.exe"}}
    policy = feed("policy", {"prod": "p", "status": 200, "body": {"orgId": 10, "id": 7, "name": "n", "policy": {"rules": [rule]}}})
    assert rows(landed.rules(policy, customers)) == [("1", "7", "n", "RUN", "DENY", "NAME", "x.exe")]


def test_new_keys_only(table):
    roster = table("roster", {"inst_id": "1"}, {"inst_id": "2"})
    assert rows(landed.new_keys_only(roster, table("audit", {"inst_id": "1"}, {"inst_id": "1"})), "inst_id") == [("2",)]


def test_version_support_levels(table):
    html = """<tbody><tr><td>3.9.x</td><td>May 2024</td><td></td><td></td></tr><tr><td>3.8</td><td>Jan 22</td><td>Jan 2023</td><td>June 2024</td></tr>
      <tr><td>3.7</td><td>Jan 2021</td><td>Jan 2022</td><td>Jan 2023</td></tr><tr><td>3.6</td><td>Jan 2023</td><td></td><td></td></tr>
      <tr><td>3.5</td><td></td><td></td><td></td></tr></tbody>"""
    pages = table(LANDED["pages"], {"page_id": 1, "tag": "tag_win", "html": html})
    got = support.version_support(pages, AS_OF)
    assert rows(got, "version", "current_level") == [("3.5", None), ("3.6", "ST"), ("3.7", "EOL"), ("3.8", "EX"), ("3.9.x", "Unreleased")]
    assert got.filter("version = '3.8'").first()["standard"] == dt.date(2022, 1, 1)


def test_activity_files(spark, tmp_path):
    (tmp_path / "Distinct1.csv").write_text("acme,,,,,2024-01-05\nacme,,,,,whenever\n")
    (tmp_path / "Distinct2.csv").write_text("beta,,,,,\"Jan 7, 2024\"\n")
    (tmp_path / "other.csv").write_text("no,,,,,2024-01-01\n")
    got = warehouse.activity_files(spark, f"{tmp_path}/Distinct*.csv")
    assert rows(got) == [("acme", dt.date(2024, 1, 5)), ("beta", dt.date(2024, 1, 7))]


def test_read_table_by_path_and_name(spark, tmp_path, table):
    table("roster", {"inst_id": "1"}).write.parquet(f"{tmp_path}/r")
    assert rows(warehouse.read_table(spark, f"{tmp_path}/r", "parquet"), "inst_id") == [("1",)]
    table("roster", {"inst_id": "9"}).createOrReplaceTempView("roster_view")
    assert rows(warehouse.read_table(spark, "roster_view"), "inst_id") == [("9",)]


def test_streaming_landing_reads_each_file_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / d) for d in ("in", "out", "ckpt"))
    (tmp_path / "in").mkdir()

    def reply(inst):
        return json.dumps({"inst_id": inst, "status": 200, "body": {"entries": [{"loginName": "u", "eventTime": 1, "description": "Added user x"}]}})

    for number, inst in enumerate(("1", "2")):
        (tmp_path / "in" / f"{number}.json").write_text(reply(inst))
        land_new_files(spark, "audit", source, target, checkpoint, landed.audit).awaitTermination()
    assert rows(spark.read.parquet(target), "inst_id") == [("1",), ("2",)]


def test_streaming_landing_of_new_installations_only(spark, tmp_path):
    """An installation that an earlier landing has brought is left as it is."""
    source, target, checkpoint = (str(tmp_path / d) for d in ("in", "out", "ckpt"))
    (tmp_path / "in").mkdir()
    for number, insts in enumerate((["1", "2"], ["2", "3"])):
        lines = [json.dumps({"inst_id": i, "status": 200, "body": {"entries": [{"loginName": "u", "eventTime": 1, "description": f"text {number}"}]}}) for i in insts]
        (tmp_path / "in" / f"{number}.json").write_text("\n".join(lines))
        land_new_files(spark, "audit", source, target, checkpoint, landed.audit, only_new=True).awaitTermination()
    assert rows(spark.read.parquet(target), "inst_id", "description") == [("1", "text 0"), ("2", "text 0"), ("3", "text 1")]


def page(inst, number, found, devices=1, status=200):
    return (inst, number, status, found, devices)


def page_frame(spark, *pages):
    data = [(i, n, st, {"num_found": found, "results": [{"id": f"{i}-{n}-{k}"} for k in range(d)]} if st == 200 else None) for i, n, st, found, d in pages]
    from tallyboard.schemas import LANDED
    return spark.createDataFrame([json.dumps({"inst_id": i, "page": n, "status": st, "body": b}) for i, n, st, b in data], "string").select(
        F.from_json("value", LANDED["endpoints"]).alias("r")).select("r.*")


def test_page_gaps(spark):
    """Middle, first and last pages that never came; a page landed twice, a total that shrank, one beyond the total, a failed page."""
    seen = page_frame(spark, page("whole", 0, 25), page("whole", 1, 25), page("whole", 2, 25), page("middle", 0, 45), page("middle", 3, 45), page("middle", 4, 45),
                      page("last", 0, 30), page("last", 0, 30), page("first", 2, 30), page("shrank", 0, 30), page("shrank", 1, 12), page("beyond", 0, 10), page("beyond", 4, 10),
                      page("failed", 0, 20), page("failed", 1, 20, status=504), page("none", 0, 0), page("dead", 0, 0, status=500))
    assert rows(landed.page_gaps(landed.pages(seen), 10)) == sorted([
        ("middle", 1, 2, 5), ("last", 1, 2, 3), ("first", 0, 1, 3), ("shrank", 2, 2, 3), ("failed", 1, 1, 2)])
    marked = landed.with_partial(landed.endpoints(seen), landed.page_gaps(landed.pages(seen), 10)).filter("fetch_status = 'PARTIAL'")
    assert {r["inst_id"] for r in marked.collect()} == {"middle", "last", "first", "shrank", "failed"}
