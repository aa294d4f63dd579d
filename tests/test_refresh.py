"""A run end to end over landed files, twice on one day and once on the next."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from estate_helpers import AS_OF, one, rows
from tallyboard.plans import marts, refresh
from tallyboard.schemas import WAREHOUSE

DAY = dt.timedelta(days=1)


def land(path, feed, *replies):
    folder = path / feed
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "0.json").write_text("\n".join(json.dumps(r) for r in replies))


def at(days_ago):
    return int((AS_OF.replace(tzinfo=dt.timezone.utc) - days_ago * DAY).timestamp() * 1000)


def reply(inst, body, **more):
    return {"inst_id": inst, "status": 200, "body": body, **more}


def devices(inst, n, status="REGISTERED", version="3.8.0.1"):
    stamp = (AS_OF - DAY / 2).isoformat() + "Z"
    return reply(inst, {"num_found": n, "results": [
        {"id": f"{inst}-{i}", "sensor_version": version, "deployment_type": "ENDPOINT", "os_version": "Windows 10", "status": status,
         "last_contact_time": stamp, "os": "WINDOWS", "av_vdf_version": "8.1"} for i in range(n)]}, page=0)


def log(inst, text, days_ago):
    return reply(inst, {"entries": [{"loginName": "u", "eventTime": at(days_ago), "description": text}]}, search="s")


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    path = tmp_path_factory.mktemp("landed")
    land(path, "orgs", *[reply(i, {"organization": {"orgKey": f"K{i}"}}) for i in ("1", "2", "3")])
    land(path, "audit", log("1", "Logged in successfully", 1), log("1", "<b>Bypass</b> enabled for a,b", 2), log("2", "Logged in successfully", 20),
         log("1", "Logged in successfully", 1), log("3", "Created policy x", 5))
    land(path, "endpoints", devices("1", 40), devices("2", 30, "BYPASS", "3.5.0.1"), {"inst_id": "3", "page": 0})
    facet = lambda n: {"results": [{"field": "workflow", "values": [{"id": "OPEN", "total": n}]}]}
    land(path, "alerts", reply("1", facet(20)), reply("2", facet(12000)), {"inst_id": "3"})
    land(path, "kits", {"backend": "east", "status": 200, "body": {"publishedKits": {"WINDOWS": {"3.8.0.1": [{"hash": "h"}]}}}})
    land(path, "connectors", reply("1", {"entries": [{"connectorType": "SIM", "name": "Splunk"}]}))
    land(path, "forwarders", reply("1", [{"id": "f", "name": "elastic"}]))
    land(path, "dashboards", reply("1", {"message": "success", "threatSummary": {"ATTACKS_STOPPED": {}}}))
    land(path, "policies", {"prod": "east", "status": 200, "body": {"list": [{"orgId": "10", "id": "7", "name": "n"}]}})
    land(path, "policy", {"prod": "east", "status": 200, "body": {"orgId": "10", "id": "7", "name": "n", "policy": {"rules": []}}})
    land(path, "pages", {"page_id": 1, "tag": "tag_win", "html": "<tbody><tr><td>3.8</td><td>Jan 2023</td><td></td><td></td></tr></tbody>"})
    return str(path)


def crm(table):
    inst = lambda i, account: {"inst_id": i, "account_id": account, "backend": "east", "org_id": i + "0", "status": "New", "type": "Subscription", "licences": 100}
    w = {t: table(t) for t in WAREHOUSE}
    w["installation"] = table("installation", inst("1", "A"), inst("2", "B"), inst("3", "B"))
    w["account"] = table("account", {"account_id": "A", "name": "Acme", "csm_id": "u1", "cse_id": "u2"}, {"account_id": "B", "name": "Beta", "csm_id": "u1"})
    w["user"] = table("user", {"user_id": "u1", "name": "Ann"}, {"user_id": "u2", "name": "Eve"})
    return w


@pytest.fixture(scope="module")
def job(spark, table, landing, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    first = refresh.Refresh(spark, out, AS_OF, ["g"])
    for _ in range(2):
        refresh.run(first, refresh.open_feeds(spark, landing), crm(table))
    return first


def test_master_and_scores(job):
    master = job.load("master")
    assert rows(master, "inst_id") == [("1",), ("2",), ("3",)]
    a, b, late = (one(master, inst_id=i) for i in "123")
    assert (a["deployment"], a["deployment_perc"], a["integrations"], a["last_30d_bypass_count"]) == (40, 40.0, "elastic, splunk", 2)
    assert a["violations_triggered"] == "Deployment < 50%, Deployment < 75%" and (a["count_of_violations"], a["cua_brag"]) == (3, "Green")
    assert (b["bypass"], b["eol_perc"], b["cua_brag"], b["brag_decrease"]) == (30, 100.0, "Red", "False")
    assert late["deployment"] is None and late["cua_brag"] == "Green"


def test_accounts(job):
    accounts = job.load("account_master")
    beta = one(accounts, account_name="Beta")
    assert (beta["members"], beta["deployment"], beta["brag_decrease"]) == (2, 30, "NA")
    assert rows(job.load("account_members"), "account_name", "inst_id") == [("Acme", "1"), ("Beta", "2"), ("Beta", "3")]
    assert job.load("account_forecasts").columns == ["account_id", "forecast", "n", "amount", "first_date"]


def test_same_day_rerun_is_idempotent(job):
    for name, n in (("master_archive", 3), ("account_master_archive", 2), ("deployment_archive", 2), ("deployment_trend", 4)):
        assert job.archive(name).count() == n, name


def test_marts(spark, job):
    assert rows(marts.read_owner(spark, job.path("mart_master"), "csm", "Ann"), "inst_id", "last_login") == [
        ("1", (AS_OF - DAY).date()), ("2", (AS_OF - 20 * DAY).date()), ("3", None)]
    assert rows(marts.read_mart(spark, job.path("mart_cse_master")), "cse_key", "inst_id") == [("eve", "1")]
    assert marts.read_mart(spark, job.path("mart_cse_reds")).count() == 0
    assert rows(job.load("mart_sensor_versions"), "inst_id", "label", "n") == [("1", "3.8.0.1 (windows) (st)", 40), ("2", "3.5.0.1 (windows) (Unavailable) (eol)", 30)]
    assert rows(job.load("mart_trend_percent").filter("section = 'all'"), "version", "perc") == [("3.5.0.1", 42.86), ("3.8.0.1", 57.14)]
    assert ("2", "family", "3.5", 30) in rows(job.load("mart_deployment"), "inst_id", "kind", "key", "n")
    assert rows(job.load("mart_account_consumption"), "inst_id", "month", "deployment") == [("1", "2024-01", 40), ("2", "2024-01", 30), ("3", "2024-01", None)]
    assert rows(job.load("mart_positions"), "csm", "inst_id", "position") == [("Ann", "1", 0), ("Ann", "2", 1), ("Ann", "3", 2)]
    assert job.load("mart_columns").count() == len(marts.MASTER_FIELDS)
    bi = spark.read.option("header", True).csv(job.path("bi_export"))
    assert len(bi.columns) == 17 and rows(bi, "account_name", "inst_id") == [("Acme", "1"), ("Beta", "2"), ("Beta", "3")]
    for name in ("version_status", "os_status", "os_support", "signatures", "activity", "master_trend", "deployment_archive"):
        assert job.load(f"mart_account_{name}").count() > 0, name


def test_next_day_sees_the_swing(spark, table, job, tmp_path):
    """Half of one installation's devices are gone a day later."""
    for feed in ("orgs", "audit", "alerts", "kits", "connectors", "forwarders", "dashboards", "policies", "policy", "pages"):
        land(tmp_path, feed)
    land(tmp_path, "endpoints", devices("1", 20), devices("2", 30, "BYPASS", "3.5.0.1"))
    nextday = refresh.Refresh(spark, job.out, AS_OF + DAY, ["g"])
    refresh.run(nextday, refresh.open_feeds(spark, str(tmp_path)), crm(table))
    got = job.load("master")
    assert ">10% decrease in deployment counts" in one(got, inst_id="1")["violations_triggered"]
    assert one(got, inst_id="1")["brag_decrease"] == "True"
    assert "decrease" not in one(got, inst_id="2")["violations_triggered"]
    accounts = job.load("account_master")
    assert ">10% decrease" in one(accounts, account_name="Acme")["violations_triggered"]
    assert job.archive("master_archive").count() == 6


def test_gaps_are_followed(spark, table, landing, tmp_path):
    """An installation that is off the roster for a day is compared with its own newest snapshot, kept as a state a day."""
    out = str(tmp_path / "out")
    empty = tmp_path / "landed"
    for feed in ("orgs", "audit", "alerts", "kits", "connectors", "forwarders", "dashboards", "policies", "policy", "pages"):
        land(empty, feed)
    land(empty, "endpoints", devices("1", 20), devices("2", 30, "BYPASS", "3.5.0.1"))
    whole, absent = crm(table), crm(table)
    absent["installation"] = absent["installation"].filter("inst_id <> '1'")
    run = lambda day, w, feeds: refresh.run(refresh.Refresh(spark, out, AS_OF + day * DAY, ["g"], True), refresh.open_feeds(spark, feeds), w)
    run(0, whole, landing)
    run(1, absent, str(empty))
    last = refresh.Refresh(spark, out, AS_OF + 2 * DAY, ["g"], True)
    run(2, whole, str(empty))
    got = one(last.load("master"), inst_id="1")
    assert ">10% decrease in deployment counts" in got["violations_triggered"] and got["brag_decrease"] == "True"
    states = last.archive("master_states")
    day = lambda n: (AS_OF + n * DAY).date()
    assert rows(states, "date", "inst_id", "seen", "deployment") == sorted(
        [(day(0), "1", day(0), 40), (day(0), "2", day(0), 30), (day(0), "3", day(0), None), (day(1), "1", day(0), 40), (day(1), "2", day(1), 30),
         (day(1), "3", day(1), None), (day(2), "1", day(2), 20), (day(2), "2", day(2), 30), (day(2), "3", day(2), None)], key=lambda r: (str(r[0]), r[1]))


TABLES = ["audit", "endpoints", "alerts", "connectors", "dashboards", "forwarders", "kits", "policy_ids", "rules", "customers"]


def test_two_overlapping_runs_are_one(spark, table, landing, tmp_path):
    """Files that come a day later and repeat what is there change nothing but what is new; each file is flattened once."""
    import shutil

    source = str(tmp_path / "landed")
    shutil.copytree(landing, source)
    fresh = refresh.Refresh(spark, str(tmp_path / "out"), AS_OF, ["g"])
    refresh.run_landed(fresh, source, crm(table))
    whole = refresh.raw_tables(refresh.open_feeds(spark, landing), refresh.warehouse.roster(crm(table)["installation"]), AS_OF)
    for name in TABLES:
        assert rows(fresh.load(name)) == rows(whole[name]), name
    for feed in os.listdir(source):
        if os.path.exists(f"{source}/{feed}/0.json"):
            shutil.copy(f"{source}/{feed}/0.json", f"{source}/{feed}/again.json")
    once = {name: rows(fresh.load(name)) for name in TABLES}
    refresh.run_landed(fresh, source, crm(table))
    for name in TABLES:
        assert rows(fresh.load(name)) == once[name], name
    shutil.copy(f"{source}/dashboards/0.json", f"{source}/dashboards/third.json")
    (tmp_path / "landed" / "alerts" / "new.json").write_text(json.dumps(reply("3", {"results": [{"field": "workflow", "values": [{"id": "OPEN", "total": 5}]}]})))
    (tmp_path / "landed" / "endpoints" / "new.json").write_text(json.dumps(devices("3", 2)))
    refresh.run_landed(fresh, source, crm(table))
    assert one(fresh.load("alerts"), inst_id="3")["open"] == 5
    assert rows(fresh.load("endpoints").filter("inst_id = '3'"), "id", "fetch_status") == [("3-0", "OK"), ("3-1", "OK")]
    assert rows(fresh.load("dashboards")) == once["dashboards"]


def test_doubled_feeds_count_once(spark, table, landing):
    """Every feed landed twice gives the tables of one landing, without a ledger too."""
    feeds = {name: df.unionByName(df) for name, df in refresh.open_feeds(spark, landing).items()}
    roster = refresh.warehouse.roster(crm(table)["installation"])
    single = refresh.raw_tables(refresh.open_feeds(spark, landing), roster, AS_OF)
    double = refresh.raw_tables(feeds, roster, AS_OF)
    for name in single:
        if name != "version_support":
            assert rows(double[name]) == rows(single[name]), name


def test_a_run_scans_the_devices_once(spark, table, landing, tmp_path, monkeypatch):
    """Of all that a run writes, the table of counts alone is made from the devices."""
    from pyspark.sql.classic.dataframe import DataFrame

    written, write = [], DataFrame.write
    monkeypatch.setattr(DataFrame, "write", property(lambda df: (written.append(df.inputFiles()), write.fget(df))[1]))
    once = refresh.Refresh(spark, str(tmp_path / "out"), AS_OF, ["g"])
    refresh.run(once, refresh.open_feeds(spark, landing), crm(table))
    assert len(written) > 30 and sum(any("/out/endpoints/" in f for f in files) for files in written) == 1
    anchors = {r["table"]: r["newest"] for r in spark.read.parquet(once.path("anchors/endpoints"), once.path("anchors/audit")).collect()}
    assert anchors["endpoints"].startswith("2024-01-31 00:00") and int(anchors["audit"]) == at(1)
    assert once.load("devices").agg(F.sum("n")).first()[0] == once.load("endpoints").count()


def test_pages_that_never_came_leave_a_mark(spark, table, landing):
    feeds = refresh.open_feeds(spark, landing)
    short = spark.createDataFrame([json.dumps({**devices("2", 1), "inst_id": "2", "body": {"num_found": 25_000, "results": devices("2", 1)["body"]["results"]}})], "string")
    feeds["endpoints"] = short.select(F.from_json("value", feeds["endpoints"].schema).alias("r")).select("r.*")
    got = refresh.raw_tables(feeds, refresh.warehouse.roster(crm(table)["installation"]), AS_OF)["endpoints"]
    assert rows(got, "inst_id", "id", "fetch_status") == [("2", "2-0", "OK"), ("2", None, "PARTIAL")]


def test_column_metadata():
    meta = {c: (label, fmt) for c, label, fmt in marts.column_metadata()}
    assert meta["eol_perc"] == ("EOL %", "percent") and meta["arr"] == ("ARR", "money")
    assert meta["days_to_50perc"] == ("Days To 50%", "plain") and meta["csm_comments"][0] == "CSM Comments"
    assert meta["last_7d_contact"][0] == "Last 7d contact" and meta["allow_and_log_alerts"][0] == "Allow and Log Alerts" and len(meta) == 71 and meta["count_of_violations"][0] == "CUA Score"
