"""Plan shapes: what reaches the scan, and which joins are never chosen."""

import datetime as dt
import os

import pytest

from estate_helpers import AS_OF
from tallyboard.operators import audit as a
from tallyboard.operators import endpoints as ep
from tallyboard.operators import histograms as h
from tallyboard.operators import lookups
from tallyboard.operators.rollup import account_rollup
from tallyboard.operators.series import activity_series
from tallyboard.plans import marts
from tallyboard.sources import warehouse


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def endpoints(spark, table, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "endpoints")
    table("endpoints", {"inst_id": "1", "sensor_version": "3.7", "os": "WINDOWS", "os_version": "w", "status": "REGISTERED", "fetch_status": "OK",
                        "last_contact_time": dt.datetime(2024, 1, 30)}).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def audit(spark, table, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "audit")
    table("audit", {"inst_id": "1", "user": "u", "event_time": 1, "description": "x"}).write.parquet(path)
    return spark.read.parquet(path)


def test_filters_and_columns_reach_the_scan(endpoints):
    text = plan(h.os_versions(endpoints))
    assert "In(status, [BYPASS,REGISTERED])" in text.replace("REGISTERED,BYPASS", "BYPASS,REGISTERED")
    assert "EqualTo(fetch_status,OK)" in text
    assert "ReadSchema: struct<inst_id:string,os_version:string,status:string,last_contact_time:timestamp_ntz,fetch_status:string>" in text


def test_wall_clock_window_reaches_the_scan(endpoints):
    assert "GreaterThan(last_contact_time,2024-01-01T12:00)" in plan(h.signature_versions(endpoints, AS_OF))


def test_audit_metrics_shuffle_once(audit):
    text = plan(a.audit_metrics(audit, AS_OF))
    assert text.count("Exchange hashpartitioning") == 1 and "user:string" not in text


def test_anchor_is_scanned_once_for_all_windows(endpoints):
    text = plan(ep.endpoint_counts(endpoints))
    assert text.count("Exchange SinglePartition") == 1 and text.count("Exchange hashpartitioning") == 1


def test_no_pairing_of_everything(table, endpoints, audit):
    lookup = lookups.sensor_lookup(endpoints, table("kits"), table("version_support"))
    names = table("inst_id string, name string")
    warehouse_tables = {t: table(t) for t in ("account", "installation", "user", "subscription", "opportunity", "case", "cta")}
    frames = [
        lookup, ep.endpoint_metrics(endpoints, table("inst_id string, licenses_purchased bigint"), lookup), activity_series(audit, table("roster"), AS_OF),
        lookups.integrations(names), h.version_status(endpoints, lookup, AS_OF),
        warehouse.build_sf_data(table("roster"), warehouse_tables, AS_OF, []), h.deployment_trend(endpoints, table("roster"), AS_OF)]
    for df in frames:
        text = plan(df)
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_owner_mart_read_is_pruned(spark, table, tmp_path):
    path = str(tmp_path / "mart")
    marts.write_by_owner(table("csm string, account_name string", {"csm": "1", "account_name": "b"}, {"csm": "2", "account_name": "a"}), "csm", path)
    got = marts.read_owner(spark, path, "csm", "1")
    assert [tuple(r) for r in got.select("csm", "account_name").collect()] == [("1", "b")]
    assert "PartitionFilters: [isnotnull(csm" in plan(got)


DATA = "/root/testdata/sf0.001"
QUICK = ["s02_org_keys", "s04_endpoint_flatten", "s05_alert_facets", "s07_connectors", "s12_html_rows", "j03_renewals", "j04_case_counts", "a01_audit_metrics",
         "a05_endpoint_metrics", "a14_deployment_trend", "a23_integrations_other_terms", "a27_monthly_series", "r01_scores_at_limits", "b03_band_decline",
         "k05_snapshot_rerun", "o03_positions"]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", QUICK)
def test_query_matches_its_oracle(spark, name):
    import duckdb

    import __spark_entry__ as entry
    from tools.check import TABLES, compare

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    assert compare(entry.queries()[name](spark, DATA).toArrow(), con.sql(entry.oracle_sql()[name]).to_arrow_table()) == []


def test_every_query_has_a_name_and_an_oracle():
    import __spark_entry__ as entry

    named = {q.name for q in entry.all_queries()}
    assert named <= set(entry.queries()) and named <= set(entry.oracle_sql()) and len(named) > 100
    assert callable(account_rollup)
