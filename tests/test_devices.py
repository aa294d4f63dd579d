"""Metrics and histograms from devices that were counted once are those of the devices."""

import datetime as dt
import random

import pytest

from estate_helpers import AS_OF, rows
from tallyboard.operators import devices as d
from tallyboard.operators import histograms as h
from tallyboard.operators.audit import audit_metrics
from tallyboard.operators.endpoints import endpoint_counts, endpoint_totals
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def estate(table):
    rng = random.Random(4)
    pick = lambda *values: rng.choice(values)
    many = [{"inst_id": pick("1", "2", "3"), "id": str(i), "sensor_version": pick("3.8.0.1", "3.9.0.2", "", None), "os": pick("WINDOWS", "MAC", None),
             "os_version": pick("Windows 10", "macOS 12", None), "status": pick("REGISTERED", "BYPASS", "Bypass", "DEREGISTERED", None),
             "deployment_type": pick("WORKLOAD", "ENDPOINT", None), "av_vdf_version": pick("8.1", "8.2", None), "fetch_status": "OK",
             "last_contact_time": pick(None, *[AS_OF - dt.timedelta(days=x, hours=rng.randint(0, 23)) for x in (0, 1, 2, 6, 7, 8, 29, 30, 31, 40)])} for i in range(400)]
    many += [{"inst_id": "4", "fetch_status": "NO_DEPLOYMENT"}, {"inst_id": "5", "fetch_status": "TIMEOUT"}, {"inst_id": "1", "fetch_status": "PARTIAL"}]
    lookup = table("version string, os string, dl_available boolean, support_level string",
                   {"version": "3.8.0.1", "os": "WINDOWS", "dl_available": True, "support_level": "ST"}, {"version": "3.9.0.2", "os": "MAC", "dl_available": False, "support_level": "EOL"})
    return table("endpoints", *many), lookup, table("inst_id string, backend string", *[{"inst_id": i, "backend": "east" if i != "3" else None} for i in "1234"])


ROLLUPS = {
    "endpoint_counts": lambda e, lookup, roster: endpoint_counts(e), "endpoint_totals": lambda e, lookup, roster: endpoint_totals(e, lookup),
    "sensor_versions": lambda e, lookup, roster: h.sensor_versions(e, lookup), "os_versions": lambda e, lookup, roster: h.os_versions(e),
    "deployment_summary": lambda e, lookup, roster: h.deployment_summary(e, lookup), "deployment_archive": lambda e, lookup, roster: h.deployment_archive(e, lookup, AS_OF),
    "deployment_trend": lambda e, lookup, roster: h.deployment_trend(e, roster, AS_OF), "version_status": lambda e, lookup, roster: h.version_status(e, lookup, AS_OF),
    "os_status": lambda e, lookup, roster: h.os_status(e, lookup, AS_OF), "signatures": lambda e, lookup, roster: h.signature_versions(e, AS_OF),
}


@pytest.mark.parametrize("name", ROLLUPS)
def test_rollups_of_counts(estate, name):
    endpoints, lookup, roster = estate
    whole, counted = (ROLLUPS[name](some, lookup, roster) for some in (endpoints, d.device_counts(endpoints, AS_OF)))
    assert counted.schema == whole.schema or counted.dtypes == whole.dtypes
    assert rows(counted) == rows(whole) and whole.count() > 0


def test_a_known_newest_day_needs_no_scan(spark, estate, tmp_path):
    """With the newest day given the devices are read once, else twice; the rollups read the counts alone."""
    endpoints, lookup, roster = estate
    endpoints.write.parquet(f"{tmp_path}/endpoints")
    stored = spark.read.parquet(f"{tmp_path}/endpoints")
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
    day = F.to_date(F.lit(endpoints.agg(F.max("last_contact_time")).first()[0]))
    assert scans(d.device_counts(stored, AS_OF)) > 1 and scans(d.device_counts(stored, AS_OF, day)) == 1
    d.device_counts(stored, AS_OF, day).write.parquet(f"{tmp_path}/devices")
    counted = spark.read.parquet(f"{tmp_path}/devices")
    assert rows(counted) == rows(d.device_counts(stored, AS_OF))
    for name, rollup in ROLLUPS.items():
        assert all("/devices/" in f for f in rollup(counted, lookup, roster).inputFiles()), name


def test_a_known_newest_event_needs_no_scan(spark, table, tmp_path):
    table("audit", {"inst_id": "1", "event_time": 1706529600000, "description": "Logged in successfully"}, {"inst_id": "2", "event_time": 1, "description": "x"}).write.parquet(f"{tmp_path}/audit")
    stored = spark.read.parquet(f"{tmp_path}/audit")
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
    assert scans(audit_metrics(stored, AS_OF)) > 1 and scans(audit_metrics(stored, AS_OF, F.lit(1706529600000))) == 1
    assert rows(audit_metrics(stored, AS_OF)) == rows(audit_metrics(stored, AS_OF, F.lit(1706529600000)))
