"""One key holds a third of the rows: results stay whole."""

import datetime as dt

from pyspark.sql import functions as F

from estate_helpers import AS_OF, ms, one
from tallyboard.operators import audit as a
from tallyboard.operators import endpoints as ep
from tallyboard.operators.series import daily_activity

N = 30_000


def test_hot_installation(spark, table):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("i"), (F.col("id") % 997).cast("string")))
    endpoints = spark.range(N).select(
        key.alias("inst_id"), F.col("id").cast("string").alias("id"), F.lit("3.7.1.5").alias("sensor_version"), F.lit("ENDPOINT").alias("deployment_type"),
        F.lit("w").alias("os_version"), F.when(F.col("id") % 2 == 0, "REGISTERED").otherwise("BYPASS").alias("status"),
        F.lit(dt.datetime(2024, 1, 30).isoformat()).cast("timestamp_ntz").alias("last_contact_time"), F.lit("WINDOWS").alias("os"), F.lit("OK").alias("fetch_status"))
    lookup = table("version string, os string, dl_available boolean, support_level string",
                   {"version": "3.7.1.5", "os": "WINDOWS", "dl_available": True, "support_level": "ST"})
    got = ep.endpoint_metrics(endpoints, table("inst_id string, licenses_purchased bigint", {"inst_id": "hot", "licenses_purchased": N}), lookup)
    hot = one(got, inst_id="hot")
    assert (hot["deployment"], hot["deployment_perc"], hot["bypass"], hot["standard_perc"]) == (N // 3, 33.33, N // 6, 100.0)
    assert got.agg(F.sum("deployment")).first()[0] == N


def test_hot_audit_log(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 997).cast("string"))
    audit = spark.range(N).select(key.alias("inst_id"), F.lit("u").alias("user"), (F.lit(ms(2024, 1, 30)) - F.col("id")).alias("event_time"),
                                  F.lit("Bypass enabled for a,b").alias("description"))
    hot = one(a.audit_metrics(audit, AS_OF), inst_id="hot")
    assert hot["last_30d_bypass_count"] == 2 * N // 3
    assert daily_activity(audit).agg(F.sum("bypass")).first()[0] == N
