"""Devices counted once: the table from which every device metric and histogram is rolled up.

A run scans the devices a single time for it. The operators on devices take
either the devices themselves or this table; the helpers here tell the two
apart, so both give the same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from .anchors import contact_since, contact_within, last_contact_day

#: What metrics and histograms tell devices apart by.
KEYS = ["inst_id", "os", "sensor_version", "os_version", "av_vdf_version", "status", "deployment_type", "fetch_status"]
#: Days before the newest contact that are asked for, and before the day of the run.
NEWEST_DAYS, RUN_DAYS = (1, 7, 30), 30


def device_counts(endpoints: DataFrame, as_of: dt.datetime, newest: Column | None = None) -> DataFrame:
    """Devices per value of ``KEYS`` and per window of contact; counted before they are shuffled.

    ``newest`` is the day of the newest contact, where it is known already.
    """
    anchored = endpoints.withColumn("_newest", last_contact_day(endpoints) if newest is None else newest)
    windows = [contact_since(F.col("_newest"), days).alias(f"contact_{days}d") for days in NEWEST_DAYS]
    return anchored.groupBy(*KEYS, *windows, contact_within(as_of, RUN_DAYS).alias("in_30d")).agg(F.count("*").alias("n"))


def is_counted(devices: DataFrame) -> bool:
    return "contact_30d" in devices.columns


def number(devices: DataFrame, condition: Column | None = None) -> Column:
    """How many devices, or those that meet a condition; 0 for none."""
    each = F.col("n") if is_counted(devices) else F.lit(1).cast("bigint")
    return F.coalesce(F.sum(each if condition is None else F.when(condition, each)), F.lit(0).cast("bigint"))


def anchored(devices: DataFrame) -> DataFrame:
    """The devices with the newest day as a column, so several windows share one look for it; counted ones need none."""
    return devices if is_counted(devices) else devices.withColumn("_newest", last_contact_day(devices))


def since_newest(devices: DataFrame, days: int) -> Column:
    """Contact within some days of the newest contact in the table."""
    if is_counted(devices):
        return F.col(f"contact_{days}d")
    return contact_since(F.col("_newest") if "_newest" in devices.columns else last_contact_day(devices), days)


def within_run(devices: DataFrame, as_of: dt.datetime) -> Column:
    """Contact within 30 days of ``as_of`` (F8); counted devices have it for the day they were counted for."""
    return F.col("in_30d") if is_counted(devices) else contact_within(as_of, RUN_DAYS)
