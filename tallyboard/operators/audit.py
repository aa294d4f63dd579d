"""Metrics of the audit log: one pass, one shuffle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import values as v
from ..functions.numbers import items_in
from ..functions.text import ilike_any
from ..functions.time import whole_days_since
from .anchors import event_within, since_last_event


def _text() -> Column:
    return F.col("description")


def is_login() -> Column:
    """A person's login, not a connector's."""
    return _text().ilike(v.LOGIN) & ~_text().ilike(v.CONNECTOR_PREFIX)


def is_connector_login() -> Column:
    return _text().ilike(v.CONNECTOR_LOGIN)


def is_bypass() -> Column:
    """Protection switched off by hand (F2)."""
    return _text().ilike(v.BYPASS) & ilike_any(_text(), v.BYPASS_ON) & ~_text().ilike(v.BYPASS_NOT)


def bypass_all() -> Column:
    return is_bypass() & _text().ilike(v.BYPASS_ALL)


def _count_in(window: Column, event: Column) -> Column:
    """Events inside the window; NULL for a key with no row in the window at all."""
    return F.sum(F.when(window, F.when(event, 1).otherwise(0)))


def audit_metrics(audit: DataFrame, as_of: dt.datetime, newest: Column | None = None) -> DataFrame:
    """Logins, connector logins, bypass use and last-of-kind dates per installation; ``newest`` is the newest event's time, where known."""
    recent, near_last = event_within(as_of, 30), since_last_event(audit, 30, newest)
    devices = F.when(recent, F.when(is_bypass() & ~bypass_all(), items_in(_text())).otherwise(F.lit(0)))
    last = lambda event: F.max(F.when(event, F.col("event_time")))
    out = audit.filter(F.col("event_time").isNotNull()).groupBy("inst_id").agg(
        _count_in(recent, is_login()).alias("last_30d_login_count"),
        last(is_login()).alias("last_login"),
        _count_in(near_last, is_connector_login()).alias("last_30d_connector_count"),
        F.sum(devices).alias("last_30d_bypass_count"),
        F.max(F.when(recent, bypass_all())).alias("bypass_all"),
        last(_text().ilike(v.POLICY_CREATED)).alias("last_created_policy"),
        last(_text().ilike(v.POLICY_MODIFIED)).alias("last_modified_policy"),
        last(_text().ilike(v.USER_ADDED)).alias("last_added_user"),
    )
    return out.withColumn("days_since_login", whole_days_since(F.col("last_login"), as_of))


def bypass_display() -> Column:
    """Bypass count as shown: ``All`` when everything was bypassed."""
    return F.when(F.col("bypass_all"), "All").otherwise(F.col("last_30d_bypass_count").cast("string"))


def first_events(audit: DataFrame) -> DataFrame:
    """Earliest event per installation; blank times are ignored."""
    return audit.filter(F.col("event_time").isNotNull()).groupBy("inst_id").agg(F.min("event_time").alias("first_event"))
