"""The three meanings of "the last n days" (F7-F10)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.time import DAY_MS, as_of_ms, as_of_ntz


def last_contact_day(endpoints: DataFrame) -> Column:
    """Date of the newest contact anywhere in the table, as a scalar subquery.

    Spark computes the one value first (a one-column scan) and uses it as a
    constant in the scan filter, so there is no join.
    """
    return endpoints.select(F.to_date(F.max("last_contact_time"))).scalar()


def contact_since(newest_day: Column, days: int) -> Column:
    """Contact on or after midnight, ``days`` before the given newest contact day."""
    return F.col("last_contact_time") >= F.date_sub(newest_day, days).cast("timestamp_ntz")


def since_last_contact(endpoints: DataFrame, days: int) -> Column:
    """Contact within ``days`` of the newest contact in the table."""
    return contact_since(last_contact_day(endpoints), days)


def since_last_event(audit: DataFrame, days: int = 30, newest: Column | None = None) -> Column:
    """Event at most ``days`` before the newest event, to the millisecond."""
    newest = audit.select(F.max("event_time")).scalar() if newest is None else newest
    return F.col("event_time") >= newest - F.lit(days * DAY_MS)


def event_within(as_of: dt.datetime, days: int = 30, column: str = "event_time") -> Column:
    """Epoch-ms event later than ``days`` before ``as_of``, to the second (F8)."""
    floor = as_of_ms(as_of) // 1000 - days * 86_400
    return F.floor(F.col(column) / F.lit(1000)) > F.lit(floor)


def contact_within(as_of: dt.datetime, days: int = 30, column: str = "last_contact_time") -> Column:
    """Contact later than ``days`` before ``as_of`` (F8)."""
    return F.col(column) > as_of_ntz(as_of) - F.expr(f"INTERVAL {days} DAYS")


def day_within(column: Column, as_of: dt.datetime, days: int) -> Column:
    """Instant later than midnight, ``days`` before the day of ``as_of``."""
    return column > F.date_sub(F.to_date(as_of_ntz(as_of)), days).cast("timestamp_ntz")


def after_today(column: Column, as_of: dt.datetime) -> Column:
    """Date later than the day of ``as_of``."""
    return column > F.to_date(as_of_ntz(as_of))


def within_year(column: Column, as_of: dt.datetime) -> Column:
    """Date within the year before ``as_of``."""
    return column.cast("timestamp_ntz") > as_of_ntz(as_of) - F.expr("INTERVAL 1 YEAR")
