"""Time expressions. All of them read and give UTC without asking the session zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

DAY_MS = 86_400_000
_EPOCH = dt.date(1970, 1, 1)


def as_of_ms(as_of: dt.datetime) -> int:
    """Epoch milliseconds of a naive UTC (or aware) datetime."""
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=dt.timezone.utc)
    return int(as_of.timestamp() * 1000)


def as_of_ntz(as_of: dt.datetime) -> Column:
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def ms_to_date(ms: Column) -> Column:
    return F.date_add(F.lit(_EPOCH), F.floor(ms / F.lit(DAY_MS)).cast("int"))


def ms_to_ntz(ms: Column) -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=(ms / F.lit(1000)).cast("decimal(18,6)"))


def ntz_to_ms(ts: Column) -> Column:
    days = F.datediff(F.to_date(ts), F.lit(_EPOCH)).cast("bigint")
    seconds = F.date_part(F.lit("SECOND"), ts)
    return (days * DAY_MS + F.hour(ts) * 3_600_000 + F.minute(ts) * 60_000
            + F.floor(seconds * 1000)).cast("bigint")


def iso_utc(text: Column) -> Column:
    """ISO-8601 text, with or without an offset, to the UTC wall clock; junk gives NULL.

    The cast reads the wall clock and leaves the offset out; only a text with an
    offset other than zero is looked at again.
    """
    wall = text.try_cast("timestamp_ntz")
    offset = F.replace(F.regexp_extract(text, r"([+-]\d{2}:?\d{2})$", 1), F.lit(":"), F.lit(""))
    minutes = ((F.substring(offset, 2, 2).cast("int") * 60 + F.substring(offset, 4, 2).cast("int"))
               * F.when(offset.startswith("-"), -1).otherwise(1))
    utc = text.endswith("Z") | text.endswith("+0000") | text.endswith("+00:00")
    shifted = text.rlike(r":\d{2}(\.\d+)?[+-]\d{2}:?\d{2}$")
    return F.when(utc, wall).when(shifted, wall - F.make_dt_interval(mins=minutes)).otherwise(wall)


def calendar_days(start: Column, end: Column) -> Column:
    """Whole calendar days between two dates, whatever the time of day."""
    return F.datediff(F.to_date(end), F.to_date(start))


def whole_days_since(ms: Column, as_of: dt.datetime) -> Column:
    """Elapsed whole days from an epoch-ms instant to ``as_of``."""
    seconds = F.lit(as_of_ms(as_of) // 1000) - F.floor(ms / F.lit(1000))
    return F.floor(seconds / F.lit(86400)).cast("bigint")


def month_year(text: Column) -> Column:
    """``Jan 23``, ``March, 2024`` -> first of that month; blank or unreadable gives NULL."""
    pattern = r"^\s*([a-zA-Z]+).+?(\d+)"
    month = F.initcap(F.substring(F.regexp_extract(text, pattern, 1), 1, 3))
    year = F.regexp_extract(text, pattern, 2)
    year = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)
    number = F.array_position(F.array(*[F.lit(m) for m in _MONTHS]), month)
    day = F.concat_ws("-", year, F.lpad(number.cast("string"), 2, "0"), F.lit("01"))
    return F.when(number > 0, day.try_cast("date"))


# Month abbreviations.
_MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
