"""Activity over time (A27): a gap-free series of days or months per installation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import values as v
from ..functions.time import DAY_MS, as_of_ms, ms_to_date
from .audit import _text, is_bypass

MONTHLY_FROM_DAYS = 61
COUNTS = ["logins", "bypass", "bypass_all", "connectors"]


def daily_activity(audit: DataFrame) -> DataFrame:
    """Events counted per installation and day; the only pass over the raw log."""
    return audit.filter(F.col("event_time").isNotNull()).groupBy(
        "inst_id", ms_to_date(F.col("event_time")).alias("day")).agg(
        F.min("event_time").alias("first_event"),
        F.count_if(_text().ilike(v.LOGIN)).alias("logins"),
        F.count_if(is_bypass()).alias("bypass"),
        F.count_if(is_bypass() & _text().contains("all")).alias("bypass_all"),
        F.count_if(_text().ilike(v.CONNECTOR_SERIES)).alias("connectors"))


def activity_series(audit: DataFrame, roster: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Logins, bypass events and connector logins per installation and bucket.

    Buckets run from the first event to a day past ``as_of`` (the last seven days
    when there is no event): months once the history reaches 61 days, else days.
    """
    now = as_of_ms(as_of)
    seen = daily_activity(audit).groupBy("inst_id").agg(
        F.min("first_event").alias("first_event"), F.collect_list(F.struct("day", *COUNTS)).alias("seen"))  # a struct a day
    start = F.coalesce("first_event", F.lit(now - 7 * DAY_MS))
    history = F.floor((F.lit(now) - F.col("start")) / F.lit(DAY_MS)).cast("int")
    span = (roster.select("inst_id").distinct().join(seen, "inst_id", "left").withColumn("start", start)
            .withColumn("days", history).withColumn("monthly", F.col("days") >= MONTHLY_FROM_DAYS))
    fmt = lambda day: F.when(F.col("monthly"), F.date_format(day, "yyyy-MM")).otherwise(
        F.date_format(day, "yyyy-MM-dd"))
    first = ms_to_date(F.col("start"))
    day_list = F.sequence(first, F.date_add(first, F.greatest(F.col("days"), F.lit(-1)) + 1))
    zero = [F.lit(0).cast("bigint").alias(c) for c in COUNTS]
    spine = F.transform(F.array_distinct(F.transform(day_list, fmt)), lambda b: F.struct(b.alias("bucket"), F.lit(True).alias("spine"), *zero))
    counted = F.transform("seen", lambda d: F.struct(fmt(d["day"]).alias("bucket"), F.lit(False).alias("spine"), *[d[c].alias(c) for c in COUNTS]))
    total = span.select("inst_id", F.inline(F.when(F.col("seen").isNull(), spine).otherwise(F.concat(spine, counted)))).groupBy(
        "inst_id", "bucket").agg(F.bool_or("spine").alias("spine"), *[F.sum(c).alias(c) for c in COUNTS])
    return total.filter("spine").select(
        "inst_id", "bucket", "logins", "bypass", F.when(F.col("bypass_all") > 0, "Yes").otherwise("No").alias("all_in_bypass"), "connectors")
