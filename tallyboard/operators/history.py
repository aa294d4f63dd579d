"""Snapshots and what changed since."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ..functions.numbers import ratio
from ..functions.time import as_of_ntz
from .keyed import latest_row
from .rules import declined


def snapshot(table: DataFrame, as_of: dt.datetime, key: str = "inst_id") -> DataFrame:
    """A day's copy of a table: ``unique_id`` = day + key, and the day (K8)."""
    day = F.to_date(as_of_ntz(as_of))
    return table.select(F.concat(day.cast("string"), F.col(key)).alias("unique_id"), day.alias("date"), "*")


def write_day(day: DataFrame, path: str) -> None:
    """Add a day to an archive; a rerun replaces that day and no other (K5).

    Rows are rebalanced by size, so a large day makes files of even size.
    """
    (day.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date").parquet(path))


def read_archive(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """All days of an archive; columns added later are NULL in older days (K4).

    With a declared schema no file is opened to find the columns.
    """
    return spark.read.schema(schema).parquet(path) if schema else spark.read.option("mergeSchema", "true").parquet(path)


def append(table: DataFrame, path: str) -> None:
    table.write.mode("append").parquet(path)


def replace(table: DataFrame, path: str) -> None:
    """Create or replace a table."""
    table.write.mode("overwrite").parquet(path)


def align_union(archive: DataFrame, today: DataFrame) -> DataFrame:
    """Archive without today's day plus today's rows, by column name."""
    days = today.select("date").distinct()
    return archive.join(days, "date", "left_anti").unionByName(today, allowMissingColumns=True)


def latest_day(archive: DataFrame, before: dt.datetime | None = None) -> Column:
    """Newest day in an archive (O2), optionally before a day, as a scalar subquery."""
    days = archive if before is None else archive.filter(F.col("date") < F.to_date(as_of_ntz(before)))
    return days.select(F.max("date")).scalar()


def previous(archive: DataFrame, columns: dict[str, str], key: str = "inst_id", before: dt.datetime | None = None) -> DataFrame:
    """Chosen columns of the newest snapshot, renamed (J11, J12); reads one partition of the archive."""
    return (archive.filter(F.col("date") == latest_day(archive, before))
            .select(key, *[F.col(c).alias(n) for c, n in columns.items()]))


def last_states(archive: DataFrame, columns: list[str], before: dt.datetime, key: str = "inst_id") -> DataFrame:
    """Newest snapshot of each key before a day, and the day it is of (``seen``): an as-of join's right side.

    Reads all days before; ``advance_state`` gets the same from the day before alone.
    """
    days = archive.filter(F.col("date") < F.to_date(as_of_ntz(before)))
    return latest_row(days.select(key, F.col("date").alias("seen"), *columns), [key], ["seen"])


def advance_state(before: DataFrame, today: DataFrame, as_of: dt.datetime, columns: list[str], key: str = "inst_id") -> DataFrame:
    """The last state of every key up to a day: today's row, or for a key that is absent today what was last seen.

    ``before`` has ``seen`` and ``columns`` by key. Kept a day (``write_day``),
    it spares an as-of join the scan of the archive: its cost grows with the
    keys, not with the days. A key that is NULL has no state.
    """
    day = F.to_date(as_of_ntz(as_of))
    now = today.select(key, day.alias("seen"), *columns)
    both = before.select(key, "seen", *columns).filter(F.col("seen") < day).unionByName(now).filter(F.col(key).isNotNull())
    return latest_row(both, [key], ["seen"]).withColumn("date", day)


def with_previous(table: DataFrame, archive: DataFrame | None, as_of: dt.datetime, key: str = "inst_id") -> DataFrame:
    """Add the deployment and band of the snapshot before ``as_of``, and whether there is any such snapshot.

    A rerun finds today's own snapshot in the archive; it does not count. Given a table of last states
    (``advance_state``) instead, a key is compared with its own newest snapshot, days without it passed over.
    """
    if archive is None:
        return table.withColumns({"previous_deployment": F.lit(None).cast("bigint"),
                                  "previous_brag": F.lit(None).cast("string"), "first_run": F.lit(True)})
    old = previous(archive, {"deployment": "previous_deployment", "cua_brag": "previous_brag"}, key, as_of)
    return table.join(old, key, "left").withColumn("first_run", latest_day(archive, as_of).isNull())


def with_decline(scored: DataFrame) -> DataFrame:
    """Band decline against the previous snapshot (B3): ``False`` for all on the first run, NULL for a new key later."""
    change = F.when(F.col("first_run"), "False").otherwise(declined(F.col("cua_brag"), F.col("previous_brag")))
    return scored.withColumn("brag_decrease", change).drop("previous_deployment", "previous_brag", "first_run")


def snapshot_changes(archive: DataFrame, key: str, value: str) -> DataFrame:
    """Change of a value from each snapshot to the next.

    A key has one row per day, so a window holds days.
    """
    w = Window.partitionBy(key).orderBy("date")
    before = F.lag(value).over(w)
    return (archive.select(key, "date", value).withColumn("previous", before)
            .withColumn("decrease_perc", ratio((F.col("previous") - F.col(value)) * 100, F.col("previous"))))


def archive_series(archive: DataFrame, columns: list[str], key: str = "inst_id") -> DataFrame:
    """Archive rows in date order per key."""
    shown = [c for c in columns if c in archive.columns and c not in (key, "date")]
    return archive.select(key, "date", *shown).orderBy(key, "date")
