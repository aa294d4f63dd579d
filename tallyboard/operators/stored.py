"""Written tables that change: a replacement readers never see half of, and an update by key."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .keyed import require_unique

#: Parts of a keyed table; an update rewrites those that hold a changed key.
PARTS = 256


def switch(table: DataFrame, name: str, folder: str, key: str | None = None) -> DataFrame:
    """Replace what a name stands for (K1): write beside, check, then switch.

    The name is a view of the catalog over a folder of its own for each write.
    Until the new rows are written whole, and their key is unique if one is
    given, the name gives the old ones; a write that fails changes nothing. A
    replacement may have other columns. The folders before stay, for
    readers that have begun.
    """
    spark = table.sparkSession
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    table.write.parquet(path)
    written = spark.read.parquet(path)
    if key:
        require_unique(written, key)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    return spark.table(name)


def _part(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("part")


def write_keyed(table: DataFrame, path: str, key: str, parts: int = PARTS) -> None:
    """Write a table in parts by the hash of its key, which must be unique and known."""
    _check(table, key)
    table.withColumn("part", _part(key, parts)).repartition("part").write.mode("overwrite").partitionBy("part").parquet(path)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The table; a column that an update has added is NULL in the parts it has not touched."""
    return spark.read.option("mergeSchema", "true").parquet(path).drop("part")


def merge_keyed(changes: DataFrame, path: str, key: str, parts: int = PARTS) -> int:
    """Update a keyed table by the first field of the changes, its key (K3); gives the number of parts rewritten.

    A row with a known key takes the values of the changes, NULL too, and keeps
    its other columns; a new key is a new row; a new column is added. Parts
    without a changed key are neither read nor written. The merged rows are
    written aside before the first part is replaced, so a failure until then
    leaves the table as it was, and after it the same update can be run again.
    """
    spark = changes.sparkSession
    _check(changes, key)
    dealt = changes.withColumn("part", _part(key, parts))
    touched = [r["part"] for r in dealt.select("part").distinct().collect()]  # at most ``parts`` numbers
    if not touched:
        return 0
    stored = spark.read.option("mergeSchema", "true").parquet(path).filter(F.col("part").isin(touched))
    ours = [c for c in stored.columns if c not in (key, "part")]
    theirs = [c for c in changes.columns if c != key]
    new = dealt.select(key, "part", F.lit(True).alias("_new"), *[F.col(c).alias(f"_new_{c}") for c in theirs])
    met = stored.join(new, [key, "part"], "full")
    cells = [F.when(F.col("_new"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in ours else F.col(f"_new_{c}").alias(c) for c in theirs]
    merged = met.select(key, *[c for c in ours if c not in theirs], *cells, "part")
    aside = f"{path.rstrip('/')}.merging"
    merged.write.mode("overwrite").parquet(aside)
    (spark.read.parquet(aside).repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path))
    return len(touched)


def write_bucketed(table: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write a table with one row a key in buckets of its key, and read it as such.

    Tables of the same number of buckets join by that key, and group by it,
    without a shuffle. Meant for tables whose key is unique, since a bucket
    is read by one task. The files can be read by path too, as any others.
    """
    spark = table.sparkSession
    name = f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"
    (table.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(name))
    return spark.table(name)


def _check(table: DataFrame, key: str) -> None:
    require_unique(table, key)
    if not table.filter(F.col(key).isNull()).isEmpty():
        raise ValueError(f"{key} is unknown in some rows")
