"""Row numbers over groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize


def position(df: DataFrame, group: str, order: list[str], name: str = "position") -> DataFrame:
    """0-based position of each row in its group by ``order`` (O3); ``order`` must be unique in a group.

    A plain window would sort a whole group in one task. Here rows are range
    partitioned by group and order, so a hot group spans many tasks; each stretch
    is numbered on its own and shifted by the rows before it. The range-partitioned
    rows are checkpointed, because stretches and shifts must see the same partitions.
    """
    ranged = materialize(df.repartitionByRange(group, *order).withColumn("_stretch", F.spark_partition_id()))
    sizes = ranged.groupBy(group, "_stretch").agg(F.count("*").alias("_n"))
    before: Column = F.coalesce(
        F.sum("_n").over(Window.partitionBy(group).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = sizes.select(F.col(group).alias("_g"), F.col("_stretch").alias("_s"), before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy(group, "_stretch").orderBy(*order)) - 1
    joined = ranged.withColumn("_i", inside).join(
        shifts, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_stretch") == F.col("_s")))
    return joined.withColumn(name, (F.col("_before") + F.col("_i")).cast("bigint")).drop("_stretch", "_g", "_s", "_i", "_before")
