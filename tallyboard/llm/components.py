"""Connected components of links, by the least number each node can reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rows


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``id, component`` of every node of the links (pairs of longs): the least node it is connected with.

    Each round a node takes the least label of its neighbours, and then the label
    of its label; a chain halves each round. Every round is written.
    """
    links = rows.stored(links.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x <> y").distinct(), "links")
    ways = links.union(links.select("y", "x"))
    labels = rows.stored(ways.groupBy("x").agg(F.min("y").alias("y")).select(F.col("x").alias("id"), F.least("x", "y").alias("component")), "labels")
    while True:
        heard = ways.join(labels.withColumnRenamed("id", "y"), "y").groupBy("x").agg(F.min("component").alias("heard"))
        now = labels.join(heard.withColumnRenamed("x", "id"), "id").select("id", F.least("component", "heard").alias("component"), F.col("component").alias("was"))
        now = rows.stored(now, "labels")
        jump = now.select(F.col("id").alias("component"), F.col("component").alias("further"))
        after = rows.stored(now.join(jump, "component").select("id", F.least("component", "further").alias("component"), "was"), "labels")
        labels = after.select("id", "component")
        if after.filter("component <> was").isEmpty():
            return labels
