"""Incremental landing: flatten only the reply files that arrived since the last run.

The file source remembers which files it has read, so a run with
``availableNow`` loads the new ones, in bounded micro-batches, and stops. A
micro-batch that is retried after a failure overwrites its own folder, so it
lands once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import LANDED


def _landed(spark: SparkSession, target: str) -> DataFrame | None:
    try:
        return spark.read.parquet(target)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def land_new_files(spark: SparkSession, feed: str, source: str, target: str, checkpoint: str,
                   flatten: Callable[[DataFrame], DataFrame], max_files: int = 10_000, only_new: bool = False) -> StreamingQuery:
    """Append the flattened rows of new files of a feed to ``target/batch=<n>``.

    With ``only_new`` the rows of installations that an earlier batch has brought are left out.
    """
    replies = spark.readStream.schema(LANDED[feed]).option("maxFilesPerTrigger", max_files).json(source)

    def write(batch: DataFrame, number: int) -> None:
        rows, path = flatten(batch), f"{target.rstrip('/')}/batch={number}"
        if only_new and (landed := _landed(spark, target)) is not None:
            rows = rows.join(landed.filter(F.col("batch") != number).select("inst_id").distinct(), "inst_id", "left_anti").select(*rows.columns)
        rows.write.mode("overwrite").parquet(path)

    return (replies.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
