"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Pages and texts are large: bound a batch handed to Python by bytes as well as rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
    # Call-site capture costs more than building the column.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "tallyboard", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the marts are tuned for; ``conf`` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000, size: int = 4 << 20) -> Iterator[None]:
    """Actions inside hand Python at most so many rows and about so many bytes at a time, also in a session of other settings.

    A batch is kept by the JVM, outside its heap, and by the worker. Fewer rows stay as they are set. The settings are
    those of the session, so they are for actions, which end inside, not for frames that are run later.
    """
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {k: spark.conf.get(k) for k in limits}
    if 0 < (own := int(before["spark.sql.execution.arrow.maxRecordsPerBatch"])) < rows:
        limits["spark.sql.execution.arrow.maxRecordsPerBatch"] = own
    for k, v in limits.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def work_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session works under its warehouse; on a cluster
    a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused path under the work folder."""
    return f"{work_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint, so a lost executor cannot change the rows."""
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(work_dir(df.sparkSession))
    return df.checkpoint()
