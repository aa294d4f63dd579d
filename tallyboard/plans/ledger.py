"""A ledger of landed replies: every file is flattened once, as it arrives, and runs read what was flattened.

Each feed has a table with the number of the landing in ``batch``. Files may
overlap: what was landed twice counts once, and where a later reply stands for
the same thing it wins. With ``only_new`` an installation that an earlier
landing has brought is left as it is, and only installations not loaded yet are
added.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.keyed import one_row
from ..sources import landed
from ..streaming.landing import land_new_files


@dataclass(frozen=True)
class Entry:
    """How a table of the ledger is flattened, and what makes its rows one."""

    feed: str
    flatten: Callable[[DataFrame], DataFrame]
    unique: Callable[[DataFrame], DataFrame]


def _newest_reply(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of the newest landing of each installation, one a key: its last reply stands for it as a whole."""
    last = rows.groupBy("inst_id").agg(F.max("batch").alias("batch"))
    return one_row(rows.join(last, ["inst_id", "batch"]), ["inst_id", *keys])


def _devices(rows: DataFrame) -> DataFrame:
    """A row per device, that of the newest contact; a failure counts as long as no later landing has answered."""
    last = rows.groupBy("inst_id").agg(F.max("batch").alias("_last"))
    current = rows.join(last, "inst_id").filter((F.col("fetch_status") == landed.OK) | (F.col("batch") == F.col("_last"))).drop("_last")
    return one_row(current, ["inst_id", "id", "fetch_status"], ["last_contact_time", "batch"])


#: The tables of the ledger. A reply is the newest of its installation; pages and events add up.
ENTRIES = {
    "audit": Entry("audit", landed.audit, lambda rows: rows.drop("batch").dropDuplicates()),
    "endpoints": Entry("endpoints", landed.endpoints, _devices),
    "endpoint_pages": Entry("endpoints", landed.pages, lambda rows: one_row(rows, ["inst_id", "page"], ["batch"])),
    "alerts": Entry("alerts", landed.alerts, _newest_reply),
    "connectors": Entry("connectors", landed.connectors, lambda rows: _newest_reply(rows, "connector_id", "name", "fetch_status")),
    "dashboards": Entry("dashboards", landed.dashboards, _newest_reply),
}


@dataclass
class Ledger:
    """The tables of the feeds under ``path``, fed from the folders under ``source``."""

    spark: SparkSession
    source: str
    path: str
    entries: dict[str, Entry] = field(default_factory=lambda: ENTRIES)

    def land(self, only_new: bool = False) -> None:
        """Flatten the files that have come since the last landing; a feed without a folder has none."""
        for name, entry in self.entries.items():
            source = f"{self.source.rstrip('/')}/{entry.feed}"
            if landed.has_files(self.spark, source):
                land_new_files(self.spark, entry.feed, source, self._at(name), f"{self._at('_checkpoints')}/{name}", entry.flatten, only_new=only_new).awaitTermination()

    def table(self, name: str) -> DataFrame:
        """What has been landed so far, each thing once; empty before the first landing."""
        entry, path = self.entries[name], self._at(name)
        empty = entry.flatten(self.spark.createDataFrame([], landed.LANDED[entry.feed]))
        if not landed.has_files(self.spark, path):
            return empty
        rows = self.spark.read.schema(f"{_ddl(empty)}, batch bigint").parquet(path)
        return entry.unique(rows).select(*empty.columns)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in self.entries}

    def _at(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)
