"""A full refresh: landed feeds and warehouse tables -> written tables, marts and archives.

Every stage is written once and read back, so later stages scan columnar files
instead of repeating the stages before, and a lost executor costs a task, not a run.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.time import as_of_ntz
from ..operators import histograms as h
from ..operators import history, stored
from ..operators.devices import device_counts
from ..operators.keyed import one_row, require_unique
from ..operators.lookups import sensor_lookup
from ..operators.rollup import account_members
from ..sources import landed, support, warehouse
from . import ledger, marts, scorecard


#: What a run asks of the days before.
BEFORE = "inst_id string, account_name string, deployment bigint, cua_brag string, date date"


#: Columns of the last state of a key.
STATE = ["deployment", "cua_brag"]

#: Tables of one row an installation, kept in buckets of it.
BY_INSTALLATION = ("sf_data", "alerts", "new_deployment")

#: Tables whose newest value of a column anchors a window.
ANCHORED = {"endpoints": "last_contact_time", "audit": "event_time"}


@dataclass
class Refresh:
    """Where a run reads and writes, and the day it stands for.

    With ``follow_gaps`` an installation or account that was absent for some days is compared with its own newest
    snapshot; without, with the newest day of the archive alone, where it is missing.
    """

    spark: SparkSession
    out: str
    as_of: dt.datetime
    product_groups: list[str]
    follow_gaps: bool = False

    def path(self, table: str) -> str:
        return f"{self.out.rstrip('/')}/{table}"

    def save(self, table: str, df: DataFrame) -> DataFrame:
        history.replace(df, self.path(table))
        return self.load(table)

    def save_with_newest(self, table: str, df: DataFrame, column: str) -> tuple[DataFrame, Column]:
        """Write a table and learn its newest value of a column from the same pass; the value is kept in ``anchors`` too."""
        seen = Observation(f"{table}_newest")
        history.replace(df.observe(seen, F.max(column).alias("newest")), self.path(table))
        newest = F.lit(seen.get["newest"]).cast(df.schema[column].dataType)
        one = self.spark.range(1).select(F.lit(table).alias("table"), newest.cast("string").alias("newest"))
        history.replace(one, f"{self.path('anchors')}/{table}")
        return self.load(table), newest

    def save_bucketed(self, table: str, df: DataFrame, key: str = "inst_id") -> DataFrame:
        """Write a table whose key is unique in as many buckets as a shuffle has partitions."""
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return stored.write_bucketed(df, self.path(table), key, buckets)

    def load(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def archive(self, table: str, schema: str | StructType | None = None) -> DataFrame | None:
        """An archive written by earlier runs, or None before the first; with only the declared columns, if given."""
        try:
            return history.read_archive(self.spark, self.path(table), schema)
        except AnalysisException as missing:
            if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def before(self, table: str, key: str) -> DataFrame | None:
        """What a run compares a table with: the archive, or the last states of all keys."""
        archive = self.archive(f"{table}_archive", BEFORE)
        if archive is None or not self.follow_gaps:
            return archive
        return self.last_states(table, key, archive)

    def last_states(self, table: str, key: str, archive: DataFrame) -> DataFrame:
        """States of the newest day before this run's; where states have not been kept up to the archive, from its days."""
        kept = self.archive(f"{table}_states", f"{key} string, seen date, deployment bigint, cua_brag string, date date")
        day = archive.filter(F.col("date") < F.to_date(as_of_ntz(self.as_of))).agg(F.max("date")).first()[0]
        if kept is not None and day is not None:
            states = kept.filter(F.col("date") == F.lit(day))
            if not states.isEmpty():
                return states
        return history.last_states(archive, STATE, self.as_of, key).withColumn("date", F.lit(day).cast("date"))

    def write_snapshot(self, table: str, df: DataFrame, key: str) -> None:
        """Add the day to a table's archive, and to the last states where they are followed."""
        archive = self.archive(f"{table}_archive", BEFORE) if self.follow_gaps else None
        today = history.snapshot(df, self.as_of, key)
        if self.follow_gaps:
            before = today.select(key, F.col("date").alias("seen"), *STATE).limit(0) if archive is None else self.last_states(table, key, archive)
            history.write_day(history.advance_state(before, df, self.as_of, STATE, key), self.path(f"{table}_states"))
        history.write_day(today, self.path(f"{table}_archive"))


def raw_tables(feeds: dict[str, DataFrame], roster: DataFrame, as_of: dt.datetime,
               flat: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Typed tables from the landed feeds; ``flat`` has those that a ledger holds already.

    What was landed twice counts once, and pages that never came leave a mark.
    """
    customers = landed.customers(roster, feeds["orgs"])
    flat = flat or {
        "audit": landed.audit(feeds["audit"]), "endpoint_pages": landed.pages(feeds["endpoints"]),
        "endpoints": landed.endpoints(feeds["endpoints"]), "alerts": one_row(landed.alerts(feeds["alerts"]), ["inst_id"]),
        "connectors": one_row(landed.connectors(feeds["connectors"]), ["inst_id", "connector_id", "name", "fetch_status"]),
        "dashboards": one_row(landed.dashboards(feeds["dashboards"]), ["inst_id"])}
    devices = landed.with_partial(landed.in_contact(flat["endpoints"], as_of), landed.page_gaps(flat["endpoint_pages"]))
    return {
        "customers": customers,
        "audit": flat["audit"],
        "endpoints": one_row(devices, ["inst_id", "id", "fetch_status"], ["last_contact_time"]),
        "alerts": flat["alerts"],
        "kits": one_row(landed.kits(feeds["kits"]), ["backend", "os", "version"], ["create_time"]),
        "connectors": flat["connectors"],
        "forwarders": landed.forwarders(feeds["forwarders"]).dropDuplicates(),
        "dashboards": flat["dashboards"],
        "policy_ids": landed.policy_ids(feeds["policies"], customers).dropDuplicates(),
        "rules": landed.rules(feeds["policy"], customers).dropDuplicates(),
        "version_support": support.version_support(feeds["pages"], as_of),
    }


def warehouse_tables(w: dict[str, DataFrame], as_of: dt.datetime, product_groups: list[str]) -> dict[str, DataFrame]:
    """Per-installation facts from the warehouse."""
    roster = warehouse.roster(w["installation"])
    return {
        "sf_data": warehouse.build_sf_data(roster, w, as_of, product_groups),
        "new_deployment": warehouse.latest_consumption(w["deployed_licence"], w["installation"]),
        "cse_activity": warehouse.activity(w["activity_timeline"], w["account"], as_of),
    }


def run(job: Refresh, feeds: dict[str, DataFrame], w: dict[str, DataFrame], flat: dict[str, DataFrame] | None = None) -> None:
    """One day's run: tables, lookup, scores, archives, trends and marts."""
    newest: dict[str, Column] = {}
    roster = job.save("roster", warehouse.roster(w["installation"]))
    plans = {**raw_tables(feeds, roster, job.as_of, flat), **warehouse_tables(w, job.as_of, job.product_groups)}
    t = {name: job.save_bucketed(name, df) if name in BY_INSTALLATION else job.save(name, df) for name, df in plans.items() if name not in ANCHORED}
    for name, column in ANCHORED.items():
        t[name], newest[name] = job.save_with_newest(name, plans[name], column)
    # The one scan of the devices: all that follows is rolled up from their counts.
    t["endpoints"] = job.save("devices", device_counts(t["endpoints"], job.as_of, F.to_date(newest["endpoints"])))
    lookup = job.save("sensor_lookup", sensor_lookup(t["endpoints"], t["kits"], t["version_support"]))
    for name in BY_INSTALLATION:
        require_unique(t[name], "inst_id")

    facts = scorecard.installation_facts(t, lookup, job.as_of, newest["audit"])
    facts["activity_facts"] = scorecard.activity_facts(t["sf_data"], t["cse_activity"])
    metrics = scorecard.with_deployment_share(scorecard.assemble(t, {name: job.save_bucketed(name, df) for name, df in facts.items()}))
    master = job.save("master", scorecard.score_installations(metrics, job.before("master", "inst_id"), job.as_of))
    accounts = job.save("account_master", scorecard.score_accounts(master, job.before("account_master", "account_name"), job.as_of))
    job.save("account_members", account_members(master))
    job.save("account_forecasts", warehouse.account_forecasts(w["opportunity"], job.as_of))

    job.write_snapshot("master", master, "inst_id")
    job.write_snapshot("account_master", accounts, "account_name")
    history.write_day(h.deployment_archive(t["endpoints"], lookup, job.as_of), job.path("deployment_archive"))
    history.write_day(h.deployment_trend(t["endpoints"], t["sf_data"], job.as_of), job.path("deployment_trend"))

    write_marts(job, t, lookup, master, accounts)


def write_marts(job: Refresh, t: dict[str, DataFrame], lookup: DataFrame, master: DataFrame, accounts: DataFrame) -> None:
    """Report tables, foldered by owner where owners read them."""
    versions = h.sensor_versions(t["endpoints"], lookup)
    summary = job.save("deployment_summary", h.deployment_summary(t["endpoints"], lookup))
    trend = job.load("deployment_trend")
    marts.write_by_owner(marts.master_sheet(master), "csm", job.path("mart_master"))
    marts.write_by_owner(marts.master_sheet(accounts, fields=marts.ACCOUNT_FIELDS), "csm", job.path("mart_account_master"))
    marts.write_by_owner(marts.versions_sheet(versions, master), "csm", job.path("mart_sensor_versions"), ("account_name", "label"))
    marts.write_by_owner(marts.versions_sheet(h.os_versions(t["endpoints"]), master), "csm", job.path("mart_os_versions"),
                         ("account_name", "label"))
    marts.write_by_owner(marts.deployment_rows(summary, master), "csm", job.path("mart_deployment"))
    job.save("mart_trend", marts.trend_sheet(trend))
    job.save("mart_trend_percent", marts.trend_percent_sheet(trend))
    for name, pack in marts.engineer_packs(master, accounts).items():
        marts.write_by_owner(pack, "cse_key", job.path(f"mart_cse_{name}"))
    job.save("engineer_installations", marts.engineer_installations(t["sf_data"]))
    # Today's columns, declared: no file of the days before is opened to learn them.
    columns = {"master_archive": history.snapshot(master, job.as_of).schema,
               "deployment_archive": h.deployment_archive(t["endpoints"], lookup, job.as_of).schema}
    archives = {name: job.archive(name, schema) for name, schema in columns.items()}
    for name, section in marts.account_sections({**t, **{k: a for k, a in archives.items() if a is not None}}, lookup, job.as_of).items():
        marts.write_by_installation(section, job.path(f"mart_account_{name}"), marts.SECTION_ORDER[name])
    job.save("mart_positions", marts.owner_positions(master))
    job.save("mart_columns", job.spark.createDataFrame(marts.column_metadata(), "name string, heading string, format string"))
    marts.write_csv(marts.bi_export(accounts, master, t["sf_data"]), job.path("bi_export"))


def open_feeds(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """All landed feeds under a folder, one subfolder each."""
    from ..schemas import LANDED
    return {feed: landed.read_feed(spark, feed, f"{path.rstrip('/')}/{feed}") for feed in LANDED}


def open_warehouse(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    from ..schemas import WAREHOUSE
    return {t: warehouse.read_table(spark, f"{path.rstrip('/')}/{t}", "parquet") for t in WAREHOUSE}


def run_landed(job: Refresh, landed_path: str, w: dict[str, DataFrame], only_new: bool = False) -> None:
    """A run that flattens only the files that have come since the run before (S17): the ledger has the rest."""
    book = ledger.Ledger(job.spark, landed_path, job.path("_ledger"))
    book.land(only_new)
    run(job, open_feeds(job.spark, landed_path), w, book.tables())
