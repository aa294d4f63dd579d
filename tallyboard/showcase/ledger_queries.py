"""Feeds landed in two overlapping deliveries, pages that never came, tables updated by key and replaced."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import stored
from ..plans.ledger import ENTRIES, Ledger
from ..session import scratch_path
from ..sources import landed
from . import source_queries as s
from .estate import Estate
from .registry import Query

SQL = {q.name: q.sql for q in s.QUERIES}

#: Replies in a landed file at most: a compressed file is read by one task.
FILE_REPLIES = 1_000_000


def landed_twice(e: Estate, name: str, replies: DataFrame, only_new: bool = False) -> DataFrame:
    """A table of the ledger after two landings of two thirds of the installations each; a third comes twice."""
    root, feed = scratch_path(e.spark, "ledger"), ENTRIES[name].feed
    book = Ledger(e.spark, f"{root}/landed", f"{root}/ledger", {name: ENTRIES[name]})
    slot = F.pmod(F.xxhash64("inst_id"), F.lit(3))
    for part in (slot < 2, slot > 0):
        # As they come over the wire: names and times repeat in every reply and would be most of what is written.
        replies.filter(part).write.mode("append").option("maxRecordsPerFile", FILE_REPLIES).json(f"{root}/landed/{feed}", compression="gzip")
        book.land(only_new)
    return book.table(name)


def page_replies(e: Estate) -> DataFrame:
    """Pages of 20 rows of every supplier's items, a quarter of them missing."""
    found = e.raw("lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"))
    return found.selectExpr("l_suppkey", "n", "explode(sequence(0, cast(ceil(n / 20) as int) - 1)) as page").filter("(l_suppkey + page * page) % 4 <> 1").selectExpr(
        "cast(l_suppkey as string) as inst_id", "page", "200 as status", "named_struct('num_found', n) as body")


def merged(e: Estate) -> DataFrame:
    """Customers, updated twice: every third has another balance and a new column, and some keys are new."""
    path, key = scratch_path(e.spark, "keyed"), "cust"
    base = e.raw("customer").selectExpr("c_custkey as cust", "c_name as name", "c_acctbal as balance")
    stored.write_keyed(base, path, key, 16)
    stored.merge_keyed(base.filter("cust % 3 = 0").selectExpr("cust", "balance + 1 as balance", "cast(cust % 7 as string) as grade"), path, key, 16)
    stored.merge_keyed(base.filter("cust % 5 = 0").selectExpr("cust + 1000000 as cust", "concat(name, ' II') as name", "cast(null as double) as balance"), path, key, 16)
    return stored.read_keyed(e.spark, path).select("cust", "name", "balance", "grade")


def switched(e: Estate) -> DataFrame:
    """Nations by a name that has been replaced, once by a write whose key repeats."""
    folder, name = scratch_path(e.spark, "switched"), "switched_nation"
    nations = e.raw("nation").selectExpr("n_nationkey as nation", "n_name as name")
    stored.switch(nations.filter("nation > 3"), name, folder, "nation")
    stored.switch(nations.withColumn("region", F.col("nation") % 5), name, folder, "nation")
    try:
        stored.switch(nations.unionByName(nations), name, folder, "nation")
    except ValueError:
        pass
    return e.spark.table(name)


QUERIES = [
    Query("k03_merge", "K3", merged, """
      select c_custkey as cust, c_name as name, case when c_custkey % 3 = 0 then c_acctbal + 1 else c_acctbal end as balance, case when c_custkey % 3 = 0 then cast(c_custkey % 7 as varchar) end as grade from customer
      union all select c_custkey + 1000000, c_name || ' II', null, null from customer where c_custkey % 5 = 0"""),
    Query("k01_switch", "K1 K9 S18", switched, "select n_nationkey as nation, n_name as name, n_nationkey % 5 as region from nation"),
    Query("s17_ledger_audit", "S17 S3", lambda e: landed_twice(e, "audit", s.audit_replies(e)), SQL["s03_audit_flatten"]),
    Query("s17_ledger_audit_only_new", "S17 S3", lambda e: landed_twice(e, "audit", s.audit_replies(e), only_new=True), SQL["s03_audit_flatten"]),
    Query("s17_ledger_endpoints", "S17 S4", lambda e: landed.in_contact(landed_twice(e, "endpoints", s.endpoint_replies(e)), s.CONTACT_AS_OF).select(
        "inst_id", "id", "status", "reg_time", "last_contact_time", "sensor_ood", "fetch_status"),
          f"select * from ({s.ENDPOINTS_SQL}) qualify row_number() over (partition by inst_id, id, fetch_status order by last_contact_time desc) = 1"),
    Query("s17_ledger_alerts", "S17 S5", lambda e: landed_twice(e, "alerts", e.alert_replies), SQL["s05_alert_facets"]),
    Query("s17_ledger_connectors", "S17 S7", lambda e: landed_twice(e, "connectors", s.connector_replies(e)).select(
        "inst_id", "connector_id", "connector_type", "last_event", "last_report", "name", "fetch_status"), s.CONNECTORS_SQL.replace("select ", "select distinct ", 1)),
    Query("s17_ledger_dashboards", "S17 S9", lambda e: landed_twice(e, "dashboards", s.dashboard_replies(e)), SQL["s09_dashboards"]),
    Query("s04_page_gaps", "S4", lambda e: landed.page_gaps(landed.pages(page_replies(e)), 20), """
      with found as (select l_suppkey, count(*) as n from lineitem group by 1),
      missing as (select l_suppkey, page, cast(ceil(n / 20) as int) as expected_pages, page - row_number() over (partition by l_suppkey order by page) as island
        from found, range(0, 1000000) p(page) where page < ceil(n / 20) and (l_suppkey + page * page) % 4 = 1)
      select cast(l_suppkey as varchar) as inst_id, cast(min(page) as int) as first_page, cast(max(page) as int) as last_page, expected_pages
      from missing m where exists (select 1 from range(0, 1000000) p(page) where page < expected_pages and (m.l_suppkey + page * page) % 4 <> 1)
      group by l_suppkey, island, expected_pages"""),
]
