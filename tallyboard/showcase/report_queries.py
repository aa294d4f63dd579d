"""Rollup and report marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import histograms as h
from ..operators import history as hist
from ..operators.keyed import tolerant_select
from ..operators.ranking import position
from ..operators.rollup import account_members, account_rollup
from ..plans import marts
from ..session import scratch_path
from . import oracle as o
from .estate import AS_OF, TODAY, oracle
from .metric_queries import FAMILIES, LABEL, OS_KEYS, SUMMARY, TREND
from .registry import Query
from .warehouse_queries import all_of

KEYS = OS_KEYS + ["st", "ex", "eol"] + FAMILIES


def sheet_sql(source: str, fields: list[str] = marts.MASTER_FIELDS) -> str:
    cols = []
    for c in fields:
        if c in marts.EVENT_TIMES:
            cols.append(f"cast(epoch_ms({c}) as date) as {c}")
        elif c == "last_30d_bypass_count":
            cols.append(f"case when bypass_all then 'All' else cast({c} as varchar) end as {c}")
        else:
            cols.append(c)
    return f"select {', '.join(cols)} from {source} where csm is not null"


def pack_sql(source: str, more: str = "", fields: list[str] = marts.ACCOUNT_FIELDS) -> str:
    return f"select lower(cse) as cse_key, {', '.join(fields)} from {source} where cse is not null and cse <> 'None' {more}"


def order_archive(e):
    """Daily snapshots with consumption, from orders."""
    return e.raw("orders").groupBy(F.col("o_custkey").cast("string").alias("inst_id"), F.to_date("o_orderdate").alias("date")).agg(
        F.max(F.col("o_totalprice").cast("bigint")).alias("peak_daily_consumption"), F.count("*").alias("deployment"))


ORDER_ARCHIVE = """select cast(o_custkey as varchar) as inst_id, cast(o_orderdate as date) as date, max(cast(trunc(o_totalprice) as bigint)) as peak_daily_consumption, count(*) as deployment
  from orders group by 1, 2"""


def owner_marts(e):
    path = scratch_path(e.spark, "by_owner")
    marts.write_by_owner(e.raw("customer"), "c_mktsegment", path, ("c_name",))
    return marts.read_mart(e.spark, path)


def exported(e):
    path = scratch_path(e.spark, "export")
    marts.write_csv(e.raw("customer").select("c_custkey", "c_name"), path)
    return e.spark.read.schema("c_custkey bigint, c_name string").option("header", True).csv(path)


def trend_of(e):
    return h.deployment_trend(e.endpoints, e.roster, AS_OF)


TREND_SHEET = f"select backend as section, date, version, n from ({TREND}) t where version like '3%'"
DEPLOYMENT_SQL = "select m.inst_id, m.account_name, m.csm, m.arr, m.licenses, m.deployment, " + ", ".join(
    f"cast(coalesce(sum(s.n) filter (where s.key = '{k}'), 0) as bigint) as \"{k}\"" for k in KEYS) + \
    f" from master m left join ({SUMMARY}) s on m.inst_id = s.inst_id where m.csm is not null group by 1, 2, 3, 4, 5, 6"

def report_columns(e):
    """Report columns that the master fills in at least one row, with heading and format."""
    filled = e.scored.agg(*[F.count(c).alias(c) for c in marts.MASTER_FIELDS if c in e.scored.columns])
    named = F.array(*[F.struct(F.lit(c).alias("name"), F.lit(label).alias("heading"), F.lit(kind).alias("format"),
                               (F.col(c) if c in filled.columns else F.lit(0)).cast("bigint").alias("filled")) for c, label, kind in marts.REPORT_COLUMNS])
    return filled.select(F.inline(named))


COLUMNS_SQL = " union all ".join(f"select '{c}' as name, '{label}' as heading, '{kind}' as format, count({c}) as filled from master" for c, label, kind in marts.REPORT_COLUMNS)

QUERIES = [
    Query("a15_account_rollup", "A15 X7 A16", lambda e: account_rollup(e.master), all_of("rollup")),
    Query("a15_account_members", "A15 X7", lambda e: account_members(e.master),
          oracle("select account_name, inst_id, orgid, account__c from master where account_name is not null", "master")),
    Query("a15_account_lists", "A15 X7", lambda e: account_members(e.master).select("account_name", "inst_id"), oracle("select account_name, inst_id from master where account_name is not null", "master")),
    Query("a32_engineer_installations", "A32 X8", lambda e: marts.engineer_installations(e.named),
          oracle("select lower(cse) as cse_key, inst_id from sf_data where cse is not null and cse <> 'None'", "sf_data")),
    Query("m01_master_sheet", "M1 F12 F14 O1", lambda e: marts.master_sheet(e.scored), oracle(sheet_sql("master"), "master")),
    Query("m01_account_sheet", "M1 F12", lambda e: marts.master_sheet(e.account_master, fields=marts.ACCOUNT_FIELDS),
          oracle(sheet_sql("account_master", marts.ACCOUNT_FIELDS), "account_master")),
    Query("m02_sensor_versions", "M2 F15 J18", lambda e: marts.versions_sheet(h.sensor_versions(e.endpoints, e.lookup), e.named),
          oracle(f"""select s.account_name, l.inst_id, s.csm, {LABEL} as label, count(*) as n from live l left join sf_data s on l.inst_id = s.inst_id
             where s.csm is not null group by 1, 2, 3, 4""", "live", "sf_data")),
    Query("m03_os_versions", "M3 F15 J18", lambda e: marts.versions_sheet(h.os_versions(e.endpoints), e.named),
          oracle("""select s.account_name, l.inst_id, s.csm, lower(os_version) as label, count(*) as n from live l left join sf_data s on l.inst_id = s.inst_id
             where s.csm is not null group by 1, 2, 3, 4""", "live", "sf_data")),
    Query("m04_deployment_sheet", "M4 F16 J18", lambda e: marts.deployment_sheet(h.deployment_summary(e.endpoints, e.lookup), e.scored, KEYS),
          oracle(DEPLOYMENT_SQL, "live", "master")),
    Query("m04_deployment_rows", "M4 J18", lambda e: marts.deployment_rows(h.deployment_summary(e.endpoints, e.lookup), e.scored),
          oracle(f"select m.inst_id, m.account_name, m.csm, m.arr, m.licenses, m.deployment, s.kind, s.key, s.n from master m left join ({SUMMARY}) s on m.inst_id = s.inst_id where m.csm is not null",
                 "live", "master")),
    Query("m01_columns", "M1", lambda e: report_columns(e), oracle(COLUMNS_SQL, "master")),
    Query("m05_trend_sheet", "M5 U3", lambda e: marts.trend_sheet(trend_of(e)), oracle(TREND_SHEET, "live", "roster")),
    Query("m06_trend_percent", "M6 A30 W3", lambda e: marts.trend_percent_sheet(trend_of(e)),
          oracle(f"select *, {o.pct('n', 'sum(n) over (partition by section, date)')} as perc from ({TREND_SHEET}) t", "live", "roster")),
    Query("m07_os_support_section", "M7 U3", lambda e: marts.account_sections(e.tables, e.lookup, AS_OF)["os_support"],
          oracle("""select inst_id, os, count(*) filter (where support_level = 'ST') as standard, count(*) filter (where support_level = 'EX') as extended,
             count(*) filter (where support_level = 'EOL') as eol, count(*) as total, 'os_support' as section from recent group by 1, 2""", "recent")),
    Query("m08_consumption", "M8 X14", lambda e: marts.consumption_series(order_archive(e)),
          f"select inst_id, strftime(date, '%Y-%m') as month, date, peak_daily_consumption, deployment from ({ORDER_ARCHIVE}) a"),
    Query("m09_engineer_master", "M9 F12", lambda e: marts.engineer_packs(e.scored, e.scored)["master"], oracle(pack_sql("master", fields=marts.MASTER_FIELDS), "master")),
    Query("m09_engineer_accounts", "M9 F12", lambda e: marts.engineer_packs(e.master, e.account_master)["account_master"],
          oracle(pack_sql("account_master"), "account_master")),
    Query("m09_engineer_reds", "M9 F13", lambda e: marts.engineer_packs(e.master, e.account_master)["reds"],
          oracle(pack_sql("account_master", "and cua_brag = 'Red'"), "account_master")),
    Query("m09_engineer_yellows", "M9 F13", lambda e: marts.engineer_packs(e.master, e.account_master)["yellows"],
          oracle(pack_sql("account_master", "and cua_brag = 'Yellow'"), "account_master")),
    Query("m10_master_trend", "M10 W4", lambda e: hist.archive_series(order_archive(e), marts.MASTER_FIELDS), ORDER_ARCHIVE),
    Query("f14_tolerant_select", "F14", lambda e: tolerant_select(e.raw("customer"), ["c_name", "C_CUSTKEY", "no_such_column"]),
          'select c_name, c_custkey as "C_CUSTKEY", cast(null as varchar) as no_such_column from customer'),
    Query("k06_bi_export", "K6", lambda e: marts.bi_export(e.account_master, e.master, e.sf_data),
          oracle("select " + ", ".join(f'{"m" if c == "orgid" else "a"}.{c} as "{n}"' for n, c in marts.BI_FIELDS.items())
                 + """, s.account__c, m.inst_id from account_master a left join master m on a.account_name = m.account_name left join sf_data s on m.inst_id = s.inst_id""", "account_master")),
    Query("k06_csv_round_trip", "K6", exported, "select c_custkey, c_name from customer"),
    Query("k07_owner_marts", "K7 F12", owner_marts, "select * from customer"),
    Query("o03_owner_positions", "O3 O1", lambda e: marts.owner_positions(e.named),
          oracle("""select csm, account_name, inst_id, row_number() over (partition by csm order by account_name, inst_id) - 1 as position
             from account_info join roster using (inst_id) where csm is not null""", "account_info", "roster")),
    Query("o03_positions", "O3 O1", lambda e: position(e.raw("customer").select("c_mktsegment", "c_name", "c_custkey"), "c_mktsegment", ["c_name", "c_custkey"]),
          "select c_mktsegment, c_name, c_custkey, row_number() over (partition by c_mktsegment order by c_name, c_custkey) - 1 as position from customer"),
]
