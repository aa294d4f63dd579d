"""Scores, bands, snapshots and their changes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..operators import history as hist
from ..operators import rules as r
from ..operators import stored
from ..plans import scorecard
from ..plans.refresh import BY_INSTALLATION
from ..session import scratch_path
from . import oracle as o
from .estate import AS_OF, TODAY, Estate, oracle
from .registry import Query
from .warehouse_queries import all_of

SWING_DAY = dt.datetime(2001, 7, 1)
SHOWN = ["violations_triggered", "count_of_violations", "cua_brag"]


def threshold_metrics(e: Estate) -> DataFrame:
    """Rule inputs spread over every limit, unknown values included: one key per order."""
    return e.raw("orders").selectExpr("o_orderkey as k", "o_custkey as c").selectExpr("k", *[f"{x} as {n}" for n, x in THRESHOLDS.items()])


DAY = 86_400_000
NOW_MS = o.NOW_MS
THRESHOLDS = {
    "days_since_login": "case when k % 11 > 0 then k % 35 end", "bypass_perc": "cast(k % 53 as double) / 2", "bypass": "k % 61",
    "last_30d_bypass_count": "c % 13", "bypass_all": "c % 17 = 3", "sensor_eol_support": "c % 59", "eol_perc": "cast(c % 107 as double) / 4",
    "open_alerts": "(k % 5) * 2500", "dismissed_alerts": "k % 9", "deployment": "case when k % 13 > 0 then (c % 8) * 900 end",
    "deployment_perc": "case when k % 7 > 0 then cast(c % 41 as double) * 2.5 end",
    "last_created_policy": f"{NOW_MS} - (c % 200) * {DAY}", "last_modified_policy": f"case when k % 6 > 0 then {NOW_MS} - (k % 200) * {DAY} end",
    "last_added_user": f"{NOW_MS} - (c % 99) * {DAY}", "previous_deployment": "case when k % 3 > 0 then (k % 10) * 1000 end",
    "cbc_cases_30d": "k % 5", "open_cbc_cases": "case when c % 4 > 0 then k % 8 end", "cbc_cases_90d": "k % 6",
}
THRESHOLD_SQL = "select k, " + ", ".join(f"{x} as {n}" for n, x in THRESHOLDS.items()) + " from (select o_orderkey as k, o_custkey as c from orders) t"


def monthly(e: Estate) -> DataFrame:
    """Snapshots of a customer's order count, one per month."""
    band = "case when count(*) <= 1 then 'Green' when count(*) = 2 then 'Yellow' else 'Red' end"
    return (e.raw("orders").groupBy(F.col("o_custkey").cast("string").alias("inst_id"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("date"))
            .agg((F.count("*") * 37).alias("deployment"), F.expr(band).alias("cua_brag")))


MONTHLY = """select cast(o_custkey as varchar) as inst_id, cast(date_trunc('month', o_orderdate) as date) as date, count(*) * 37 as deployment,
  case when count(*) <= 1 then 'Green' when count(*) = 2 then 'Yellow' else 'Red' end as cua_brag from orders group by 1, 2"""
PREVIOUS = "select inst_id, deployment as previous_deployment, cua_brag as previous_brag from monthly where date = (select max(date) from monthly where date < DATE '2001-07-01')"

NEWEST = """select inst_id, deployment as previous_deployment, cua_brag as previous_brag from monthly where date < DATE '2001-07-01'
  qualify row_number() over (partition by inst_id order by date desc) = 1"""


def current(e: Estate) -> DataFrame:
    """Order counts of the latest quarter, as today's table."""
    return e.raw("orders").filter(F.col("o_orderdate") >= F.lit("2001-05-01").cast("timestamp_ntz")).groupBy(
        F.col("o_custkey").cast("string").alias("inst_id")).agg(
        (F.count("*") * 33).alias("deployment"), F.expr("case when count(*) <= 1 then 'Green' when count(*) = 2 then 'Yellow' else 'Red' end").alias("cua_brag"))


CURRENT = """select cast(o_custkey as varchar) as inst_id, count(*) * 33 as deployment, case when count(*) <= 1 then 'Green' when count(*) = 2 then 'Yellow' else 'Red' end as cua_brag
  from orders where o_orderdate >= TIMESTAMP '2001-05-01' group by 1"""


def swings(e: Estate) -> DataFrame:
    before = hist.with_previous(current(e).drop("cua_brag"), monthly(e), SWING_DAY)
    rule = [x for x in r.RULES if "decrease" in x.name]
    return r.score(before, SWING_DAY, rule).select("inst_id", "deployment", "previous_deployment", *SHOWN)


def declines(e: Estate) -> DataFrame:
    return hist.with_decline(hist.with_previous(current(e), monthly(e), SWING_DAY))


def swings_across_gaps(e: Estate) -> DataFrame:
    """Swings against each customer's own newest month: states of a first day from the archive, then carried from day to day."""
    path, columns, archive = scratch_path(e.spark, "states"), ["deployment", "cua_brag"], monthly(e)
    start = dt.datetime(2001, 2, 1)
    states = hist.last_states(archive, columns, start)
    for month in (2, 3, 4, 5, 6):
        day = dt.datetime(2001, month, 1)
        hist.write_day(hist.advance_state(states, archive.filter(F.col("date") == F.lit(day.date())), day, columns), path)
        kept = hist.read_archive(e.spark, path, "inst_id string, seen date, deployment bigint, cua_brag string, date date")
        states = kept.filter(F.col("date") == F.lit(day.date()))
    before = hist.with_previous(current(e), kept, SWING_DAY)
    rule = [x for x in r.RULES if "decrease" in x.name]
    scored = r.score(before.drop("cua_brag"), SWING_DAY, rule).drop("cua_brag")
    return (hist.with_decline(scored.join(before.select("inst_id", "cua_brag"), "inst_id").withColumn("before", F.col("previous_deployment")))
            .select("inst_id", "deployment", "before", "violations_triggered", "count_of_violations", "brag_decrease"))


def bucketed_master(e: Estate) -> DataFrame:
    """The master's metrics assembled from tables in buckets of the installation, as a run does it."""
    path = scratch_path(e.spark, "bucketed")
    keep = lambda name, df: stored.write_bucketed(df, f"{path}/{name}", "inst_id", 8)
    t = e.tables | {name: keep(name, e.tables[name]) for name in BY_INSTALLATION}
    facts = scorecard.installation_facts(t, e.lookup, AS_OF) | {"activity_facts": scorecard.activity_facts(t["sf_data"], t["cse_activity"])}
    return scorecard.with_deployment_share(scorecard.assemble(t, {name: keep(name, df) for name, df in facts.items()})).select(*e.metrics.columns)


def snapshot_rerun(e: Estate) -> DataFrame:
    """Two days written, the second one twice: the rerun replaces its own day only."""
    path = scratch_path(e.spark, "snapshots")
    stock = e.raw("supplier").select(F.col("s_suppkey").cast("string").alias("inst_id"), F.col("s_acctbal").alias("arr"))
    later = AS_OF + dt.timedelta(days=1)
    hist.write_day(hist.snapshot(stock, AS_OF), path)
    hist.write_day(hist.snapshot(stock.withColumn("arr", F.lit(0.0)), later), path)
    hist.write_day(hist.snapshot(stock.withColumn("cse", F.lit("new column")), later), path)
    return hist.read_archive(e.spark, path).select("unique_id", "date", "inst_id", "arr", "cse")


def appended(e: Estate) -> DataFrame:
    path = scratch_path(e.spark, "appended")
    nations = e.raw("customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    hist.replace(nations.withColumn("n", F.lit(0)), path)
    hist.replace(nations, path)
    hist.append(e.raw("supplier").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.count("*").alias("n")), path)
    return e.spark.read.parquet(path)


def aligned(e: Estate) -> DataFrame:
    today = monthly(e).filter(F.col("date") == hist.latest_day(monthly(e))).withColumn("note", F.lit("today"))
    return hist.align_union(monthly(e), today)


def zero_cases(e: Estate) -> DataFrame:
    """Accounts with an installation without cases of ours in 90 days."""
    return e.sf_plan.filter(F.col("cbc_cases_90d") == 0).select("inst_id", "account_name")


QUERIES = [
    Query("r01_scores_at_limits", "R1 R2 R3 R4 R5 R6 R7 R8 R9 R10 R11 R12 R13 R14 R15 R16 R17 R18 R19 R20 R21 R22 R23 R24 R25 B1 B2 B4 X2",
          lambda e: r.score(threshold_metrics(e), AS_OF).select("k", *SHOWN), f"select k, {', '.join(SHOWN)} from ({o.scored('t')}) s".replace("from t)", f"from ({THRESHOLD_SQL}) t)")),
    Query("b02_installation_scores", "B2 B4 R1-R25 J21", lambda e: e.scored.select("inst_id", *SHOWN, "brag_decrease"),
          oracle(f"select inst_id, {', '.join(SHOWN)}, brag_decrease from master", "master")),
    Query("b04_account_scores", "B4 A15", lambda e: e.account_master.select("account_name", *SHOWN, "brag_decrease"),
          oracle(f"select account_name, {', '.join(SHOWN)}, brag_decrease from account_master", "account_master")),
    Query("r22_deployment_swing", "R22 J11 O2", swings,
          oracle("""select c.inst_id, c.deployment, p.previous_deployment, case when d then '>10% decrease in deployment counts' else '' end as violations_triggered,
             cast(case when d then 3 else 0 end as int) as count_of_violations, 'Green' as cua_brag from (
             select c.inst_id, c.deployment, p.previous_deployment, coalesce((p.previous_deployment - c.deployment) * 100.0 / p.previous_deployment >= 10, false) as d
             from current c left join previous p on c.inst_id = p.inst_id) c left join previous p on c.inst_id = p.inst_id""", monthly=MONTHLY, previous=PREVIOUS, current=CURRENT)),
    Query("r22_as_of", "R22 B3 W2 J11 J12", swings_across_gaps,
          oracle("""select c.inst_id, c.deployment, p.previous_deployment as before,
             case when (p.previous_deployment - c.deployment) * 100.0 / p.previous_deployment >= 10 then '>10% decrease in deployment counts' else '' end as violations_triggered,
             cast(case when (p.previous_deployment - c.deployment) * 100.0 / p.previous_deployment >= 10 then 3 else 0 end as int) as count_of_violations,
             case when p.previous_brag is null then null
             when (c.cua_brag in ('Yellow', 'Red') and p.previous_brag = 'Green') or (c.cua_brag = 'Red' and p.previous_brag = 'Yellow') then 'True' else 'False' end as brag_decrease
             from current c left join newest p on c.inst_id = p.inst_id""", monthly=MONTHLY, current=CURRENT, newest=NEWEST)),
    Query("b03_band_decline", "B3 J12", declines,
          oracle("""select c.inst_id, c.deployment, c.cua_brag, case when p.previous_brag is null then null
             when (c.cua_brag in ('Yellow', 'Red') and p.previous_brag = 'Green') or (c.cua_brag = 'Red' and p.previous_brag = 'Yellow') then 'True' else 'False' end as brag_decrease
             from current c left join previous p on c.inst_id = p.inst_id""", monthly=MONTHLY, previous=PREVIOUS, current=CURRENT)),
    Query("w02_snapshot_changes", "W2 R22", lambda e: hist.snapshot_changes(monthly(e), "inst_id", "deployment"),
          oracle("""select inst_id, date, deployment, previous, cast((previous - deployment) * 100 as double) / previous as decrease_perc from (
             select *, lag(deployment) over (partition by inst_id order by date) as previous from monthly) m""", monthly=MONTHLY)),
    Query("j19_zero_cases", "J19 R25", zero_cases, oracle("select inst_id, account_name from sf_data where cbc_cases_90d = 0", "sf_data")),
    Query("u02_align_union", "U2 K4", aligned,
          oracle("select *, case when date = (select max(date) from monthly) then 'today' end as note from monthly", monthly=MONTHLY)),
    Query("k05_snapshot_rerun", "K5 K8 K4 X6", snapshot_rerun,
          f"""select strftime(d, '%Y-%m-%d') || s_suppkey as unique_id, d as date, cast(s_suppkey as varchar) as inst_id, s_acctbal as arr, cse
             from supplier cross join (select {TODAY} as d, cast(null as varchar) as cse union all select {TODAY} + 1, 'new column') x"""),
    Query("k02_replace_and_append", "K1 K2 K9 S18", appended,
          "select c_nationkey, count(*) as n from customer group by 1 union all select s_nationkey, count(*) from supplier group by 1"),
    Query("j21_master_metrics", "J21 K3", lambda e: e.metrics, all_of("metrics")),
    Query("j21_bucketed_master", "J21 K3 A16", bucketed_master, all_of("metrics")),
]
