"""A customer estate derived from the star-schema tables.

Every table the library reads is derived from the given Parquet tables, so the
work of a query grows with them: supplier = installation, lineitem = endpoint,
events = audit log, orders = opportunities, cases and calls to action, customer
= users and subscriptions, conversations and documents = names. ``SQL`` holds
the same derivations for the oracle.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import lookups
from ..operators.keyed import restrict_to
from ..plans import scorecard
from ..sources import landed, support, warehouse

AS_OF = dt.datetime(2024, 2, 5)
PRODUCT_GROUPS = ["Group 0", "Group 1"]

# The given tables.
GIVEN = {
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "pages": "page_id bigint, url string, html string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}

_VERSION = "concat('3.', cast({p} % 10 as string), '.', cast(({p} div 10) % 5 as string), '.', cast(100 + {p} % 900 as string))"
_OS = "case {p} % 3 when 0 then 'WINDOWS' when 1 then 'MAC' else 'LINUX' end"


class Estate:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """A given table, opened with its declared schema: no file is read to infer one."""
        if name not in self._raw:
            self._raw[name] = self.spark.read.schema(GIVEN[name]).parquet(f"{self.dir}/{name}.parquet")
        return self._raw[name]

    # --- warehouse -------------------------------------------------------
    @cached_property
    def installation(self) -> DataFrame:
        place = (self.raw("nation").join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
                 .select("n_nationkey", "r_name"))
        return self.raw("supplier").join(place, F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(
            "cast(s_suppkey as string) as inst_id", "cast(s_suppkey div 4 as string) as account_id",
            "r_name as backend", "case when s_acctbal >= 0 then cast(1000 + s_suppkey as string) end as org_id",
            "(s_suppkey * 13) % 20 as licences",
            "case s_suppkey % 4 when 0 then 'New' when 1 then 'Complete' when 3 then 'Cancelled' end as status",
            "case when s_suppkey % 5 = 0 then 'Perpetual' else 'Subscription - Cloud' end as type",
            "cast(date_add(date'2020-01-01', cast(s_suppkey % 1000 as int)) as timestamp_ntz) + interval 18 hours as created",
            "case when s_suppkey % 7 > 0 then date_add(date'2020-01-01', cast(s_suppkey % 1000 + s_suppkey % 90 as int)) end as half_deployed")

    @cached_property
    def account(self) -> DataFrame:
        return self.raw("supplier").groupBy(F.expr("s_suppkey div 4").alias("a")).agg(
            F.sum(F.col("s_acctbal").cast("decimal(18,2)")).cast("double").alias("arr"),
            F.min("s_nationkey").alias("lo"), F.max("s_nationkey").alias("hi")).selectExpr(
            "cast(a as string) as account_id", "concat('Account#', lpad(cast(a as string), 6, '0')) as name", "arr",
            "cast(lo as string) as csm_id", "case when hi > 5 then cast(25 + hi as string) end as cse_id",
            "concat('Role ', cast(lo % 3 as string)) as csm_role", "hi * 4 as gsm_score", "lo * 3 as gs_overall",
            "date_add(date'2023-01-01', cast(a % 365 as int)) as gs_last_update_date",
            "concat('T', cast(hi % 3 as string)) as tier", "concat('T', cast(lo % 3 as string)) as previous_tier",
            "case when hi % 2 = 0 then concat('note ', cast(a as string)) end as csm_comments",
            "concat('adoption ', cast(lo as string)) as gs_adoption_comments",
            "cast(a div 2 as string) as parent_account")

    @cached_property
    def user(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "cast(c_custkey as string) as user_id", "c_name as name", "concat(lower(c_name), '@example.com') as email",
            "cast(c_custkey div 10 as string) as manager_id")

    @cached_property
    def subscription(self) -> DataFrame:
        return self.raw("customer").selectExpr("cast(c_custkey div 60 as string) as account_id",
                                               "c_mktsegment as product_group")

    @cached_property
    def opportunity(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "cast(o_orderkey as string) as opp_id", "cast(o_custkey div 60 as string) as account_id",
            "o_totalprice as amount", "o_orderpriority as forecast",
            "date_add(to_date(o_orderdate), 8400) as close_date",
            "case o_orderstatus when 'O' then 'Renewal' when 'F' then 'Early Renewal' else 'New business' end as type",
            "case o_orderkey % 4 when 0 then 'CBD;Other' when 1 then 'Endpoint' when 2 then 'Other' else 'EEDR,Workload' end as product_family")

    @cached_property
    def case(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "cast(o_custkey div 60 as string) as account_id",
            "concat('Group ', cast(o_orderkey % 97 as string)) as product_group",
            "concat(cast(date_add(to_date(o_orderdate), 8214) as string), 'T09:30:00.000+0000') as created",
            "case o_orderstatus when 'F' then 'Closed' when 'O' then 'Open' else 'Pending' end as status")

    @cached_property
    def cta(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "cast(o_custkey div 60 as string) as account_id", "date_add(to_date(o_orderdate), 8000) as closed_date",
            "case when o_orderkey % 900 = 1 then 'New' when o_orderkey % 900 = 2 then 'Work In Progress' "
            "when o_orderkey % 3 = 0 then 'Closed No Action' else 'Closed Success' end as status",
            "case o_orderpriority when '1-URGENT' then 'Product Usage Analytics' when '2-HIGH' then 'Tech Assessment' "
            "when '3-MEDIUM' then 'CSA Whiteboarding' else 'Other' end as reason")

    @cached_property
    def deployed_licence(self) -> DataFrame:
        owner = self.installation.select(F.col("inst_id").cast("bigint").alias("l_suppkey"),
                                         F.concat("backend", F.lit("|"), "org_id").alias("prodkey"))
        return self.raw("lineitem").join(owner, "l_suppkey").select(
            "prodkey", F.date_format("l_shipdate", "yyyyMMdd").cast("bigint").alias("calendarid"),
            F.col("l_quantity").cast("bigint").alias("deployed_last_day"), F.col("l_extendedprice").alias("month_average"))

    @cached_property
    def activity_timeline(self) -> DataFrame:
        return self.raw("events").selectExpr(
            "cast(user_id div 4 as string) as account_id", "to_date(ts) as activity_date",
            "case event_type when 'view' then 'CSE: Activity' else event_type end as type_name")

    @property
    def warehouse(self) -> dict[str, DataFrame]:
        names = ("account", "installation", "user", "subscription", "opportunity", "case", "cta", "deployed_licence",
                 "activity_timeline")
        return {n: getattr(self, n) for n in names}

    # --- typed usage tables ----------------------------------------------
    @cached_property
    def endpoints(self) -> DataFrame:
        os = _OS.format(p="l_partkey")
        return self.raw("lineitem").selectExpr(
            "cast(l_suppkey as string) as inst_id", "concat(l_orderkey, '-', l_linenumber) as id",
            f"{_VERSION.format(p='l_partkey')} as sensor_version",
            "case l_linestatus when 'O' then 'WORKLOAD' else 'ENDPOINT' end as deployment_type",
            f"concat({os}, ' ', cast(10 + l_linenumber as string)) as os_version",
            f"{STATUS} as status",
            "l_shipdate + interval 8120 days as last_contact_time", f"{os} as os",
            "case when l_tax > 0 then concat('8.', cast(cast(round(l_tax * 100) as int) as string)) end as av_vdf_version",
            "'OK' as fetch_status")

    @cached_property
    def kits(self) -> DataFrame:
        return self.raw("part").selectExpr(
            # Small parts are kits of a platform nobody runs: their versions stay without one.
            "'all' as backend", "case when p_size < 20 then 'OTHER' else case p_partkey % 3 when 0 then 'WINDOWS' when 1 then 'MAC' else 'UBUNTU' end end as os",
            f"{_VERSION.format(p='p_partkey')} as version")

    @cached_property
    def version_support(self) -> DataFrame:
        part = self.raw("part").selectExpr("p_partkey % 3 as o", "p_partkey % 10 as a", "(p_partkey div 10) % 5 as b").distinct()
        lines = part.selectExpr("o", "a", "0 as b", "concat('3.', cast(a as string), case when a % 2 = 1 then '.x' else '' end) as version").distinct()
        # The last two fixes of a line have dates of their own.
        fixes = part.filter("b >= 3").selectExpr("o", "a", "b", "concat('3.', cast(a as string), '.', cast(b as string)) as version")
        dated = lines.unionByName(fixes).selectExpr(
            "case o when 0 then 'tag_win' when 1 then 'tag_mac' else 'tag_lin' end as os", "version",
            "date_add(date'2020-06-01', cast(a * 160 + b * 40 as int)) as standard",
            "date_add(date'2021-06-01', cast(a * 160 + b * 40 as int)) as extended",
            "case when a < 9 then date_add(date'2023-06-01', cast(a * 160 + b * 40 as int)) end as eol")
        level = support.support_level(F.col("standard"), F.col("extended"), F.col("eol"), AS_OF)
        return dated.withColumn("current_level", level)

    @cached_property
    def audit(self) -> DataFrame:
        k = "cast(get_json_object(props, '$.k') as int)"
        return self.raw("events").selectExpr("user_id", "event_type", "ts", f"{k} as k").select(
            F.col("user_id").cast("string").alias("inst_id"), F.concat(F.lit("u"), F.col("k").cast("string")).alias("user"),
            _event_ms().alias("event_time"), F.expr(DESCRIPTION).alias("description"))

    @cached_property
    def alert_replies(self) -> DataFrame:
        n = lambda cond, name: F.count_if(F.expr(cond)).alias(name)
        counts = self.raw("lineitem").groupBy("l_suppkey").agg(*[n(cond, name) for name, cond in ALERT_CONDITIONS.items()])
        value = lambda id_, name: F.struct(F.lit(id_).alias("id"), F.col(name).alias("total"))
        facet = lambda field, *values: F.struct(
            F.lit(field).alias("field"), F.filter(F.array(*values), lambda v: v["total"] > 0).alias("values"))
        body = F.struct(F.array(
            facet("workflow", value("OPEN", "open"), value("DISMISSED", "dismissed")),
            facet("sensor_action", value("TERMINATE", "terminated"), value("DENY", "denied"), value("ALLOW_AND_LOG", "allow_log")),
            facet("run_state", value("RAN", "ran"), value("DID_NOT_RUN", "not_ran")),
            facet("policy_applied", value("APPLIED", "policy_applied"), value("NOT_APPLIED", "policy_not_applied"))).alias("results"))
        return counts.select(F.col("l_suppkey").cast("string").alias("inst_id"), F.lit(200).alias("status"), body.alias("body"))

    @cached_property
    def alerts(self) -> DataFrame:
        return landed.alerts(self.alert_replies)

    @cached_property
    def connectors(self) -> DataFrame:
        return self.raw("conversations").selectExpr("cast(conv_id as string) as inst_id", "text as name")

    @cached_property
    def forwarders(self) -> DataFrame:
        return self.raw("documents").selectExpr("cast(doc_id as string) as inst_id", "text as name")

    # --- derived by the library ------------------------------------------
    @cached_property
    def roster(self) -> DataFrame:
        return warehouse.roster(self.installation)

    @cached_property
    def lookup(self) -> DataFrame:
        return lookups.sensor_lookup(self.endpoints, self.kits, self.version_support)

    @cached_property
    def licences(self) -> DataFrame:
        return restrict_to(warehouse.sibling_licences(self.installation, self.account), self.roster)

    @cached_property
    def named(self) -> DataFrame:
        """Installations on the roster with their account's owners."""
        return restrict_to(warehouse.account_info(self.account, self.installation, self.user), self.roster)

    @cached_property
    def sf_plan(self) -> DataFrame:
        return warehouse.build_sf_data(self.roster, self.warehouse, AS_OF, PRODUCT_GROUPS)

    @cached_property
    def sf_data(self) -> DataFrame:
        return self.sf_plan

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        return {
            "sf_data": self.sf_plan, "alerts": self.alerts, "audit": self.audit, "endpoints": self.endpoints,
            "forwarders": self.forwarders, "connectors": self.connectors,
            "new_deployment": warehouse.latest_consumption(self.deployed_licence, self.installation),
            "cse_activity": warehouse.activity(self.activity_timeline, self.account, AS_OF),
        }

    @cached_property
    def metrics(self) -> DataFrame:
        return scorecard.master_metrics(self.tables, self.lookup, AS_OF)

    @cached_property
    def scored(self) -> DataFrame:
        return scorecard.score_installations(self.metrics, None, AS_OF)

    @cached_property
    def master(self) -> DataFrame:
        return self.scored

    @cached_property
    def account_master(self) -> DataFrame:
        return scorecard.score_accounts(self.master, None, AS_OF)


def _event_ms():
    from ..functions.time import ntz_to_ms
    return ntz_to_ms(F.col("ts"))


ALERT_CONDITIONS = {
    "open": "l_linestatus = 'O'", "dismissed": "l_linestatus = 'F' and l_returnflag = 'A'",
    "terminated": "l_returnflag = 'A'", "denied": "l_returnflag = 'R'", "allow_log": "l_returnflag = 'N'",
    "ran": "l_tax > 0.04", "not_ran": "l_tax <= 0.04", "policy_applied": "l_discount > 0.09",
    "policy_not_applied": "l_discount < 0.01",
}

STATUS = "case when l_returnflag = 'N' then 'DEREGISTERED' when l_returnflag = 'R' and l_tax > 0.06 then 'BYPASS' else 'REGISTERED' end"

DESCRIPTION = """case event_type
  when 'view' then case when k % 2 = 0 then 'Logged in successfully' else 'LOGIN SUCCESSFUL' end
  when 'click' then concat('Connector ', cast(k as string), ' logged in successfully')
  when 'error' then case when k = 0 then 'Bypass enabled for all' when k % 5 = 1 then 'Bypass mode turned to on for d1,d2,d3'
    when k % 5 = 2 then 'bypass ENABLED for d1' when k % 5 = 3 then 'Bypass enabled (Policy Action)' else 'Bypass disabled for d1,d2' end
  when 'purchase' then case when k % 2 = 0 then concat('Created policy P', cast(k as string)) else concat('Policy P', cast(k as string), ' was modified') end
  else concat('Added user u', cast(k as string)) end"""


# --- the same tables for the oracle ---------------------------------------
def _v(p: str) -> str:
    return f"concat('3.', {p} % 10, '.', ({p} // 10) % 5, '.', 100 + {p} % 900)"


def _os(p: str) -> str:
    return _OS.format(p=p)


NOW = f"TIMESTAMP '{AS_OF}'"
TODAY = f"DATE '{AS_OF.date()}'"
NOW_MS = str(int(AS_OF.replace(tzinfo=dt.timezone.utc).timestamp() * 1000))

SQL: dict[str, str] = {
    "installation": """select cast(s_suppkey as varchar) as inst_id, cast(s_suppkey // 4 as varchar) as account_id, r_name as backend,
      case when s_acctbal >= 0 then cast(1000 + s_suppkey as varchar) end as org_id, (s_suppkey * 13) % 20 as licences,
      case s_suppkey % 4 when 0 then 'New' when 1 then 'Complete' when 3 then 'Cancelled' end as status,
      case when s_suppkey % 5 = 0 then 'Perpetual' else 'Subscription - Cloud' end as type,
      DATE '2020-01-01' + cast(s_suppkey % 1000 as int) + INTERVAL 18 HOUR as created,
      case when s_suppkey % 7 > 0 then DATE '2020-01-01' + cast(s_suppkey % 1000 + s_suppkey % 90 as int) end as half_deployed
      from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "account": """select cast(a as varchar) as account_id, 'Account#' || lpad(cast(a as varchar), 6, '0') as name, arr, cast(lo as varchar) as csm_id,
      case when hi > 5 then cast(25 + hi as varchar) end as cse_id, 'Role ' || (lo % 3) as csm_role, hi * 4 as gsm_score, lo * 3 as gs_overall,
      DATE '2023-01-01' + cast(a % 365 as int) as gs_last_update_date, 'T' || (hi % 3) as tier, 'T' || (lo % 3) as previous_tier,
      case when hi % 2 = 0 then 'note ' || a end as csm_comments, 'adoption ' || lo as gs_adoption_comments, cast(a // 2 as varchar) as parent_account
      from (select s_suppkey // 4 as a, cast(sum(cast(s_acctbal as decimal(18,2))) as double) as arr, min(s_nationkey) as lo, max(s_nationkey) as hi
            from supplier group by 1) t""",
    "users": """select cast(c_custkey as varchar) as user_id, c_name as name, lower(c_name) || '@example.com' as email,
      cast(c_custkey // 10 as varchar) as manager_id from customer""",
    "subscription": "select cast(c_custkey // 60 as varchar) as account_id, c_mktsegment as product_group from customer",
    "opportunity": """select cast(o_orderkey as varchar) as opp_id, cast(o_custkey // 60 as varchar) as account_id, o_totalprice as amount,
      o_orderpriority as forecast, cast(o_orderdate as date) + 8400 as close_date,
      case o_orderstatus when 'O' then 'Renewal' when 'F' then 'Early Renewal' else 'New business' end as type,
      case o_orderkey % 4 when 0 then 'CBD;Other' when 1 then 'Endpoint' when 2 then 'Other' else 'EEDR,Workload' end as product_family from orders""",
    "cases": """select cast(o_custkey // 60 as varchar) as account_id, 'Group ' || (o_orderkey % 97) as product_group,
      cast(o_orderdate as date) + 8214 + INTERVAL 570 MINUTE as created,
      case o_orderstatus when 'F' then 'Closed' when 'O' then 'Open' else 'Pending' end as status from orders""",
    "cta": """select cast(o_custkey // 60 as varchar) as account_id, cast(o_orderdate as date) + 8000 as closed_date,
      case when o_orderkey % 900 = 1 then 'New' when o_orderkey % 900 = 2 then 'Work In Progress'
           when o_orderkey % 3 = 0 then 'Closed No Action' else 'Closed Success' end as status,
      case o_orderpriority when '1-URGENT' then 'Product Usage Analytics' when '2-HIGH' then 'Tech Assessment'
           when '3-MEDIUM' then 'CSA Whiteboarding' else 'Other' end as reason from orders""",
    "deployed_licence": """select backend || '|' || org_id as prodkey, cast(strftime(l_shipdate, '%Y%m%d') as bigint) as calendarid,
      cast(l_quantity as bigint) as deployed_last_day, l_extendedprice as month_average
      from lineitem join installation on cast(l_suppkey as varchar) = inst_id""",
    "activity_timeline": """select cast(user_id // 4 as varchar) as account_id, cast(ts as date) as activity_date,
      case event_type when 'view' then 'CSE: Activity' else event_type end as type_name from events""",
    "endpoints": f"""select cast(l_suppkey as varchar) as inst_id, concat(l_orderkey, '-', l_linenumber) as id, {_v('l_partkey')} as sensor_version,
      case l_linestatus when 'O' then 'WORKLOAD' else 'ENDPOINT' end as deployment_type, concat({_os('l_partkey')}, ' ', 10 + l_linenumber) as os_version,
      {STATUS} as status,
      l_shipdate + INTERVAL 8120 DAY as last_contact_time, {_os('l_partkey')} as os,
      case when l_tax > 0 then concat('8.', cast(round(l_tax * 100) as int)) end as av_vdf_version from lineitem""",
    "kits": f"""select case p_partkey % 3 when 0 then 'WINDOWS' when 1 then 'MAC' else 'UBUNTU' end as os, {_v('p_partkey')} as version
      from part where p_size >= 20""",
    "version_support": f"""select os, version, standard, extended, eol, case when eol < {NOW} then 'EOL' when extended < {NOW} then 'EX'
      when standard < {NOW} then 'ST' when standard > {NOW} then 'Unreleased' end as current_level from (
      select case o when 0 then 'tag_win' when 1 then 'tag_mac' else 'tag_lin' end as os, version,
        DATE '2020-06-01' + cast(a * 160 + b * 40 as int) as standard, DATE '2021-06-01' + cast(a * 160 + b * 40 as int) as extended,
        case when a < 9 then DATE '2023-06-01' + cast(a * 160 + b * 40 as int) end as eol from (
        select distinct p_partkey % 3 as o, p_partkey % 10 as a, 0 as b, concat('3.', p_partkey % 10, case when p_partkey % 10 % 2 = 1 then '.x' else '' end) as version from part
        union all
        select distinct p_partkey % 3, p_partkey % 10, (p_partkey // 10) % 5, concat('3.', p_partkey % 10, '.', (p_partkey // 10) % 5) from part
        where (p_partkey // 10) % 5 >= 3) u) d""",
    "audit": f"""select cast(user_id as varchar) as inst_id, 'u' || k as user, epoch_us(ts) // 1000 as event_time, {DESCRIPTION} as description
      from (select user_id, event_type, ts, cast(json_extract_string(props, '$.k') as int) as k from events) e""",
    "alerts": "select cast(l_suppkey as varchar) as inst_id, " + ", ".join(
        f"count(*) filter (where {cond}) as {name}" for name, cond in ALERT_CONDITIONS.items()) + " from lineitem group by 1",
    "connectors": "select cast(conv_id as varchar) as inst_id, text as name from conversations",
    "forwarders": "select cast(doc_id as varchar) as inst_id, text as name from documents",
    "roster": "select inst_id, backend, org_id from installation where backend is not null and org_id is not null",
    "release_lines": """select upper(substr(regexp_replace(os, '^.*_', ''), 1, 3)) as os_code, replace(version, '.x', '') as line, current_level as level from version_support
      where current_level is not null""",
    "versions": "select distinct sensor_version as version, os from endpoints",
    "sensor_lookup": """select v.version, v.os, exists(select 1 from kits k where k.version = v.version
        and lower(v.os) = case when lower(k.os) = 'ubuntu' then 'linux' when lower(k.os) = 'linux' then '-' else lower(k.os) end) as dl_available,
      case when v.os = 'MAC' and (v.version like '3.7.3%' or v.version like '3.7.4%') then 'ST' else coalesce(r.level, 'EOL') end as support_level
      from versions v left join (
        select version, os, max_by(level, length(line)) as level from versions v2 join release_lines r
          on upper(substr(v2.os, 1, 3)) = r.os_code and starts_with(v2.version, r.line) and length(r.line) < length(v2.version) group by 1, 2) r
      on v.version = r.version and v.os = r.os""",
    "anchor": "select cast(max(last_contact_time) as date) as d from endpoints",
    "live": """select e.*, l.dl_available, l.support_level from endpoints e left join sensor_lookup l on e.sensor_version = l.version and e.os = l.os
      where e.status in ('REGISTERED', 'BYPASS') and e.last_contact_time >= (select d - 30 from anchor)""",
    "recent": f"""select e.*, l.version as known, l.dl_available, l.support_level from endpoints e left join sensor_lookup l on e.sensor_version = l.version and e.os = l.os
      where e.last_contact_time > {NOW} - INTERVAL 30 DAY""",
}

# Tables each derived table is made from.
NEEDS = {
    "deployed_licence": ["installation"], "roster": ["installation"], "release_lines": ["version_support"], "versions": ["endpoints"],
    "sensor_lookup": ["kits", "versions", "release_lines"], "anchor": ["endpoints"], "live": ["sensor_lookup", "anchor"],
    "recent": ["sensor_lookup"],
}


def oracle(body: str, *tables: str, **extra: str) -> str:
    """``body`` with the named derived tables (and extra named subqueries) in front of it."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for t in tables:
        add(t)
    parts = [f"{n} as ({SQL[n]})" for n in order] + [f"{n} as ({q})" for n, q in extra.items()]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + body
