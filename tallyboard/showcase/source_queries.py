"""Flatteners over landed replies derived from the tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import numbers, text, time
from ..functions.values import THREAT_METRICS, THREAT_TYPES
from ..operators import keyed
from ..sources import landed, support, warehouse
from .estate import AS_OF, NOW, Estate, oracle
from .registry import Query

CONTACT_AS_OF = dt.datetime(2001, 1, 1)


def org_replies(e: Estate) -> DataFrame:
    return e.raw("supplier").selectExpr(
        "cast(s_suppkey as string) as inst_id", "case when s_acctbal > 4000 then 404 else 200 end as status",
        "named_struct('organization', named_struct('orgKey', concat('K', cast(s_suppkey as string)))) as body")


def customers(e: Estate) -> DataFrame:
    return landed.customers(e.roster, org_replies(e))


CUSTOMERS_SQL = """select r.inst_id, r.backend as prod, r.org_id, coalesce(o.org_key, '') as org_key from roster r
  left join (select cast(s_suppkey as varchar) as inst_id, 'K' || s_suppkey as org_key from supplier where s_acctbal <= 4000) o on r.inst_id = o.inst_id"""


def audit_replies(e: Estate, marks: str = "") -> DataFrame:
    entry = ("named_struct('loginName', event_type, 'eventTime', event_id, 'description', "
             f"concat('<b>', event_type, '</b> set <i>', props, '</i> ', repeat(concat(event_type, ' <u>on</u> '), 6)){marks})")
    return e.raw("events").selectExpr("cast(user_id as string) as inst_id", "'bypass' as search", "200 as status",
                                      f"named_struct('entries', array({entry}, {entry})) as body")


def talk_replies(e: Estate) -> DataFrame:
    return e.raw("conversations").selectExpr(
        "cast(conv_id as string) as inst_id", "'policy' as search", "200 as status",
        "named_struct('entries', array(named_struct('loginName', role, 'eventTime', turn, 'description', concat('<p>', text, '</p>')))) as body")


def endpoint_replies(e: Estate) -> DataFrame:
    device = ("named_struct('id', concat(l_orderkey, '-', l_linenumber), 'sensor_version', concat('3.', l_linenumber), "
              "'deployment_type', l_linestatus, 'os_version', concat('os ', l_linenumber), 'organization_name', cast(null as string), "
              "'status', l_returnflag, 'registered_time', concat(date_format(l_shipdate, 'yyyy-MM-dd'), 'T23:30:00.000-01:00'), "
              "'organization_id', cast(l_suppkey as string), 'deregistered_time', cast(null as string), "
              "'last_reported_time', 'never', 'sensor_out_of_date', l_tax > 0.04, "
              "'last_contact_time', concat(date_format(l_shipdate, 'yyyy-MM-dd'), 'T08:15:30.250Z'), 'os', l_linestatus, "
              "'av_vdf_version', cast(null as string), 'av_engine', cast(null as string))")
    return e.raw("lineitem").selectExpr(
        "cast(l_suppkey as string) as inst_id", "l_linenumber - 1 as page", "case when l_tax = 0 then 504 else 200 end as status",
        f"case when l_quantity > 1 then named_struct('num_found', case when l_discount = 0 then 0L else 1L end, 'results', array({device})) end as body")


ENDPOINTS_SQL = """select inst_id, case when fetch_status = 'OK' then id end as id, case when fetch_status = 'OK' then status end as status,
  case when fetch_status = 'OK' then reg_time end as reg_time, case when fetch_status = 'OK' then last_contact_time end as last_contact_time,
  case when fetch_status = 'OK' then ood end as sensor_ood, fetch_status from (
  select cast(l_suppkey as varchar) as inst_id, concat(l_orderkey, '-', l_linenumber) as id, l_returnflag as status,
    l_shipdate + INTERVAL 1470 MINUTE as reg_time, l_shipdate + INTERVAL 29730250 MILLISECOND as last_contact_time, l_tax > 0.04 as ood,
    case when l_tax = 0 then case when l_linenumber > 1 then 'PARTIAL' else 'TIMEOUT' end
      when l_quantity <= 1 then 'WRONG_BACKEND' when l_discount = 0 then 'NO_DEPLOYMENT' else 'OK' end as fetch_status from lineitem) x
  where fetch_status <> 'OK' or last_contact_time >= TIMESTAMP '2001-01-01' - INTERVAL 31 DAY"""


def endpoints_flat(e: Estate) -> DataFrame:
    return (landed.in_contact(landed.endpoints(endpoint_replies(e)), CONTACT_AS_OF)
            .select("inst_id", "id", "status", "reg_time", "last_contact_time", "sensor_ood", "fetch_status"))


def kit_replies(e: Estate) -> DataFrame:
    build = "named_struct('hash', p_name, 'createTime', cast(p_size as bigint), 'status', p_brand)"
    other = "named_struct('hash', 'old', 'createTime', 0L, 'status', 'gone')"
    return e.raw("part").selectExpr(
        "p_type as backend", "200 as status",
        f"named_struct('publishedKits', map(p_brand, map(concat('v', cast(p_partkey as string)), array({build}, {other})))) as body")


def connector_replies(e: Estate) -> DataFrame:
    kind = "case event_type when 'view' then 'SIM' when 'click' then 'API' when 'error' then 'CUSTOM' else 'OTHER' end"
    entry = (f"named_struct('createTime', event_id, 'connectorId', cast(event_id as string), 'apiKey', 'dummy', 'lastUpdatedTime', event_id + 1, "
             f"'orgId', cast(user_id as string), 'connectorType', {kind}, 'notificationState', case when value < 30 then named_struct("
             "'lastSimNotificationKey', case when value > 5 then named_struct('eventTime', event_id * 10) end, "
             "'lastAuditLogKey', named_struct('eventTime', event_id * 100)) end, "
             "'stats', case when value > 10 then named_struct('lastReportedTime', event_id * 7) end, 'name', props, 'description', event_type)")
    return e.raw("events").selectExpr("cast(user_id as string) as inst_id", "case when value > 60 then 500 else 200 end as status",
                                      f"named_struct('entries', case when value > 50 then array() else array({entry}) end) as body")


CONNECTORS_SQL = """select cast(user_id as varchar) as inst_id, case when ok then cast(event_id as varchar) end as connector_id,
  case when ok then case event_type when 'view' then 'SIM' when 'click' then 'API' when 'error' then 'CUSTOM' else 'OTHER' end end as connector_type,
  case when ok and value < 30 then case event_type when 'view' then case when value > 5 then event_id * 10 end when 'click' then event_id * 100 end end as last_event,
  case when ok and value > 10 then event_id * 7 end as last_report, case when ok then props end as name,
  case when value > 60 then 'TIMEOUT' when value > 50 then 'EMPTY' else 'OK' end as fetch_status
  from (select *, value <= 50 as ok from events) e"""


def forwarder_replies(e: Estate) -> DataFrame:
    row = ("named_struct('id', cast(c_custkey as string), 'org_key', concat('K', cast(c_nationkey as string)), 'name', c_name, "
           "'enabled', c_acctbal > 0, 's3_bucket_name', cast(null as string), 's3_prefix', c_mktsegment, 'type', 'event', "
           "'create_time', '2023-05-06T07:08:09Z', 'update_time', cast(null as string))")
    return e.raw("customer").selectExpr(
        "cast(c_nationkey as string) as inst_id", "case c_mktsegment when 'BUILDING' then 404 when 'MACHINERY' then 500 else 200 end as status",
        f"array({row}) as body")


def dashboard_replies(e: Estate) -> DataFrame:
    counts = e.raw("lineitem").groupBy("l_suppkey").agg(*[
        F.count_if(F.expr(c)).alias(n) for n, c in DASH_CONDITIONS.items()], F.count("*").alias("n"))
    cell = lambda n: f"map('count', cast({n} as double), 'percentage', cast({n} as double) / cast(n as double))"
    return counts.selectExpr(
        "cast(l_suppkey as string) as inst_id", "200 as status",
        "named_struct('message', case when risky > 0 then 'success' else 'none' end, 'threatSummary', named_struct('ATTACKS_STOPPED', "
        f"map('RISKY_PROGRAM', {cell('risky')}, 'NON_MALWARE', {cell('nonmal')}, 'KNOWN_MALWARE', {cell('known')}))) as body")


DASH_CONDITIONS = {"risky": "l_tax > 0.07", "nonmal": "l_tax < 0.02", "known": "l_discount > 0.05"}


def _dash_sql() -> str:
    have = {"RISKY_PROGRAM": "risky", "NON_MALWARE": "nonmal", "KNOWN_MALWARE": "known"}
    cols = []
    for threat, prefix in THREAT_TYPES.items():
        n = have.get(threat)
        values = {"count": f"case when risky > 0 then {n or 0} end", "perc": f"case when risky > 0 then {f'cast({n} as double) / n' if n else '0.0'} end",
                  "perc_change": "case when risky > 0 then 0.0 end"}
        for suffix in THREAT_METRICS.values():
            cols.append(f"cast({values[suffix]} as {'bigint' if suffix == 'count' else 'double'}) as {prefix}_{suffix}")
    counts = ", ".join(f"count(*) filter (where {c}) as {n}" for n, c in DASH_CONDITIONS.items())
    return (f"select cast(l_suppkey as varchar) as inst_id, {', '.join(cols)}, case when risky > 0 then 'OK' else 'EMPTY' end as fetch_status "
            f"from (select l_suppkey, {counts}, count(*) as n from lineitem group by 1) t")


def policy_list_replies(e: Estate) -> DataFrame:
    item = "named_struct('orgId', org_id, 'id', concat(org_id, '{0}'), 'name', concat('policy {0} ', status), 'priority', '{0}', 'numDevices', licences)"
    return e.installation.selectExpr("backend as prod", "200 as status",
                                     f"named_struct('list', array({item.format('a')}, {item.format('b')})) as body")


def policy_replies(e: Estate) -> DataFrame:
    rule = "named_struct('operation', '{0}', 'action', status, 'application', named_struct('type', type, 'value', '{0}'))"
    return e.installation.selectExpr(
        "backend as prod", "200 as status",
        f"named_struct('orgId', org_id, 'id', concat('p', org_id), 'name', 'standard', 'policy', named_struct('rules', array({rule.format('RUN')}, {rule.format('NETWORK')}))) as body")


def month_texts(e: Estate) -> DataFrame:
    day = "to_date(o_orderdate) + 8120"
    spelled = (f"case o_orderstatus when 'O' then date_format({day}, 'MMM yy') when 'F' then date_format({day}, 'MMMM, yyyy') "
               "when 'P' then '' end")
    return e.raw("orders").selectExpr("o_orderkey", f"{spelled} as words").select(
        "o_orderkey", time.month_year(F.col("words")).alias("month"))


def activity_texts(e: Estate) -> DataFrame:
    rows = e.raw("events").selectExpr(
        "event_type as account",
        "case event_type when 'view' then date_format(ts, 'yyyy-MM-dd') when 'click' then date_format(ts, 'M/d/yyyy') "
        "when 'error' then date_format(ts, 'MMM d, yyyy') when 'signup' then date_format(ts, 'd MMM yyyy') else 'soon' end as activity_date")
    return warehouse.activity_dates(rows).groupBy("account", "activity_date").agg(F.count("*").alias("n"))


def props_parsed(e: Estate) -> DataFrame:
    """JSON path with a default, and cell formatting."""
    k = F.coalesce(F.get_json_object("props", "$.k").cast("bigint"), F.lit(0))
    ms = time.ntz_to_ms(F.col("ts"))
    return e.raw("events").select(
        "event_id", k.alias("k"), F.coalesce(F.get_json_object("props", "$.missing"), F.lit("none")).alias("missing"),
        text.display_cell(ms.cast("string")).alias("day"), text.display_cell(F.col("props")).alias("props"),
        text.cell_number(F.get_json_object("props", "$.k")).alias("number"),
        numbers.loose_real(F.col("event_type")).alias("junk"), numbers.loose_real(F.concat(k.cast("string"), F.lit("x"))).alias("head"))


def pages_tagged(e: Estate) -> DataFrame:
    return e.raw("pages").select("page_id", F.lit("nav").alias("tag"), "html")


def html_items(e: Estate) -> DataFrame:
    return support.html_rows(pages_tagged(e), "ul", "li", "a").select(
        "page_id", "row_no", F.array_join("cells", "|").alias("item"))


QUERIES = [
    Query("s01_roster", "S1", lambda e: e.roster, oracle("select * from roster", "roster")),
    Query("s02_org_keys", "S2", customers, oracle(CUSTOMERS_SQL, "roster")),
    Query("f18_with_org_key", "F18", lambda e: landed.with_org_key(customers(e)),
          oracle(f"select * from ({CUSTOMERS_SQL}) c where org_key <> ''", "roster")),
    Query("s03_audit_flatten", "S3 X10 F19", lambda e: landed.audit(audit_replies(e)),
          """select distinct cast(user_id as varchar) as inst_id, event_type as "user", event_id as event_time,
             regexp_replace('<b>' || event_type || '</b> set <i>' || props || '</i> ' || repeat(event_type || ' <u>on</u> ', 6), '<.*?>', '', 'g') as description from events"""),
    Query("s03_audit_criteria", "S3 F19", lambda e: landed.audit(audit_replies(e, ", 'flagged', event_id % 7 = 0, 'verbose', case when event_id % 11 > 1 then false when event_id % 11 = 1 then true end")),
          """select distinct cast(user_id as varchar) as inst_id, event_type as "user", event_id as event_time,
             regexp_replace('<b>' || event_type || '</b> set <i>' || props || '</i> ' || repeat(event_type || ' <u>on</u> ', 6), '<.*?>', '', 'g') as description
             from events where event_id % 7 <> 0 and event_id % 11 <> 1"""),
    Query("s03_audit_whole_text", "S3", lambda e: landed.audit(talk_replies(e), max_chars=None),
          """select distinct cast(conv_id as varchar) as inst_id, role as "user", turn as event_time, regexp_replace('<p>' || text || '</p>', '<.*?>', '', 'g') as description from conversations"""),
    Query("s04_endpoint_flatten", "S4 F19 X13", endpoints_flat, ENDPOINTS_SQL),
    Query("s04_duplicate_pages", "S4 K3", lambda e: keyed.one_row(e.endpoints.union(e.endpoints), ["inst_id", "id"], ["last_contact_time"]).select("inst_id", "id", "last_contact_time"),
          oracle("select inst_id, id, max(last_contact_time) as last_contact_time from endpoints group by 1, 2", "endpoints")),
    Query("s05_duplicate_replies", "S5 K3", lambda e: keyed.one_row(e.alerts.union(e.alerts), ["inst_id"]),
          oracle("select *, 'OK' as fetch_status from alerts", "alerts")),
    Query("s05_alert_facets", "S5", lambda e: e.alerts, oracle("select *, 'OK' as fetch_status from alerts", "alerts")),
    Query("f19_alert_criteria", "F19", lambda e: landed.alert_criteria(e.raw("events").selectExpr(
        "event_id", "cast(value as int) as severity", "case event_type when 'error' then 'THREAT' when 'view' then 'THREAT' else 'OTHER' end as category",
        "case when value > 20 then 'OPEN' when value > 10 then 'DISMISSED' else 'SHUT' end as workflow", "ts as create_time"), AS_OF),
          f"""select event_id, cast(trunc(value) as int) as severity, 'THREAT' as category, case when value > 20 then 'OPEN' else 'DISMISSED' end as workflow, ts as create_time
             from events where event_type in ('error', 'view') and value > 10 and trunc(value) >= 1 and ts >= {NOW} - INTERVAL 1 MONTH"""),
    Query("s06_kits", "S6", lambda e: landed.kits(kit_replies(e)),
          """select p_type as backend, p_brand as os, 'v' || p_partkey as version, p_name as hash, cast(p_size as bigint) as create_time, p_brand as status from part"""),
    Query("s07_connectors", "S7 X19", lambda e: landed.connectors(connector_replies(e)).select(
        "inst_id", "connector_id", "connector_type", "last_event", "last_report", "name", "fetch_status"), CONNECTORS_SQL),
    Query("s08_forwarders", "S8", lambda e: landed.forwarders(forwarder_replies(e)),
          """select cast(c_nationkey as varchar) as inst_id, case when ok then cast(c_custkey as varchar) end as id, case when ok then 'K' || c_nationkey end as org_key,
             case when ok then c_name end as name, case when ok then c_acctbal > 0 end as enabled, cast(null as varchar) as s3_bucket_name,
             case when ok then c_mktsegment end as s3_prefix, case when ok then 'event' end as type, case when ok then TIMESTAMP '2023-05-06 07:08:09' end as create_time,
             cast(null as timestamp) as update_time, case c_mktsegment when 'BUILDING' then 'EMPTY' when 'MACHINERY' then 'TIMEOUT' else 'OK' end as fetch_status
             from (select *, c_mktsegment not in ('BUILDING', 'MACHINERY') as ok from customer) c"""),
    Query("s09_dashboards", "S9 X19", lambda e: landed.dashboards(dashboard_replies(e)), _dash_sql()),
    Query("s10_policy_list", "S10 J23", lambda e: landed.policy_ids(policy_list_replies(e), customers(e)),
          oracle(f"""select c.inst_id, c.org_id, i.org_id || x.p as policy_id, 'policy ' || x.p || ' ' || i.status as policy_name, x.p as priority, i.licences as num_devices
             from installation i cross join (values ('a'), ('b')) x(p) join ({CUSTOMERS_SQL}) c on c.prod = i.backend and c.org_id = i.org_id""", "roster")),
    Query("s11_policy_rules", "S11 J23", lambda e: landed.rules(policy_replies(e), customers(e)),
          oracle(f"""select c.inst_id, 'p' || i.org_id as policy_id, 'standard' as rule_name, x.p as operation, i.status as action, i.type as rule_type, x.p as rule_definition
             from installation i cross join (values ('RUN'), ('NETWORK')) x(p) join ({CUSTOMERS_SQL}) c on c.prod = i.backend and c.org_id = i.org_id""", "roster")),
    Query("s12_html_rows", "S12", html_items,
          """select page_id, cast(n - 1 as int) as row_no, regexp_replace(items[n], '<.*?>', '', 'g') as item from (
             select page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1) as items, unnest(range(1, len(regexp_extract_all(html, '<li>(.*?)</li>', 1)) + 1)) as n from pages) p"""),
    Query("s13_month_year", "S13 X10", month_texts,
          """select o_orderkey, case when o_orderstatus in ('O', 'F') then cast(date_trunc('month', cast(o_orderdate as date) + 8120) as date) end as month from orders"""),
    Query("s14_activity_dates", "S14", activity_texts,
          "select event_type as account, cast(ts as date) as activity_date, count(*) as n from events where event_type <> 'purchase' group by 1, 2"),
    Query("s15_activity", "S15 F10", lambda e: warehouse.activity(e.activity_timeline, e.account, AS_OF),
          oracle("select * from cse_activity", "cse_activity")),
    Query("s16_warehouse_scan", "S16", lambda e: warehouse.read_table(e.spark, f"{e.dir}/orders.parquet", "parquet").groupBy("o_orderstatus")
          .agg(F.count("*").alias("n"), F.max("o_orderdate").alias("newest")), "select o_orderstatus, count(*) as n, max(o_orderdate) as newest from orders group by 1"),
    Query("s17_new_keys", "S17", lambda e: landed.new_keys_only(e.roster, landed.forwarders(forwarder_replies(e))),
          oracle("select * from roster r where not exists (select 1 from customer where cast(c_nationkey as varchar) = r.inst_id)", "roster")),
    Query("x15_support_level", "X15 S13", lambda e: e.version_support, oracle("select * from version_support", "version_support")),
    Query("x19_json_and_cells", "X3 X11 X18 X19", props_parsed,
          """select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, 'none' as missing, strftime(ts, '%Y-%m-%d') as day, props,
             cast(json_extract_string(props, '$.k') as double) as number, 0.0::double as junk, cast(json_extract_string(props, '$.k') as double) as head from events"""),
]
