"""Oracle SQL of the larger derived tables: warehouse facts, metrics, master and accounts."""

from __future__ import annotations

from .estate import NEEDS, NOW, NOW_MS, SQL, TODAY

_FAMILY = " or ".join(f"contains(product_family, '{f}')" for f in ("CBD", "CBTH", "CBWL", "EEDR", "Workload", "Endpoint"))

QUARTERS = [
    ("2021 Q1", "2020-02-01", "2020-04-30"), ("2021 Q2", "2020-05-01", "2020-07-30"), ("2021 Q3", "2020-07-31", "2020-10-29"),
    ("2021 Q4", "2020-10-30", "2021-01-28"), ("2022 Q1", "2021-01-29", "2021-04-29"), ("2022 Q2", "2021-04-30", "2021-07-29"),
    ("2022 Q3", "2021-07-30", "2021-10-28"), ("2022 Q4", "2021-10-29", "2022-01-27"), ("2023 Q1", "2022-01-28", "2022-04-28"),
    ("2023 Q2", "2022-04-29", "2022-07-28"), ("2023 Q3", "2022-07-29", "2022-10-27"), ("2023 Q4", "2022-10-28", "2023-01-26"),
    ("2024 Q1", "2023-01-27", "2023-04-27"), ("2024 Q2", "2023-04-28", "2023-07-27"), ("2024 Q3", "2023-07-28", "2023-10-26"),
    ("2024 Q4", "2023-10-27", "2024-01-25"), ("2025 Q1", "2024-01-26", "2024-04-25"), ("2025 Q2", "2024-04-26", "2024-07-25"),
    ("2025 Q3", "2024-07-26", "2024-10-24"), ("2025 Q4", "2024-10-25", "2025-01-23"), ("2026 Q1", "2025-01-24", "2025-04-24"),
    ("2026 Q2", "2025-04-25", "2025-07-24"), ("2026 Q3", "2025-07-25", "2025-10-23"), ("2026 Q4", "2025-10-24", "2026-01-22"),
]


def pct(n: str, d: str) -> str:
    return f"round(cast({n} as double) * 100 / nullif(cast({d} as double), 0), 2)"


def pct0(n: str, d: str) -> str:
    return f"coalesce({pct(n, d)}, 0.0)"


def total(expr: str) -> str:
    return f"cast(sum({expr}) as bigint)"


def _add(name: str, needs: list[str], sql: str) -> None:
    SQL[name], NEEDS[name] = sql, needs


_add("calendar", [], "select * from (values " + ", ".join(
    f"('{n}', DATE '{a}', DATE '{b}')" for n, a, b in QUARTERS) + ") q(label, first_day, last_day)")

_add("account_info", ["installation", "account", "users"], """select i.inst_id, a.name as account_name, a.arr, c.name as csm, m.name as csm_manager,
  e.name as cse, a.csm_role, a.gsm_score, a.gs_overall, a.gs_last_update_date, a.account_id, a.tier, a.previous_tier, a.csm_comments,
  a.gs_adoption_comments, e.email as cse_email
  from account a join installation i on a.account_id = i.account_id left join users c on a.csm_id = c.user_id
  left join users m on c.manager_id = m.user_id left join users e on a.cse_id = e.user_id""")

_add("sibling_licences", ["installation", "account"], """select i1.inst_id, max(i2.licences) as licenses_purchased, a.parent_account as account__c
  from installation i1 left join installation i2 on i1.account_id = i2.account_id left join account a on i1.account_id = a.account_id
  where i2.org_id is not null and (i2.status in ('New', 'In-Progress', 'Complete') or i2.status is null) and i2.type like '%Subscription%'
  and i2.backend <> 'None' group by 1, 3""")

_add("installation_info", ["installation"], """select inst_id, cast(created as date) as created_date,
  cast(date_diff('day', cast(created as date), half_deployed) as int) as days_to_50perc from installation""")

_add("products", ["installation", "subscription"], """select i.inst_id, string_agg(s.product_group, ', ' order by s.product_group) as products
  from installation i join (select distinct account_id, product_group from subscription) s on i.account_id = s.account_id group by 1""")

_add("renewals", ["installation", "opportunity", "calendar"], f"""select r.*, coalesce((select label from calendar where renewal_date between first_day and last_day), 'Unknown') as renewal_quar
  from (select i.inst_id, cast(sum(cast(o.amount as decimal(18,2))) as double) as acv, count(o.opp_id) as opp_ct, min(o.close_date) as renewal_date,
    string_agg(distinct o.forecast, ',' order by o.forecast) as forecast
  from opportunity o join installation i on o.account_id = i.account_id
  where o.close_date > {TODAY} and o.type like '%Renewal%' and ({_FAMILY}) group by 1) r""")

_windows = {"30d": f"created > {TODAY} - INTERVAL 30 DAY", "90d": f"created > {TODAY} - INTERVAL 90 DAY", "open": "status <> 'Closed'"}
_ours = "product_group in ('Group 0', 'Group 1')"
_add("case_counts", ["installation", "cases"], "select i.inst_id, " + ", ".join(
    f"nullif(count(*) filter (where {w}), 0) as {'open_cases' if n == 'open' else 'total_cases_' + n}, "
    f"case when count(*) filter (where {w}) > 0 then count(*) filter (where {w} and {_ours}) end as {'open_cbc_cases' if n == 'open' else 'cbc_cases_' + n}"
    for n, w in _windows.items()).replace("created", "c.created").replace("(where status", "(where c.status")
    + " from installation i join cases c on i.account_id = c.account_id where (" + _windows["90d"].replace("created", "c.created")
    + " or c.status <> 'Closed') group by 1")

_add("cta_status", ["installation", "cta"], """select i.inst_id, last_cua, cua_status, last_ta, last_wb from installation i left join (
  select account_id, max(closed_date) filter (where reason = 'Product Usage Analytics') as last_cua,
    case max(case when status in ('New', 'Work In Progress') then 1 else 0 end) filter (where reason = 'Product Usage Analytics') when 1 then 'Open' when 0 then 'Closed' end as cua_status,
    max(closed_date) filter (where reason = 'Tech Assessment') as last_ta, max(closed_date) filter (where reason = 'CSA Whiteboarding') as last_wb
  from cta where reason in ('Product Usage Analytics', 'Tech Assessment', 'CSA Whiteboarding')
  and status not in ('Closed No Action', 'Closed Unsuccessful', 'Closed Invalid') group by 1) c on i.account_id = c.account_id""")

_add("new_deployment", ["installation", "deployed_licence"], """select i.inst_id, max(l.deployed_last_day) as peak_daily_consumption,
  round(max(l.month_average)) as average_monthly_consumption from installation i join deployed_licence l on l.prodkey = i.backend || '|' || i.org_id
  join (select prodkey, max(calendarid) as c from deployed_licence group by 1) b on l.prodkey = b.prodkey and l.calendarid = b.c group by 1""")

_add("cse_activity", ["activity_timeline", "account"], f"""select a.name as account, t.activity_date from activity_timeline t left join account a on t.account_id = a.account_id
  where t.type_name = 'CSE: Activity' and t.activity_date > {NOW} - INTERVAL 1 YEAR""")

_add("sf_data", ["roster", "account_info", "sibling_licences", "installation_info", "products", "renewals", "case_counts", "cta_status"],
     """select * from roster left join account_info using (inst_id) left join sibling_licences using (inst_id) left join installation_info using (inst_id)
  left join products using (inst_id) left join renewals using (inst_id) left join case_counts using (inst_id) left join cta_status using (inst_id)""")

_add("audit_flags", ["audit"], f"""select *, event_time // 1000 > {NOW_MS} // 1000 - 30 * 86400 as in30,
  event_time >= (select max(event_time) from audit) - 2592000000 as near,
  description ilike 'log%in success%' and description not ilike 'Connector%' as login,
  description ilike 'Connector % logged in successfully' as connector,
  description ilike '%bypass%' and (description ilike '%enabled%' or description ilike '%to on %') and description not ilike '%Action)' as byp,
  description ilike '%all' as marker from audit""")

_add("audit_metrics", ["audit_flags"], f"""select *, (cast({NOW_MS} // 1000 - last_login // 1000 as bigint)) // 86400 as days_since_login from (
  select inst_id, {total("case when in30 then case when login then 1 else 0 end end")} as last_30d_login_count,
  max(case when login then event_time end) as last_login,
  {total("case when near then case when connector then 1 else 0 end end")} as last_30d_connector_count,
  {total("case when in30 then case when byp and not marker then length(description) - length(replace(description, ',', '')) + 1 else 0 end end")} as last_30d_bypass_count,
  max(case when description ilike '%Created policy%' then event_time end) as last_created_policy,
  max(case when description ilike '%Policy% was modified%' then event_time end) as last_modified_policy,
  max(case when description ilike '%Added user%' then event_time end) as last_added_user,
  bool_or(case when in30 then byp and marker end) as bypass_all
  from audit_flags group by 1) t""")

_add("endpoint_flags", ["endpoints", "sensor_lookup", "anchor"], """select e.*, l.support_level, l.dl_available, e.last_contact_time >= (select d - 30 from anchor) as in30,
  e.last_contact_time >= (select d - 1 from anchor) as in1, e.last_contact_time >= (select d - 7 from anchor) as in7,
  e.status in ('REGISTERED', 'BYPASS') as dep, e.deployment_type <> 'WORKLOAD' as other
  from endpoints e left join sensor_lookup l on e.sensor_version = l.version and e.os = l.os""")


def _n(cond: str) -> str:
    return f"count(*) filter (where {cond})"


_live = _n("in30 and dep")
_add("endpoint_metrics", ["endpoint_flags", "sf_data"], f"""select t.inst_id, deployment, case when deployment is not null then {pct0('deployment', 'licenses_purchased')} end as deployment_perc,
  workload_deployment, last_24_contact, last_7d_contact, bypass, case when bypass is not null then {pct0('bypass', 'deployment')} end as bypass_perc,
  sensor_standard_support, standard_perc, sensor_extended_support, extended_perc, sensor_eol_support, eol_perc, sensor_download_unavailable, download_unavailable_perc
  from (select inst_id, case when {_n('in30')} > 0 then {_live} end as deployment,
  nullif({_n("in30 and dep and deployment_type = 'WORKLOAD'")}, 0) as workload_deployment,
  case when {_n('other')} > 0 then {_n('other and dep and in1')} end as last_24_contact, case when {_n('other')} > 0 then {_n('other and dep and in7')} end as last_7d_contact,
  case when {_n('in30')} > 0 then {_n("in30 and status = 'BYPASS'")} end as bypass,
  {", ".join(f"case when {_live} > 0 then {_n('in30 and dep and ' + c)} end as {name}, case when {_live} > 0 then {pct(_n('in30 and dep and ' + c), _live)} end as {perc}"
             for c, name, perc in (("support_level = 'ST'", "sensor_standard_support", "standard_perc"), ("support_level = 'EX'", "sensor_extended_support", "extended_perc"),
                                   ("support_level = 'EOL'", "sensor_eol_support", "eol_perc"), ("not dl_available", "sensor_download_unavailable", "download_unavailable_perc")))}
  from endpoint_flags group by 1) t left join sf_data s on t.inst_id = s.inst_id""")

TERMS = ["arctic.*wolf", "splunk", "log.*rhythm", "q.*radar", "z.*scaler", "dmisto", "rapid.*7", "alien.*vault", "sentinel", "exabeam", "phantom", "axonius",
         "xsoar", "sumo", "elk", "elastic", "arc.*sight", "insight.*idr", "net.*skope", "trust.*wave", "proof.*point", "raytheon", "masergy"]
TEXT_TERMS = ["the.*and", "tion", "elle", "sch.*un", "verd", "q.*z", "en.*re.*on", "xyzzy"]


def integrations_sql(terms: list[str]) -> str:
    values = ", ".join(f"('{t}', '{t.replace('.*', '')}')" for t in terms)
    return f"""select n.inst_id, coalesce(string_agg(distinct t.label, ', ' order by t.label), '') as integrations
      from (select inst_id, name from forwarders union select inst_id, name from connectors) n
      left join (values {values}) t(pattern, label) on regexp_matches(lower(n.name), t.pattern) group by 1"""


_add("integrations", ["forwarders", "connectors"], integrations_sql(TERMS))
_add("last_activity", ["cse_activity", "sf_data"], """select s.inst_id, a.last_cse_timeline from sf_data s join (
  select lower(account) as account, max(activity_date) as last_cse_timeline from cse_activity where account <> '' group by 1) a on lower(s.account_name) = a.account""")

ALERTS = {"open": "open_alerts", "dismissed": "dismissed_alerts", "terminated": "terminated_alerts", "denied": "denied_alerts",
          "allow_log": "allow_and_log_alerts", "ran": "ran_alerts", "not_ran": "not_ran_alerts", "policy_applied": "policy_applied_alerts",
          "policy_not_applied": "policy_not_applied_alerts"}
_add("base_master", ["sf_data", "alerts", "new_deployment"], f"""select inst_id, s.backend as prod, s.org_id as orgid, account_name, arr, csm, csm_manager, cse, csm_role,
  gsm_score as gs_meter, gs_overall, gs_last_update_date as gs_last_updated, account_id, tier as cs_tier, previous_tier as prev_cs_tier, csm_comments, gs_adoption_comments,
  cse_email, licenses_purchased as licenses, account__c, created_date, days_to_50perc, products, acv, opp_ct as opportunity_ct, forecast, renewal_date as next_renewal,
  renewal_quar as next_renewal_qt, total_cases_30d, cbc_cases_30d, open_cases, open_cbc_cases, last_cua as last_cua_cta, cua_status, last_ta, last_wb,
  total_cases_90d, cbc_cases_90d, {", ".join(f"a.{o} as {n}" for o, n in ALERTS.items())}, peak_daily_consumption, average_monthly_consumption
  from sf_data s left join alerts a using (inst_id) left join new_deployment using (inst_id)""")
_add("metrics", ["base_master", "audit_metrics", "integrations", "endpoint_metrics", "last_activity"], """select * from base_master left join audit_metrics using (inst_id)
  left join integrations using (inst_id) left join endpoint_metrics using (inst_id) left join last_activity using (inst_id)""")

_ratio = "cast(open_alerts + dismissed_alerts as double) / nullif(deployment, 0)"


def _older(days: int, *cols: str) -> str:
    return " and ".join(f"{c} < {NOW_MS} - {days * 86_400_000}" for c in cols)


RULES = [
    ("> 7 days since login", 1, "days_since_login > 7"), ("> 15 days since login", 2, "days_since_login > 15"),
    ("> 30 days since login", 2, "days_since_login > 30"), (">5% in Bypass", 2, "bypass_perc >= 5"),
    (">10% in Bypass", 3, "bypass_perc >= 10"), (">20% in Bypass", 4, "bypass_perc >= 20"), (">25 in Bypass", 1, "bypass >= 25"),
    (">50 in Bypass", 1, "bypass >= 50"), ("> 10 bypass use last 30d", 2, "(last_30d_bypass_count > 10 or bypass_all)"),
    (">50 in EOL", 1, "sensor_eol_support >= 50"), (">10% in EOL", 1, "eol_perc >= 10"), (">25% in EOL", 2, "eol_perc >= 25"),
    (">10k alerts open", 1, "open_alerts >= 10000"), (">=3 alerts per endpoint", 2, f"{_ratio} >= 3.0"),
    ("Alert count too low for number of endpoints", 2, f"{_ratio} < 0.33"), ("Deployment < 50%", 2, "deployment_perc <= 50"),
    ("Deployment < 75%", 1, "deployment_perc <= 75"), ("Deployment = 0", 10, "deployment = 0"),
    ("no policy add/mod in 90d", 1, _older(90, "last_created_policy", "last_modified_policy")),
    ("no policy add/mod in 180d", 1, _older(180, "last_created_policy", "last_modified_policy")),
    ("no user add in 90d", 1, _older(90, "last_added_user")),
    (">10% decrease in deployment counts", 3, "cast((previous_deployment - deployment) * 100 as double) / nullif(previous_deployment, 0) >= 10"),
    (">2 cbc cases in 30d", 1, "cbc_cases_30d >= 3"), (">5 open cbc cases", 1, "open_cbc_cases > 5"),
    ("0 CBC cases opened in 90d", 1, "cbc_cases_90d = 0"),
]


def scored(source: str) -> str:
    names = ", ".join(f"case when {c} then '{n}' end" for n, _, c in RULES)
    points = " + ".join(f"case when {c} then {s} else 0 end" for _, s, c in RULES)
    return f"""select *, case when count_of_violations <= 3 then 'Green' when count_of_violations <= 9 then 'Yellow' else 'Red' end as cua_brag
      from (select *, concat_ws(', ', {names}) as violations_triggered, cast({points} as int) as count_of_violations from {source}) sc"""


_add("first_metrics", ["metrics"], "select *, cast(null as bigint) as previous_deployment from metrics")
_add("master", ["first_metrics"], f"select * exclude (previous_deployment), 'False' as brag_decrease from ({scored('first_metrics')}) m")

_MAX = ["csm", "csm_manager", "cse", "csm_role", "cs_tier", "prev_cs_tier", "csm_comments", "gs_adoption_comments", "arr", "acv", "opportunity_ct", "forecast", "products",
        "next_renewal", "next_renewal_qt", "gs_meter", "gs_overall", "gs_last_updated", "last_cua_cta", "cua_status", "last_ta", "last_wb", "last_cse_timeline", "last_login",
        "created_date", "days_to_50perc", "licenses", "total_cases_30d", "cbc_cases_30d", "open_cases", "open_cbc_cases", "prod", "account_id"]
_MIN = ["days_since_login", "last_added_user", "last_created_policy", "last_modified_policy", "cbc_cases_90d"]
_SUM = ["last_30d_login_count", "last_30d_connector_count", "deployment", "last_24_contact", "last_7d_contact", "workload_deployment", "bypass", "last_30d_bypass_count",
        "sensor_download_unavailable", "sensor_standard_support", "sensor_extended_support", "sensor_eol_support", *ALERTS.values(), "peak_daily_consumption"]
_RATIO = {"bypass_perc": "bypass", "download_unavailable_perc": "sensor_download_unavailable", "standard_perc": "sensor_standard_support",
          "extended_perc": "sensor_extended_support", "eol_perc": "sensor_eol_support"}
_add("account_terms", ["master"], "select account_name, unnest(string_split(integrations, ', ')) as term from master where account_name is not null and integrations <> ''")
_add("rollup", ["master", "account_terms"], "select account_name, " + ", ".join(
    [f"max({c}) as {c}" for c in _MAX] + [f"min({c}) as {c}" for c in _MIN] + [f"{total(c)} as {c}" for c in _SUM]
    + [f"{pct('sum(' + n + ')', 'sum(deployment)')} as {c}" for c, n in _RATIO.items()]
    + [f"{pct('sum(deployment)', 'max(licenses)')} as deployment_perc", "bool_or(bypass_all) as bypass_all",
       "sum(average_monthly_consumption) / count(inst_id) as average_monthly_consumption"]
    + ["(select string_agg(distinct t.term, ', ' order by t.term) from account_terms t where t.account_name = m.account_name) as integrations", "count(inst_id) as members"])
    + " from master m where account_name is not null group by 1")
_add("rollup_first", ["rollup"], "select *, cast(null as bigint) as previous_deployment from rollup")
_add("account_master", ["rollup_first"], f"select * exclude (previous_deployment), 'NA' as brag_decrease from ({scored('rollup_first')}) m")
