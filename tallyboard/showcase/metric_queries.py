"""Metrics, lookups, histograms, series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.text import version_family
from ..operators import audit as a
from ..operators import endpoints as ep
from ..operators.devices import device_counts
from ..operators import histograms as h
from ..operators import lookups
from ..operators.series import activity_series, daily_activity
from . import oracle as o
from .estate import AS_OF, NOW, NOW_MS, TODAY, oracle
from .registry import Query
from .warehouse_queries import all_of

LATE = dt.datetime(2024, 5, 1)
LATE_MS = str(int(LATE.replace(tzinfo=dt.timezone.utc).timestamp() * 1000))
OS_KEYS = ["windows", "mac", "linux"]
LEVELS = ["st", "ex", "eol", "unreleased"]
FAMILIES = [f"3.{n}" for n in range(10)]
LABEL = "lower(sensor_version) || ' (' || lower(os) || ') ' || case when dl_available then '' else '(Unavailable) ' end || '(' || lower(support_level) || ')'"


def wide_sql(long: str, keys: list[str], by: str, label: str) -> str:
    cols = ", ".join(f"cast(coalesce(sum(n) filter (where {label} = '{k}'), 0) as bigint) as \"{k}\"" for k in keys)
    return f"select {by}, {cols} from ({long}) l group by {by}"


SUMMARY = """select inst_id, kind, key, count(*) as n from (
  select inst_id, 'os' as kind, lower(os) as key from live union all select inst_id, 'family', substr(sensor_version, 1, 3) from live
  union all select inst_id, 'support', lower(support_level) from live) k group by 1, 2, 3"""
TREND = f"""select {TODAY} as date, backend, version, count(*) as n from (
  select r.backend, e.sensor_version as version from live e join roster r on e.inst_id = r.inst_id
  union all select 'all', sensor_version from live) x group by 1, 2, 3"""
ARCHIVE = f"""select {TODAY} as date, inst_id, os, count(*) filter (where support_level = 'ST') as standard, count(*) filter (where support_level = 'EX') as extended,
  count(*) filter (where support_level = 'EOL') as eol, count(*) as total from recent group by 2, 3"""


SERIES = """select s.inst_id, s.bucket, count(*) filter (where e.login) as logins, count(*) filter (where e.byp) as bypass,
      case when count(*) filter (where e.byp and contains(e.description, 'all')) > 0 then 'Yes' else 'No' end as all_in_bypass,
      count(*) filter (where e.connector) as connectors from spine s left join ev e on s.inst_id = e.inst_id and s.bucket = e.bucket group by 1, 2"""


def series_oracle(now_ms: str) -> str:
    start = f"coalesce(min(a.event_time), {now_ms} - 7 * 86400000)"
    days = f"({now_ms} - start_ms) // 86400000"
    bucket = lambda day: f"case when monthly then strftime({day}, '%Y-%m') else strftime({day}, '%Y-%m-%d') end"
    return oracle(
        SERIES, "roster", "audit",
        span=f"select *, {days} as days, {days} >= 61 as monthly from (select r.inst_id, {start} as start_ms from roster r left join audit a on a.inst_id = r.inst_id group by 1) t",
        spine=f"select distinct inst_id, {bucket('cast(epoch_ms(start_ms) as date) + cast(i as int)')} as bucket from (select *, unnest(range(0, days + 2)) as i from span) u",
        ev=f"""select a.inst_id, {bucket('epoch_ms(a.event_time)')} as bucket, description, description ilike 'log%in success%' as login,
          description ilike '%bypass%' and (description ilike '%enabled%' or description ilike '%to on %') and description not ilike '%Action)' as byp,
          description ilike '%connector% log%' as connector from audit a join span s on a.inst_id = s.inst_id""")


def archive_by_month(e):
    """Deployment archive of many days: ship dates by month (input of A29)."""
    day = F.to_date(F.date_trunc("month", "last_contact_time"))
    return e.endpoints.groupBy("inst_id", day.alias("date"), "os").agg(
        F.count_if(F.col("status") == "REGISTERED").alias("standard"), F.count_if(F.col("status") == "BYPASS").alias("extended"),
        F.count_if(F.col("status") == "DEREGISTERED").alias("eol"))


def pivot_sql() -> str:
    cols = ", ".join(f"count(*) filter (where os = '{os}' and status = '{st}') as \"{os}_{name}\"" for os in ("WINDOWS", "MAC", "LINUX")
                     for st, name in (("REGISTERED", "st"), ("BYPASS", "ex"), ("DEREGISTERED", "eol")))
    return oracle(f"select inst_id, cast(date_trunc('month', last_contact_time) as date) as date, {cols} from endpoints group by 1, 2", "endpoints")


def term_hits(e):
    lines = e.forwarders.select("inst_id", F.split(F.lower("name"), "\n").alias("lines"))
    return lines.select("inst_id", F.array_join(F.array_sort(lookups.matched_terms("lines", o.TEXT_TERMS)), ", ").alias("terms"))


def releases(e):
    """Distinct releases in use: the first three numbers of a version."""
    return e.endpoints.select(F.substring_index("sensor_version", ".", 3).alias("version"), "os").distinct()


def release_levels(e, exact: bool):
    return lookups.longest_prefix(releases(e), lookups.release_lines(e.version_support), include_exact=exact, fallback="none")


def prefix_sql(exact: bool) -> str:
    return oracle(f"""select s.version, s.os, coalesce((select max_by(level, length(line)) from release_lines r
        where r.os_code = upper(substr(s.os, 1, 3)) and starts_with(s.version, r.line) and length(r.line) {'<=' if exact else '<'} length(s.version)), 'none') as support_level
      from (select distinct regexp_extract(version, '^[0-9]+[.][0-9]+[.][0-9]+') as version, os from versions) s""", "versions", "release_lines")


QUERIES = [
    Query("a01_audit_metrics", "A1 A2 A3 A4 F2 F8 F9 X4 X11", lambda e: a.audit_metrics(e.audit, AS_OF), all_of("audit_metrics")),
    Query("a03_bypass_display", "A3", lambda e: a.audit_metrics(e.audit, AS_OF).select("inst_id", a.bypass_display().alias("shown")),
          oracle("select inst_id, case when bypass_all then 'All' else cast(last_30d_bypass_count as varchar) end as shown from audit_metrics", "audit_metrics")),
    Query("a31_first_events", "A31 X9", lambda e: a.first_events(e.audit),
          oracle("select inst_id, min(event_time) as first_event from audit group by 1", "audit")),
    Query("j22_sensor_lookup", "J22 J13 J14 X16 X17 A17 F11", lambda e: e.lookup, all_of("sensor_lookup")),
    Query("j13_longest_prefix", "J13", lambda e: release_levels(e, False), prefix_sql(False)),
    Query("j13_longest_prefix_exact", "J13", lambda e: release_levels(e, True), prefix_sql(True)),
    Query("j14_downloadable", "J14", lambda e: lookups.downloadable(e.endpoints.select(F.col("sensor_version").alias("version"), "os").distinct(), e.kits),
          oracle("select version, os, dl_available from sensor_lookup", "sensor_lookup")),
    Query("a05_endpoint_metrics", "A5 A6 A7 A8 A9 F5 F7 J8 J9 X1 X2", lambda e: ep.endpoint_metrics(e.endpoints, e.licences, e.lookup), all_of("endpoint_metrics")),
    Query("a05_endpoint_counts", "A5 A6 A7 A8 F7", lambda e: ep.endpoint_counts(e.endpoints),
          oracle("""select inst_id, case when in30 and dep then os end as os, case when in30 and dep then sensor_version end as version, count(*) filter (where in30) as seen, count(*) filter (where in30 and dep) as deployed,
             count(*) filter (where in30 and dep and deployment_type = 'WORKLOAD') as workload, count(*) filter (where in30 and status = 'BYPASS') as bypass,
             count(*) filter (where other) as seen_other, count(*) filter (where other and dep and in1) as contact_1d, count(*) filter (where other and dep and in7) as contact_7d
             from endpoint_flags group by 1, 2, 3""", "endpoint_flags")),
    Query("u01_connection_names", "U1", lambda e: lookups.connection_names(e.forwarders, e.connectors),
          oracle("select inst_id, name from forwarders union select inst_id, name from connectors", "forwarders", "connectors")),
    Query("a23_integrations", "A23 J16 U1", lambda e: lookups.integrations(lookups.connection_names(e.forwarders, e.connectors)), all_of("integrations")),
    Query("a23_integrations_other_terms", "A23 J16 U1", lambda e: lookups.integrations(lookups.connection_names(e.forwarders, e.connectors), o.TEXT_TERMS),
          oracle(o.integrations_sql(o.TEXT_TERMS), "forwarders", "connectors")),
    Query("j16_terms_in_text", "J16 X10", term_hits,
          oracle("select f.inst_id, coalesce(string_agg(t.label, ', ' order by t.label), '') as terms from forwarders f left join (values "
                 + ", ".join(f"('{t}', '{t.replace('.*', '')}')" for t in o.TEXT_TERMS) + ") t(pattern, label) on regexp_matches(lower(f.name), t.pattern) group by 1", "forwarders")),
    Query("a10_sensor_versions", "A10 J9 X6 F11", lambda e: h.sensor_versions(e.endpoints, e.lookup),
          oracle(f"select inst_id, {LABEL} as label, count(*) as n from live group by 1, 2", "live")),
    Query("a11_os_versions", "A11", lambda e: h.os_versions(e.endpoints), oracle("select inst_id, lower(os_version) as label, count(*) as n from live group by 1, 2", "live")),
    Query("a11_os_versions_wide", "A11", lambda e: h.widen(h.os_versions(e.endpoints), ["windows 11", "windows 12", "mac 11", "linux 13"], ["inst_id"]),
          oracle(wide_sql("select inst_id, lower(os_version) as label, count(*) as n from live group by 1, 2", ["windows 11", "windows 12", "mac 11", "linux 13"], "inst_id", "label"), "live")),
    Query("a12_deployment_summary", "A12 J17 X5", lambda e: h.deployment_summary(e.endpoints, e.lookup), oracle(SUMMARY, "live")),
    Query("a12_deployment_summary_wide", "A12 F16", lambda e: h.widen(h.deployment_summary(e.endpoints, e.lookup), OS_KEYS + LEVELS + FAMILIES, ["inst_id"], "key"),
          oracle(wide_sql(SUMMARY, OS_KEYS + LEVELS + FAMILIES, "inst_id", "key"), "live")),
    Query("f15_zero_columns", "F15", lambda e: h.zero_columns(h.widen(h.os_versions(e.endpoints), ["windows 11", "beos 5", "mac 12"], ["inst_id"]), ["inst_id"]),
          oracle(wide_sql("select inst_id, lower(os_version) as label, count(*) as n from live group by 1, 2", ["windows 11", "mac 12"], "inst_id", "label"), "live")),
    Query("a13_deployment_archive", "A13 F8", lambda e: h.deployment_archive(e.endpoints, e.lookup, AS_OF), oracle(ARCHIVE, "recent")),
    Query("a14_deployment_trend", "A14 K11", lambda e: h.deployment_trend(e.endpoints, e.roster, AS_OF), oracle(TREND, "live", "roster")),
    Query("a14_trend_by_family", "A14 W3 A30", lambda e: h.share_of_total(
        h.deployment_trend(e.endpoints.withColumn("sensor_version", version_family(F.col("sensor_version"))), e.roster, AS_OF), ["date", "backend"]),
          oracle(f"""select *, {o.pct('n', 'sum(n) over (partition by date, backend)')} as perc from (
             select date, backend, substr(version, 1, 3) as version, cast(sum(n) as bigint) as n from ({TREND}) t group by 1, 2, 3) f""", "live", "roster")),
    Query("k11_trend_wide", "K11", lambda e: h.trend_wide(h.deployment_trend(
        e.endpoints.withColumn("sensor_version", version_family(F.col("sensor_version"))), e.roster, AS_OF), FAMILIES),
          oracle("select *, backend || strftime(date, '%Y-%m-%d') as unique_id from (" + wide_sql(
              f"select date, backend, substr(version, 1, 3) as version, n from ({TREND}) t", FAMILIES, "date, backend", "version") + ") w", "live", "roster")),
    Query("a24_version_status", "A24 J10", lambda e: h.version_status(e.endpoints, e.lookup, AS_OF),
          oracle("""select inst_id, sensor_version as version, os, dl_available, support_level, count(*) filter (where status = 'BYPASS') as bypass,
             count(*) filter (where status = 'REGISTERED') as active from recent where known is not null group by 1, 2, 3, 4, 5""", "recent")),
    Query("a25_os_status", "A25 J10", lambda e: h.os_status(e.endpoints, e.lookup, AS_OF),
          oracle("""select inst_id, os_version, count(*) filter (where status = 'BYPASS') as bypass, count(*) filter (where status = 'REGISTERED') as active,
             count(*) as total from recent where known is not null group by 1, 2""", "recent")),
    Query("a26_os_support", "A26 J9", lambda e: h.os_support(e.endpoints, e.lookup, AS_OF), oracle(f"select * exclude (date) from ({ARCHIVE}) a", "recent")),
    Query("a27_daily_series", "A27 X14 A31", lambda e: activity_series(e.audit, e.roster, AS_OF), series_oracle(NOW_MS)),
    Query("a27_monthly_series", "A27 X14", lambda e: activity_series(e.audit, e.roster, LATE), series_oracle(LATE_MS)),
    Query("a27_daily_activity", "A27", lambda e: daily_activity(e.audit),
          oracle("""select inst_id, cast(epoch_ms(event_time) as date) as day, min(event_time) as first_event, count(*) filter (where description ilike 'log%in success%') as logins,
             count(*) filter (where byp) as bypass, count(*) filter (where byp and contains(description, 'all')) as bypass_all,
             count(*) filter (where description ilike '%connector% log%') as connectors from audit_flags group by 1, 2""", "audit_flags")),
    Query("a28_signatures", "A28 F8", lambda e: h.signature_versions(e.endpoints, AS_OF),
          oracle(f"select inst_id, av_vdf_version, count(*) as n from endpoints where last_contact_time > {NOW} - INTERVAL 30 DAY and av_vdf_version is not null group by 1, 2", "endpoints")),
    Query("a29_archive_pivot", "A29", lambda e: h.archive_pivot(archive_by_month(e), ["WINDOWS", "MAC", "LINUX"]), pivot_sql()),
]

#: The same results from devices that were counted once.
_COUNTED = {
    "a05_endpoint_metrics": lambda e, d: ep.endpoint_metrics(d, e.licences, e.lookup), "a10_sensor_versions": lambda e, d: h.sensor_versions(d, e.lookup),
    "a11_os_versions": lambda e, d: h.os_versions(d), "a12_deployment_summary": lambda e, d: h.deployment_summary(d, e.lookup),
    "a13_deployment_archive": lambda e, d: h.deployment_archive(d, e.lookup, AS_OF), "a14_deployment_trend": lambda e, d: h.deployment_trend(d, e.roster, AS_OF),
    "a24_version_status": lambda e, d: h.version_status(d, e.lookup, AS_OF), "a25_os_status": lambda e, d: h.os_status(d, e.lookup, AS_OF),
    "a28_signatures": lambda e, d: h.signature_versions(d, AS_OF),
}


def _counted(make):
    return lambda e: make(e, device_counts(e.endpoints, AS_OF))


QUERIES += [Query(f"{q.name}_counted", q.covers, _counted(_COUNTED[q.name]), q.sql) for q in QUERIES if q.name in _COUNTED]
