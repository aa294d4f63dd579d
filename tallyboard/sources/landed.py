"""Flatteners: landed JSON replies -> typed tables (S2-S11), and loading rules around them.

Each flattener works row by row on its reply (explode, no shuffle). A failed or
empty fetch gives one row with a ``fetch_status`` and a NULL payload, so the
payload columns keep their types.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.text import strip_tags
from ..functions.time import as_of_ntz, iso_utc
from ..functions.values import ALERT_COUNTERS, THREAT_METRICS, THREAT_TYPES
from ..schemas import LANDED

OK, TIMEOUT, WRONG_BACKEND, EMPTY = "OK", "TIMEOUT", "WRONG_BACKEND", "EMPTY"
NO_DEPLOYMENT, PARTIAL = "NO_DEPLOYMENT", "PARTIAL"


def read_feed(spark: SparkSession, feed: str, path: str) -> DataFrame:
    """All landed files of one feed, read with its declared schema (no inference pass)."""
    return spark.read.schema(LANDED[feed]).json(path)


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, on whatever store the path names."""
    try:
        return bool(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").head(1))
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def _no_reply() -> Column:
    return F.col("status").isNull() | (F.col("status") >= 400)


def customers(roster: DataFrame, orgs: DataFrame) -> DataFrame:
    """Roster rows with their organisation key, '' where the lookup failed."""
    keys = (orgs.filter(F.col("status") == 200)
            .groupBy("inst_id").agg(F.max("body.organization.orgKey").alias("org_key")))
    return (roster.join(keys, "inst_id", "left")
            .select("inst_id", F.col("backend").alias("prod"), "org_id",
                    F.coalesce("org_key", F.lit("")).alias("org_key")))


def with_org_key(customers: DataFrame) -> DataFrame:
    """Only customers whose organisation key is known."""
    return customers.filter(F.col("org_key") != "")


def new_keys_only(roster: DataFrame, loaded: DataFrame, key: str = "inst_id") -> DataFrame:
    """Roster rows that have nothing loaded yet."""
    return roster.join(loaded.select(key), key, "left_anti")


def audit(replies: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Audit rows of all keyword searches, neither flagged nor verbose, each event once.

    Events are told apart by their whole descriptions, tags removed. A cut to the
    first ``max_chars`` characters, where one is wanted, comes last.
    """
    entry = replies.select("inst_id", F.explode("body.entries").alias("e"))
    events = audit_criteria(entry).select(
        "inst_id", F.col("e.loginName").alias("user"), F.col("e.eventTime").alias("event_time"),
        strip_tags(F.col("e.description")).alias("description")).dropDuplicates()
    return events if max_chars is None else events.withColumn("description", F.substring("description", 1, max_chars))


def audit_criteria(entries: DataFrame) -> DataFrame:
    """Entries that are neither flagged nor verbose (F19); a reply that does not say counts as neither."""
    have = entries.schema["e"].dataType.fieldNames()
    marks = [F.coalesce(F.col(f"e.{m}"), F.lit(False)) for m in ("flagged", "verbose") if m in have]
    return reduce(lambda df, mark: df.filter(~mark), marks, entries)


_ENDPOINT_TEXT = {
    "id": "id", "sensor_version": "sensor_version", "deployment_type": "deployment_type",
    "os_version": "os_version", "organization_name": "org_name", "status": "status",
    "organization_id": "org_id", "sensor_out_of_date": "sensor_ood", "os": "os",
    "av_vdf_version": "av_vdf_version", "av_engine": "av_engine",
}
_ENDPOINT_TIME = {
    "registered_time": "reg_time", "deregistered_time": "dereg_time",
    "last_reported_time": "last_reported_time", "last_contact_time": "last_contact_time",
}


def endpoints(replies: DataFrame) -> DataFrame:
    """One row per device over all reply pages.

    A failed first page is a time-out, a failed later page leaves the rows of the
    pages before it plus one PARTIAL row.
    """
    status = (F.when(_no_reply(), F.when(F.col("page") > 0, PARTIAL).otherwise(TIMEOUT))
              .when(F.col("body").isNull() | F.col("body.num_found").isNull(), WRONG_BACKEND)
              .when(F.col("body.num_found") == 0, NO_DEPLOYMENT)
              .otherwise(OK))
    opened = (replies.withColumn("fetch_status", status)
              .select("inst_id", "fetch_status",
                      F.explode_outer(F.when(F.col("fetch_status") == OK, F.col("body.results"))).alias("d"))
              .filter((F.col("fetch_status") != OK) | F.col("d").isNotNull()))
    text = [F.col(f"d.{raw}").alias(name) for raw, name in _ENDPOINT_TEXT.items()]
    time = [(F.col(f"d.{raw}") if _is_time(replies, raw) else iso_utc(F.col(f"d.{raw}"))).alias(name)
            for raw, name in _ENDPOINT_TIME.items()]
    return opened.select("inst_id", *text, *time, "fetch_status")


def _is_time(replies: DataFrame, field: str) -> bool:
    results = replies.schema["body"].dataType["results"].dataType.elementType
    return results[field].dataType.typeName() == "timestamp_ntz"


#: Devices that a page of the source holds.
PAGE_ROWS = 10_000


def pages(replies: DataFrame) -> DataFrame:
    """``inst_id, page, num_found`` of every page that was answered."""
    answered = replies.filter(~_no_reply() & F.col("body.num_found").isNotNull())
    return answered.select("inst_id", F.coalesce("page", F.lit(0)).cast("int").alias("page"), F.col("body.num_found").cast("bigint").alias("num_found"))


def page_gaps(seen: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """``inst_id, first_page, last_page, expected_pages`` of every run of pages that never came.

    As many pages are expected as the largest ``num_found`` of the installation
    fills. Pages are made unique before they are sorted, so a window holds one
    row for ``page_rows`` devices.
    """
    unique = seen.groupBy("inst_id", "page").agg(F.max("num_found").alias("num_found"))
    mine = Window.partitionBy("inst_id")
    ordered = mine.orderBy("page")
    placed = unique.select(
        "inst_id", "page", F.ceil(F.max("num_found").over(mine) / page_rows).cast("int").alias("expected_pages"),
        F.lag("page").over(ordered).alias("_before"), F.lead("page").over(ordered).alias("_after"))
    behind = F.struct((F.col("page") + 1).alias("first_page"), (F.least(F.coalesce("_after", "expected_pages"), "expected_pages") - 1).alias("last_page"))
    ahead = F.when(F.col("_before").isNull(), F.struct(F.lit(0).alias("first_page"), (F.least("page", "expected_pages") - 1).alias("last_page")))
    gaps = placed.select("inst_id", "expected_pages", F.explode(F.array(ahead, behind)).alias("g")).filter("g.first_page <= g.last_page")
    return gaps.select("inst_id", "g.first_page", "g.last_page", "expected_pages")


def with_partial(endpoints: DataFrame, gaps: DataFrame) -> DataFrame:
    """The devices and one PARTIAL row for each installation some of whose pages never came."""
    marks = gaps.select("inst_id").distinct().withColumn("fetch_status", F.lit(PARTIAL))
    return endpoints.unionByName(marks, allowMissingColumns=True)


def in_contact(endpoints: DataFrame, as_of: dt.datetime, days: int = 31) -> DataFrame:
    """Devices the source would return: in contact within ``days`` (F19); status rows stay."""
    recent = F.col("last_contact_time") >= as_of_ntz(as_of) - F.expr(f"INTERVAL {days} DAYS")
    return endpoints.filter((F.col("fetch_status") != OK) | recent)


def alert_criteria(alerts: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Alerts the counters are about: threats of severity 1 or more, open or dismissed, last month."""
    since = as_of_ntz(as_of) - F.expr("INTERVAL 1 MONTH")
    return alerts.filter((F.col("severity") >= 1) & (F.col("category") == "THREAT")
                         & F.col("workflow").isin("OPEN", "DISMISSED") & (F.col("create_time") >= since))


def alerts(replies: DataFrame) -> DataFrame:
    """Facet arrays to nine counters, 0 where a facet value is absent.

    The facets are folded inside their own row, so no shuffle is needed.
    """
    status = (F.when(_no_reply(), TIMEOUT)
              .when(F.col("body.results").isNull(), WRONG_BACKEND).otherwise(OK))
    # The last total of a facet value, as the value may be listed twice.
    counters = [
        f"""case when fetch_status = 'OK' then coalesce(try_element_at(transform(filter(
            flatten(transform(filter(body.results, f -> f.field = '{field}'), f -> f.values)), v -> v.id = '{value}'), v -> v.total), -1), 0) end as {name}"""
        for field, value, name in ALERT_COUNTERS]
    return replies.withColumn("fetch_status", status).selectExpr("inst_id", *counters, "fetch_status")


def kits(replies: DataFrame) -> DataFrame:
    """Published kits per backend, platform and version: the first build listed."""
    return (replies.select("backend", F.explode("body.publishedKits").alias("os", "versions"))
            .select("backend", "os", F.explode("versions").alias("version", "builds"))
            .withColumn("b", F.get("builds", F.lit(0)))
            .select("backend", "os", "version", "b.hash", F.col("b.createTime").alias("create_time"), "b.status"))


def connectors(replies: DataFrame) -> DataFrame:
    """Connector rows; where the last event is found depends on the connector type."""
    status = (F.when(_no_reply(), TIMEOUT)
              .when(F.size(F.coalesce("body.entries", F.array())) == 0, EMPTY).otherwise(OK))
    last_event = (F.when(F.col("c.connectorType") == "SIM", F.col("c.notificationState.lastSimNotificationKey.eventTime"))
                  .when(F.col("c.connectorType") == "API", F.col("c.notificationState.lastAuditLogKey.eventTime")))
    return (replies.withColumn("fetch_status", status)
            .select("inst_id", "fetch_status",
                    F.explode_outer(F.when(F.col("fetch_status") == OK, F.col("body.entries"))).alias("c"))
            .select("inst_id", F.col("c.createTime").alias("create_time"), F.col("c.connectorId").alias("connector_id"),
                    F.col("c.apiKey").alias("api_key"), F.col("c.lastUpdatedTime").alias("last_updated"),
                    F.col("c.orgId").alias("org_id"), F.col("c.connectorType").alias("connector_type"),
                    last_event.alias("last_event"), F.col("c.stats.lastReportedTime").alias("last_report"),
                    F.col("c.name").alias("name"), F.col("c.description").alias("description"), "fetch_status"))


def forwarders(replies: DataFrame) -> DataFrame:
    """Forwarder rows: the named fields only, NULL where missing."""
    status = (F.when(F.col("status") == 404, EMPTY).when(_no_reply(), TIMEOUT).otherwise(OK))
    plain = ["id", "org_key", "name", "enabled", "s3_bucket_name", "s3_prefix", "type"]
    return (replies.withColumn("fetch_status", status)
            .select("inst_id", "fetch_status",
                    F.explode_outer(F.when(F.col("fetch_status") == OK, F.col("body"))).alias("f"))
            .filter((F.col("fetch_status") != OK) | F.col("f").isNotNull())
            .select("inst_id", *[F.col(f"f.{c}").alias(c) for c in plain],
                    iso_utc(F.col("f.create_time")).alias("create_time"),
                    iso_utc(F.col("f.update_time")).alias("update_time"), "fetch_status"))


def dashboards(replies: DataFrame) -> DataFrame:
    """Stopped attacks: five threat types x three metrics, 0 where absent."""
    status = (F.when(_no_reply(), TIMEOUT).when(F.col("body.message") != "success", EMPTY).otherwise(OK))
    cells = [
        F.when(F.col("fetch_status") == OK,
               F.coalesce(F.col("body.threatSummary.ATTACKS_STOPPED")[threat][metric], F.lit(0.0)))
        .cast("bigint" if metric == "count" else "double").alias(f"{prefix}_{suffix}")
        for threat, prefix in THREAT_TYPES.items() for metric, suffix in THREAT_METRICS.items()
    ]
    return replies.withColumn("fetch_status", status).select("inst_id", *cells, "fetch_status")


def policy_ids(replies: DataFrame, customers: DataFrame) -> DataFrame:
    """Policies of each organisation (S10), keyed by installation through backend + org id."""
    rows = (replies.select("prod", F.explode("body.list").alias("p"))
            .select("prod", F.col("p.orgId").alias("org_id"), F.col("p.id").alias("policy_id"),
                    F.col("p.name").alias("policy_name"), F.col("p.priority").alias("priority"),
                    F.col("p.numDevices").alias("num_devices")))
    return _by_installation(rows, customers).select("inst_id", "org_id", "policy_id", "policy_name", "priority", "num_devices")


def rules(replies: DataFrame, customers: DataFrame) -> DataFrame:
    """Rules of each policy (S11), keyed by installation through backend + org id."""
    rows = (replies.select("prod", F.col("body.orgId").alias("org_id"), F.col("body.id").alias("policy_id"),
                           F.col("body.name").alias("rule_name"), F.explode("body.policy.rules").alias("r"))
            .select("prod", "org_id", "policy_id", "rule_name", F.col("r.operation").alias("operation"),
                    F.col("r.action").alias("action"), F.col("r.application.type").alias("rule_type"),
                    F.col("r.application.value").alias("rule_definition")))
    return _by_installation(rows, customers).select(
        "inst_id", "policy_id", "rule_name", "operation", "action", "rule_type", "rule_definition")


def _by_installation(rows: DataFrame, customers: DataFrame) -> DataFrame:
    owner = customers.groupBy("prod", "org_id").agg(F.min("inst_id").alias("inst_id"))
    return rows.join(owner, ["prod", "org_id"])
