"""Fixed values.

These must equal the values the data and its readers use, so they are written
out plainly. Nothing here is logic.
"""

from __future__ import annotations

# Endpoint states that count as deployed.
DEPLOYED_STATUSES = ["REGISTERED", "BYPASS"]

# Keyword searches whose results make up the audit table.

# Case-insensitive patterns that classify audit events.
LOGIN = "log%in success%"
CONNECTOR_PREFIX = "Connector%"
CONNECTOR_LOGIN = "Connector % logged in successfully"
CONNECTOR_SERIES = "%connector% log%"
POLICY_CREATED = "%Created policy%"
POLICY_MODIFIED = "%Policy% was modified%"
USER_ADDED = "%Added user%"
BYPASS = "%bypass%"
BYPASS_ON = ["%enabled%", "%to on %"]
BYPASS_NOT = "%Action)"
BYPASS_ALL = "%all"

# Alert facets as (facet field, value id, counter).
ALERT_COUNTERS = [
    ("workflow", "OPEN", "open"),
    ("workflow", "DISMISSED", "dismissed"),
    ("sensor_action", "TERMINATE", "terminated"),
    ("sensor_action", "DENY", "denied"),
    ("sensor_action", "ALLOW_AND_LOG", "allow_log"),
    ("run_state", "RAN", "ran"),
    ("run_state", "DID_NOT_RUN", "not_ran"),
    ("policy_applied", "APPLIED", "policy_applied"),
    ("policy_applied", "NOT_APPLIED", "policy_not_applied"),
]

# Dashboard threat types and metrics, with our column prefixes and suffixes.
THREAT_TYPES = {
    "RISKY_PROGRAM": "pup",
    "NON_MALWARE": "non_malware",
    "UNKNOWN": "unknown",
    "NEW_MALWARE": "sus_malware",
    "KNOWN_MALWARE": "known_malware",
}
THREAT_METRICS = {"count": "count", "percentage": "perc", "percentageChange": "perc_change"}

# Integration name patterns; the label is the pattern without ".*".
INTEGRATION_TERMS = [
    "arctic.*wolf", "splunk", "log.*rhythm", "q.*radar", "z.*scaler", "dmisto", "rapid.*7",
    "alien.*vault", "sentinel", "exabeam", "phantom", "axonius", "xsoar", "sumo", "elk",
    "elastic", "arc.*sight", "insight.*idr", "net.*skope", "trust.*wave", "proof.*point",
    "raytheon", "masergy",
]

# First day of each fiscal quarter, and the last day of the calendar.
FISCAL_QUARTERS = [
    ("2021 Q1", "2020-02-01"), ("2021 Q2", "2020-05-01"), ("2021 Q3", "2020-07-31"), ("2021 Q4", "2020-10-30"),
    ("2022 Q1", "2021-01-29"), ("2022 Q2", "2021-04-30"), ("2022 Q3", "2021-07-30"), ("2022 Q4", "2021-10-29"),
    ("2023 Q1", "2022-01-28"), ("2023 Q2", "2022-04-29"), ("2023 Q3", "2022-07-29"), ("2023 Q4", "2022-10-28"),
    ("2024 Q1", "2023-01-27"), ("2024 Q2", "2023-04-28"), ("2024 Q3", "2023-07-28"), ("2024 Q4", "2023-10-27"),
    ("2025 Q1", "2024-01-26"), ("2025 Q2", "2024-04-26"), ("2025 Q3", "2024-07-26"), ("2025 Q4", "2024-10-25"),
    ("2026 Q1", "2025-01-24"), ("2026 Q2", "2025-04-25"), ("2026 Q3", "2025-07-25"), ("2026 Q4", "2025-10-24"),
]
FISCAL_CALENDAR_END = "2026-01-22"

# Warehouse filters.
LICENCE_STATUSES = ["New", "In-Progress", "Complete"]
RENEWAL_FAMILIES = ["CBD", "CBTH", "CBWL", "EEDR", "Workload", "Endpoint"]
CTA_OPEN = ["New", "Work In Progress"]
CTA_EXCLUDED = ["Closed No Action", "Closed Unsuccessful", "Closed Invalid"]
CTA_TYPES = {
    "Product Usage Analytics": "cua",
    "Tech Assessment": "ta",
    "CSA Whiteboarding": "wb",
}
CSE_ACTIVITY = "CSE: Activity"

# Versions whose published support level is wrong, as (os, version pattern, level).
SUPPORT_OVERRIDES = [("MAC", "3.7.3%", "ST"), ("MAC", "3.7.4%", "ST")]

# Fixed value: whole numbers above this are epoch milliseconds.
EPOCH_MS_FROM = 612272122559
