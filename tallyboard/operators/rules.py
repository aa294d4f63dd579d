"""The scorecard: rules as data, evaluated in one projection."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.time import DAY_MS, as_of_ms


@dataclass(frozen=True)
class Rule:
    """A predicate in SQL over the metric columns; ``{now}`` is ``as_of`` in epoch ms, ``{day}`` a day in ms."""

    name: str
    score: int
    fires: str


_ALERTS_PER_ENDPOINT = "try_divide(cast(open_alerts + dismissed_alerts as double), cast(deployment as double))"
_DECREASE = "try_divide(cast((previous_deployment - deployment) * 100 as double), cast(previous_deployment as double))"
_POLICY_OLDER = "last_created_policy < {{now}} - {days} * {{day}} and last_modified_policy < {{now}} - {days} * {{day}}"

# Names, scores and limits, in the order they are reported.
RULES = [
    Rule("> 7 days since login", 1, "days_since_login > 7"),
    Rule("> 15 days since login", 2, "days_since_login > 15"),
    Rule("> 30 days since login", 2, "days_since_login > 30"),
    Rule(">5% in Bypass", 2, "bypass_perc >= 5"),
    Rule(">10% in Bypass", 3, "bypass_perc >= 10"),
    Rule(">20% in Bypass", 4, "bypass_perc >= 20"),
    Rule(">25 in Bypass", 1, "bypass >= 25"),
    Rule(">50 in Bypass", 1, "bypass >= 50"),
    Rule("> 10 bypass use last 30d", 2, "last_30d_bypass_count > 10 or bypass_all"),
    Rule(">50 in EOL", 1, "sensor_eol_support >= 50"),
    Rule(">10% in EOL", 1, "eol_perc >= 10"),
    Rule(">25% in EOL", 2, "eol_perc >= 25"),
    Rule(">10k alerts open", 1, "open_alerts >= 10000"),
    Rule(">=3 alerts per endpoint", 2, f"{_ALERTS_PER_ENDPOINT} >= 3.0D"),
    Rule("Alert count too low for number of endpoints", 2, f"{_ALERTS_PER_ENDPOINT} < 0.33D"),
    Rule("Deployment < 50%", 2, "deployment_perc <= 50"),
    Rule("Deployment < 75%", 1, "deployment_perc <= 75"),
    Rule("Deployment = 0", 10, "deployment = 0"),
    Rule("no policy add/mod in 90d", 1, _POLICY_OLDER.format(days=90)),
    Rule("no policy add/mod in 180d", 1, _POLICY_OLDER.format(days=180)),
    Rule("no user add in 90d", 1, "last_added_user < {now} - 90 * {day}"),
    Rule(">10% decrease in deployment counts", 3, f"{_DECREASE} >= 10"),
    Rule(">2 cbc cases in 30d", 1, "cbc_cases_30d >= 3"),
    Rule(">5 open cbc cases", 1, "open_cbc_cases > 5"),
    Rule("0 CBC cases opened in 90d", 1, "cbc_cases_90d = 0"),
]

INPUTS = [
    "days_since_login", "bypass_perc", "bypass", "last_30d_bypass_count", "bypass_all", "sensor_eol_support", "eol_perc",
    "open_alerts", "dismissed_alerts", "deployment", "deployment_perc", "last_created_policy", "last_modified_policy",
    "last_added_user", "previous_deployment", "cbc_cases_30d", "open_cbc_cases", "cbc_cases_90d",
]


def band(score: Column) -> Column:
    """Colour of a score (B1)."""
    return F.when(score <= 3, "Green").when(score <= 9, "Yellow").otherwise("Red")


def score(metrics: DataFrame, as_of: dt.datetime, rules: list[Rule] = RULES) -> DataFrame:
    """Fired rule names, total score and band for every row (B2), whatever the grain.

    An unknown input (NULL) fires nothing. The rules are columns of one projection:
    no join and no shuffle.
    """
    missing = [c for c in INPUTS if c not in metrics.columns]
    if missing and rules is RULES:
        raise ValueError(f"metrics lack {missing}")
    scale = {"now": f"{as_of_ms(as_of)}L", "day": f"{DAY_MS}L"}
    each = [f"case when {r.fires.format(**scale)} then struct('{r.name}' as name, {r.score} as score) end" for r in rules]
    return (metrics.withColumn("_fired", F.expr(f"array_compact(array({', '.join(each)}))"))
            .selectExpr("*", "array_join(_fired.name, ', ') as violations_triggered",
                        "aggregate(_fired.score, 0, (sum, one) -> sum + one) as count_of_violations")
            .withColumn("cua_brag", band(F.col("count_of_violations")))
            .drop("_fired"))


# How far down a band is.
BAND_RANK = {"Green": 0, "Yellow": 1, "Red": 2}


def band_rank(column: Column) -> Column:
    out = F.lit(None).cast("int")
    for name, rank in BAND_RANK.items():
        out = F.when(F.lower(column) == name.lower(), rank).otherwise(out)
    return out


def declined(now: Column, before: Column) -> Column:
    """``True`` when the band got worse, else ``False``; NULL without an earlier band."""
    return F.when(before.isNotNull(), F.when(band_rank(now) > band_rank(before), "True").otherwise("False"))
