import pytest

from estate_helpers import AS_OF, ms, one, rows
from tallyboard.operators import rules as r

DDL = ("k string, days_since_login bigint, bypass_perc double, bypass bigint, last_30d_bypass_count bigint, bypass_all boolean, "
       "sensor_eol_support bigint, eol_perc double, open_alerts bigint, dismissed_alerts bigint, deployment bigint, deployment_perc double, "
       "last_created_policy bigint, last_modified_policy bigint, last_added_user bigint, previous_deployment bigint, "
       "cbc_cases_30d bigint, open_cbc_cases bigint, cbc_cases_90d bigint")
DAY = 86_400_000
NOW = ms(2024, 1, 31, 12)


def fired(table, **metrics):
    got = one(r.score(table(DDL, {"k": "x", **metrics}), AS_OF), k="x")
    return [n for n in got["violations_triggered"].split(", ") if n], got["count_of_violations"], got["cua_brag"]


CASES = [
    ("> 7 days since login", {"days_since_login": 8}, {"days_since_login": 7}),
    ("> 15 days since login", {"days_since_login": 16}, {"days_since_login": 15}),
    ("> 30 days since login", {"days_since_login": 31}, {"days_since_login": 30}),
    (">5% in Bypass", {"bypass_perc": 5.0}, {"bypass_perc": 4.99}),
    (">10% in Bypass", {"bypass_perc": 10.0}, {"bypass_perc": 9.99}),
    (">20% in Bypass", {"bypass_perc": 20.0}, {"bypass_perc": 19.99}),
    (">25 in Bypass", {"bypass": 25}, {"bypass": 24}),
    (">50 in Bypass", {"bypass": 50}, {"bypass": 49}),
    ("> 10 bypass use last 30d", {"last_30d_bypass_count": 11}, {"last_30d_bypass_count": 10}),
    ("> 10 bypass use last 30d", {"bypass_all": True}, {"bypass_all": False}),
    (">50 in EOL", {"sensor_eol_support": 50}, {"sensor_eol_support": 49}),
    (">10% in EOL", {"eol_perc": 10.0}, {"eol_perc": 9.99}),
    (">25% in EOL", {"eol_perc": 25.0}, {"eol_perc": 24.99}),
    (">10k alerts open", {"open_alerts": 10_000}, {"open_alerts": 9_999}),
    (">=3 alerts per endpoint", {"open_alerts": 2, "dismissed_alerts": 1, "deployment": 1}, {"open_alerts": 1, "dismissed_alerts": 1, "deployment": 1}),
    (">=3 alerts per endpoint", {"open_alerts": 3, "dismissed_alerts": 0, "deployment": 1}, {"open_alerts": 3, "dismissed_alerts": 0, "deployment": 0}),
    ("Alert count too low for number of endpoints", {"open_alerts": 32, "dismissed_alerts": 0, "deployment": 100}, {"open_alerts": 33, "dismissed_alerts": 0, "deployment": 100}),
    ("Deployment < 50%", {"deployment_perc": 50.0}, {"deployment_perc": 50.01}),
    ("Deployment < 75%", {"deployment_perc": 75.0}, {"deployment_perc": 75.01}),
    ("Deployment = 0", {"deployment": 0}, {"deployment": 1}),
    ("no policy add/mod in 90d", {"last_created_policy": NOW - 90 * DAY - 1, "last_modified_policy": NOW - 91 * DAY},
     {"last_created_policy": NOW - 90 * DAY, "last_modified_policy": NOW - 91 * DAY}),
    ("no policy add/mod in 180d", {"last_created_policy": NOW - 181 * DAY, "last_modified_policy": NOW - 181 * DAY},
     {"last_created_policy": NOW - 181 * DAY}),
    ("no user add in 90d", {"last_added_user": NOW - 90 * DAY - 1}, {"last_added_user": NOW - 90 * DAY}),
    (">10% decrease in deployment counts", {"previous_deployment": 100, "deployment": 90}, {"previous_deployment": 10_000, "deployment": 9_001}),
    (">10% decrease in deployment counts", {"previous_deployment": 100, "deployment": 0}, {"previous_deployment": 0, "deployment": 0}),
    (">2 cbc cases in 30d", {"cbc_cases_30d": 10}, {"cbc_cases_30d": 2}),
    (">5 open cbc cases", {"open_cbc_cases": 6}, {"open_cbc_cases": 5}),
    ("0 CBC cases opened in 90d", {"cbc_cases_90d": 0}, {"cbc_cases_90d": None}),
]


def test_every_rule_at_its_limit(table):
    data = [{"k": f"{i}{side}", **m} for i, (_, yes, no) in enumerate(CASES) for side, m in (("y", yes), ("n", no))]
    got = {row.k: row.violations_triggered.split(", ") for row in r.score(table(DDL, *data), AS_OF).collect()}
    for i, (name, _, _) in enumerate(CASES):
        assert name in got[f"{i}y"], name
        assert name not in got[f"{i}n"], name
    assert {name for name, _, _ in CASES} == {rule.name for rule in r.RULES}


def test_unknown_inputs_fire_nothing(table):
    assert fired(table) == ([], 0, "Green")


def test_names_scores_and_order(table):
    names, score, band = fired(table, days_since_login=40, bypass_perc=25.0, bypass=60, last_30d_bypass_count=50)
    assert names == [x.name for x in r.RULES[:9]]
    assert (score, band) == (1 + 2 + 2 + 2 + 3 + 4 + 1 + 1 + 2, "Red")


@pytest.mark.parametrize("metrics, score, band", [
    ({"days_since_login": 20}, 3, "Green"), ({"days_since_login": 20, "bypass": 25}, 4, "Yellow"),
    ({"bypass_perc": 25.0}, 9, "Yellow"), ({"bypass_perc": 25.0, "bypass": 25}, 10, "Red"), ({"deployment": 0}, 10, "Red")])
def test_bands(table, metrics, score, band):
    assert fired(table, **metrics)[1:] == (score, band)


def test_score_is_one_projection(table):
    df = r.score(table(DDL, {"k": "x"}), AS_OF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_missing_inputs_are_named(table):
    with pytest.raises(ValueError, match="eol_perc"):
        r.score(table("k string", {"k": "x"}), AS_OF)


def test_band_decline(spark):
    df = spark.createDataFrame([("Red", "Green"), ("Yellow", "Green"), ("Red", "Yellow"), ("Green", "Red"), ("Red", "Red"), ("Red", None)], "now string, was string")
    got = df.select(r.declined(df.now, df.was).alias("d")).collect()
    assert [x.d for x in got] == ["True", "True", "True", "False", "False", None]
    assert rows(df.limit(0)) == []
