import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from estate_helpers import AS_OF, one, rows
from tallyboard.operators import history as hist
from tallyboard.operators import keyed
from tallyboard.operators.lists import set_list
from tallyboard.operators.ranking import position
from tallyboard.operators.rollup import RULE_SPEC, SPEC, account_members, account_rollup
from tallyboard.session import scratch_path, work_dir

TEXT = {"csm", "csm_manager", "cse", "csm_role", "cs_tier", "prev_cs_tier", "csm_comments", "gs_adoption_comments", "forecast", "products", "next_renewal_qt",
        "cua_status", "integrations", "prod", "orgid", "account_id", "inst_id", "account__c"}
DATES = {"next_renewal", "gs_last_updated", "last_cua_cta", "last_ta", "last_wb", "last_cse_timeline", "created_date"}
REAL = {"arr", "acv", "average_monthly_consumption"}


def kind(name):
    return ("string" if name in TEXT else "date" if name in DATES else "double" if name in REAL or name.endswith("_perc")
            else "boolean" if name == "bypass_all" else "bigint")


MASTER = "account_name string, inst_id string, orgid string, account__c string, " + ", ".join(f"{n} {kind(n)}" for n, _ in SPEC + RULE_SPEC)


def test_spec_covers_the_report():
    assert len(SPEC) == 68 and len({n for n, _ in SPEC}) == 68


def test_rollup_families(table):
    master = table(
        MASTER,
        {"account_name": "A", "inst_id": "2", "orgid": "20", "arr": 5.0, "licenses": 9, "deployment": 30, "bypass": 3, "days_since_login": 4, "integrations": "elk, splunk",
         "average_monthly_consumption": 10.0, "cbc_cases_90d": 0, "bypass_all": True, "last_30d_bypass_count": 2, "sensor_eol_support": 1},
        {"account_name": "A", "inst_id": "1", "orgid": "10", "arr": 7.0, "licenses": 100, "deployment": 20, "bypass": 4, "days_since_login": 9, "integrations": "elk",
         "average_monthly_consumption": None, "cbc_cases_90d": 3, "bypass_all": False, "last_30d_bypass_count": 5, "sensor_eol_support": None},
        {"account_name": "A", "inst_id": "3", "average_monthly_consumption": 20.0},
        {"account_name": "Zero", "inst_id": "9", "deployment": 0, "bypass": 0, "licenses": None}, {"inst_id": "homeless"})
    got = account_rollup(master)
    a, zero = one(got, account_name="A"), one(got, account_name="Zero")
    assert (a["arr"], a["licenses"], a["deployment"], a["deployment_perc"], a["bypass"], a["bypass_perc"]) == (7.0, 100, 50, 50.0, 7, 14.0)
    assert (a["days_since_login"], a["average_monthly_consumption"], a["eol_perc"]) == (4, 10.0, 2.0)
    assert (a["members"], a["integrations"], zero["integrations"]) == (3, "elk, splunk", None)
    assert (a["cbc_cases_90d"], a["bypass_all"], a["last_30d_bypass_count"]) == (0, True, 7)
    assert (zero["bypass_perc"], zero["deployment_perc"], zero["members"]) == (None, None, 1)
    assert got.count() == 2
    assert got.columns == ["account_name", *[n for n, _ in SPEC], *[n for n, _ in RULE_SPEC]]


@pytest.mark.parametrize("size", [3, 10_001])
def test_accounts_have_one_shape_at_every_size(spark, size):
    """Members are rows, counts and flags are cells, whatever the account holds."""
    master = spark.range(size + 5).select(
        F.when(F.col("id") < size, "hot").otherwise("small").alias("account_name"), F.col("id").cast("string").alias("inst_id"),
        *[F.lit(None).cast(kind(n)).alias(n) for n, _ in SPEC + RULE_SPEC if n not in ("members", "integrations")],
        F.when(F.col("id") % 2 == 0, "elk").otherwise("elk, splunk").alias("integrations"),
        F.col("id").cast("string").alias("orgid"), F.col("id").cast("string").alias("account__c"))
    got = account_rollup(master)
    assert (one(got, account_name="hot")["members"], one(got, account_name="hot")["integrations"]) == (size, "elk, splunk")
    assert got.columns == ["account_name", *[n for n, _ in SPEC], *[n for n, _ in RULE_SPEC]]
    assert account_members(master).filter("account_name = 'hot'").distinct().count() == size


def test_lists_are_sorted_and_skip_unknowns(table):
    rows_ = table("k string, v string, id int", {"k": "a", "v": "y", "id": 1}, {"k": "a", "v": "x", "id": 2}, {"k": "a", "v": "x", "id": 3}, {"k": "a", "id": 4}, {"k": "b", "id": 5})
    assert rows(set_list(rows_, ["k"], "v")) == [("a", "x, y")]


def test_positions_across_a_hot_group(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 1500, "hot").otherwise("rest").alias("g"), F.concat(F.lit("n"), F.lpad(((F.col("id") * 7919) % 2003).cast("string"), 5, "0")).alias("name"))
    df = df.repartition(6)
    got = position(df, "g", ["name"]).orderBy("g", "position").collect()
    for g in ("hot", "rest"):
        mine = [r for r in got if r.g == g]
        assert [r.position for r in mine] == list(range(len(mine)))
        assert [r.name for r in mine] == sorted(r.name for r in mine)


def test_position_keeps_an_unnamed_group(table):
    got = position(table("g string, name string", {"name": "b"}, {"name": "a"}, {"g": "x", "name": "c"}), "g", ["name"])
    assert rows(got, "g", "name", "position") == [("x", "c", 0), (None, "a", 0), (None, "b", 1)]


def test_keyed_helpers(table):
    df = table("k string, day int, v int", {"k": "a", "day": 1, "v": 9}, {"k": "a", "day": 2, "v": 3}, {"k": "b", "day": 1, "v": 5})
    assert rows(keyed.latest_row(df, ["k"], ["day"]), "k", "v") == [("a", 3), ("b", 5)]
    assert rows(keyed.duplicates(df, "k")) == [("a", 2)]
    with pytest.raises(ValueError, match="repeats"):
        keyed.require_unique(df, "k")
    assert rows(keyed.tolerant_select(df, ["v", "gone", "K"]).filter("K = 'b'")) == [(5, None, "b")]
    owners = table("csm string", {"csm": "Ann"}, {"csm": "ANN"}, {"csm": "Bob"}, {})
    assert (keyed.owned_by(owners, "ann").count(), keyed.owned_by(owners, "all").count()) == (2, 3)


STOCK = "inst_id string, deployment bigint, cua_brag string"
LATER = AS_OF + dt.timedelta(days=1)


def stock(table, *items):
    return table(STOCK, *[dict(zip(("inst_id", "deployment", "cua_brag"), i)) for i in items])


def test_snapshot_rerun_replaces_its_day_only(spark, table):
    path = scratch_path(spark, "archive")
    hist.write_day(hist.snapshot(stock(table, ("1", 10, "Green"), ("2", 20, "Red")), AS_OF), path)
    for n in (11, 12):
        hist.write_day(hist.snapshot(stock(table, ("1", n, "Red")).withColumn("note", F.lit("new")), LATER), path)
    got = hist.read_archive(spark, path)
    assert rows(got, "unique_id", "deployment", "note") == [("2024-01-311", 10, None), ("2024-01-312", 20, None), ("2024-02-011", 12, "new")]
    swing = hist.with_previous(stock(table, ("1", 9, "Yellow"), ("3", 1, "Green")), got, LATER)
    assert rows(swing, "inst_id", "previous_deployment", "previous_brag") == [("1", 10, "Green"), ("3", None, None)]
    rerun = hist.with_decline(hist.with_previous(stock(table, ("1", 9, "Red")), got, AS_OF))
    assert rows(rerun, "brag_decrease") == [("False",)]
    again = hist.with_decline(swing)
    assert rows(again, "inst_id", "brag_decrease") == [("1", "True"), ("3", None)]


def test_first_run_has_no_previous(table):
    first = hist.with_decline(hist.with_previous(stock(table, ("1", 9, "Red")), None, AS_OF))
    assert rows(first) == [("1", 9, "Red", "False")]


def test_snapshot_changes_and_alignment(table):
    days = table("inst_id string, date date, deployment bigint", *[{"inst_id": "1", "date": dt.date(2024, 1, d), "deployment": n} for d, n in ((1, 1000), (2, 900), (3, 810), (4, 0), (5, 5))])
    got = hist.snapshot_changes(days, "inst_id", "deployment")
    assert [r[-1] for r in got.orderBy("date").collect()] == [None, 10.0, 10.0, 100.0, None]
    today = days.filter("date = '2024-01-05'").withColumn("extra", F.lit("x"))
    merged = hist.align_union(days, today)
    assert merged.count() == 5 and merged.filter("extra = 'x'").count() == 1
    assert [r.date.day for r in hist.archive_series(days, ["deployment", "none"]).collect()] == [1, 2, 3, 4, 5]


def test_append_and_replace(spark, table):
    path = scratch_path(spark, "t")
    hist.replace(stock(table, ("1", 1, "")), path)
    hist.replace(stock(table, ("2", 2, "")), path)
    hist.append(stock(table, ("3", 3, "")), path)
    assert rows(spark.read.parquet(path), "inst_id") == [("2",), ("3",)]


class FakeSession:
    """Just what ``work_dir`` asks a session."""

    def __init__(self, master, configured=None, checkpoint=None):
        self.sparkContext = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint)
        self.conf = SimpleNamespace(get=lambda key, default=None: configured or default)


def test_work_dir_is_the_configured_one(spark):
    assert work_dir(FakeSession("spark://host", "hdfs:///shared")) == "hdfs:///shared"
    assert work_dir(FakeSession("spark://host", None, "hdfs:///set")) == "hdfs:///set"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(FakeSession("spark://host"))
    assert work_dir(spark) == work_dir(spark)


def test_states_of_any_day_are_the_newest_snapshots(spark, tmp_path):
    """Carried from day to day, seeded from the archive, or made again after days without states: always the same."""
    import random

    from tallyboard.plans.refresh import Refresh

    rng, start = random.Random(8), dt.datetime(2024, 1, 1)
    seen = [(f"k{k}", (start + dt.timedelta(days=d)).date(), rng.choice([None, 1, 2, 3]), rng.choice(["Red", "Green"])) for d in range(6) for k in range(12) if rng.random() < 0.4]
    archive = spark.createDataFrame(seen, "inst_id string, date date, deployment long, cua_brag string")
    job = Refresh(spark, str(tmp_path), start, [], True)
    for d in range(6):
        job.as_of = start + dt.timedelta(days=d)
        day = archive.filter(F.col("date") == F.lit(job.as_of.date())).drop("date").withColumn("account_name", F.lit("a"))
        before = job.before("master", "inst_id")
        newest = {k: (at, n, band) for k, at, n, band in sorted(seen, key=lambda r: r[1]) if at < job.as_of.date()}
        assert (before is None) == (d == 0)
        if d:
            assert {r["inst_id"]: (r["seen"], r["deployment"], r["cua_brag"]) for r in before.collect()} == newest
        job.follow_gaps = d != 3  # no state is kept on one day
        for _ in range(1 + (d == 2)):  # one day runs twice
            job.write_snapshot("master", day, "inst_id")
        job.follow_gaps = True
    assert Refresh(spark, str(tmp_path), start, [], True).before("master", "inst_id").count() == 0
