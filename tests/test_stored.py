"""Tables replaced without a gap and updated by key."""

import glob

import pytest
from pyspark.sql import functions as F

from estate_helpers import rows
from tallyboard.operators import stored


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def test_a_name_keeps_its_rows_until_the_new_ones_are_whole(spark, tmp_path):
    old = frame(spark, "k string, v long", ("a", 1), ("b", 2))
    begun = stored.switch(old, "stored_t", str(tmp_path), "k")
    with pytest.raises(ValueError):
        stored.switch(frame(spark, "k string, v long", ("a", 1), ("a", 2)), "stored_t", str(tmp_path), "k")
    broken = old.withColumn("v", F.expr("cast(raise_error('no more rows') as bigint)"))
    with pytest.raises(Exception, match="no more rows"):
        stored.switch(broken, "stored_t", str(tmp_path), "k")
    assert rows(spark.table("stored_t")) == [("a", 1), ("b", 2)]
    # A replacement may read what it replaces, and have other columns.
    stored.switch(spark.table("stored_t").withColumn("more", F.col("v") * 2), "stored_t", str(tmp_path), "k")
    assert rows(spark.table("stored_t")) == [("a", 1, 2), ("b", 2, 4)] and rows(begun) == [("a", 1), ("b", 2)]
    stored.switch(old.limit(0), "stored_t", str(tmp_path), "k")
    assert spark.table("stored_t").count() == 0
    spark.sql("drop view stored_t")


def test_update_insert_and_new_column(spark, tmp_path):
    path = str(tmp_path / "t")
    stored.write_keyed(frame(spark, "k string, v long, w string", ("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")), path, "k", 4)
    stored.merge_keyed(frame(spark, "k string, v long, grade string", ("b", None, "good"), ("d", 9, None)), path, "k", 4)
    got = stored.read_keyed(spark, path)
    assert rows(got, "k", "v", "w", "grade") == sorted([("a", 1, "x", None), ("b", None, "y", "good"), ("c", 3, "z", None), ("d", 9, None, None)], key=str)
    again = rows(got, "k", "v", "w", "grade")
    stored.merge_keyed(frame(spark, "k string, v long, grade string", ("b", None, "good"), ("d", 9, None)), path, "k", 4)
    assert rows(stored.read_keyed(spark, path), "k", "v", "w", "grade") == again


def test_untouched_parts_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    stored.write_keyed(spark.range(1000).selectExpr("id as k", "id * 2 as v"), path, "k", 32)
    files = lambda: {f: open(f, "rb").read() for f in glob.glob(f"{path}/part=*/*.parquet")}
    before = files()
    assert stored.merge_keyed(spark.range(3).selectExpr("id as k", "-1L as v"), path, "k", 32) <= 3
    after = files()
    kept = {f.split("/part=")[1].split("/")[0] for f in before if after.get(f) == before[f]}
    assert len(kept) >= 29 and all(f in after for f in before if f.split("/part=")[1].split("/")[0] in kept)
    got = {r["k"]: r["v"] for r in stored.read_keyed(spark, path).collect()}
    assert got == {k: -1 if k < 3 else 2 * k for k in range(1000)}


def test_bucketed_tables_meet_without_a_shuffle(spark, tmp_path):
    """All joins of the assembled master, with broadcast off: no exchange; the rows are those of the tables."""
    from tallyboard.plans import scorecard

    def keep(name, df):
        return stored.write_bucketed(df, str(tmp_path / name), "inst_id", 4)

    wide = ", ".join(f"{c} string" for c in scorecard.MASTER_NAMES if c not in ("inst_id", "licenses_purchased")) + ", licenses_purchased bigint"
    ids = [str(i) for i in range(20)]
    sf = spark.createDataFrame([(i, 10) for i in ids], "inst_id string, licenses_purchased bigint")
    sf = sf.select("inst_id", *[F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in wide.split(", ")) if c != "licenses_purchased"], "licenses_purchased")
    counters = spark.createDataFrame([(i, *[int(i)] * len(scorecard.ALERT_NAMES)) for i in ids[:10]], "inst_id string, " + ", ".join(f"{c} bigint" for c in scorecard.ALERT_NAMES))
    plain = {"sf_data": sf, "alerts": counters, "new_deployment": spark.createDataFrame([("3", 7)], "inst_id string, peak_daily_consumption bigint")}
    facts = {"a": frame(spark, "inst_id string, deployment bigint", ("1", 5), ("2", None)), "b": frame(spark, "inst_id string, last_login date")}
    bucketed = scorecard.with_deployment_share(scorecard.assemble({n: keep(n, df) for n, df in plain.items()}, {n: keep(n, df) for n, df in facts.items()}))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = bucketed._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and text.count("SortMergeJoin") == 4, text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert rows(bucketed) == rows(scorecard.with_deployment_share(scorecard.assemble(plain, facts))) and bucketed.count() == 20
    # A rerun replaces the table; a null key is a row as any other.
    again = keep("a", frame(spark, "inst_id string, deployment bigint", (None, 1), ("9", 2)))
    assert rows(again) == rows(spark.read.parquet(str(tmp_path / "a"))) == [("9", 2), (None, 1)]


def test_changes_must_be_keyed(spark, tmp_path):
    path = str(tmp_path / "t")
    stored.write_keyed(frame(spark, "k string, v long", ("a", 1)), path, "k", 4)
    for bad in ([("a", 1), ("a", 2)], [(None, 1)]):
        with pytest.raises(ValueError):
            stored.merge_keyed(frame(spark, "k string, v long", *bad), path, "k", 4)
    assert stored.merge_keyed(frame(spark, "k string, v long"), path, "k", 4) == 0
    assert rows(stored.read_keyed(spark, path)) == [("a", 1)]
