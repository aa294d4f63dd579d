"""Replies landed by the ledger's queries: what is written of them, and what is read back."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from tallyboard.showcase import oracle  # noqa: F401  its tables come first, queries name them
from tallyboard.showcase import ledger_queries


def test_landed_replies_are_written_compressed(spark, tmp_path, monkeypatch):
    """Two landings of two thirds write far less than the text of the replies, in files that are small, and lose none."""
    monkeypatch.setattr(ledger_queries, "scratch_path", lambda _, name: str(tmp_path / name))
    monkeypatch.setattr(ledger_queries, "FILE_REPLIES", 300, raising=False)
    replies = spark.range(2000).selectExpr(
        "cast(id % 50 as string) as inst_id", "0 as page", "case when id = 7 then 504 else 200 end as status",
        "named_struct('num_found', 1L, 'results', array(named_struct('id', cast(id as string), 'sensor_version', '3.1', 'deployment_type', 'ENDPOINT', "
        "'last_contact_time', concat('2024-01-', 10 + id % 20, 'T08:15:30.250Z')))) as body")
    text = replies.select(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0]
    found = ledger_queries.landed_twice(SimpleNamespace(spark=spark), "endpoints", replies)
    assert found.groupBy("fetch_status").count().orderBy("fetch_status").collect() == [("OK", 1999), ("TIMEOUT", 1)]
    assert {r["id"] for r in found.filter("id is not null").collect()} == {str(i) for i in range(2000) if i != 7}
    files = [f for f in (tmp_path / "ledger" / "landed" / "endpoints").iterdir() if f.name.startswith("part-")]
    assert sum(f.stat().st_size for f in files) < text / 4
    assert all(spark.read.text(str(f)).count() <= 300 for f in files)
