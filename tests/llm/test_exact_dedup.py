import hashlib
import re
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyboard.llm import exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append((doc_id is None, doc_id or 0, i))
    out = []
    for text, found in groups.items():
        for null, doc_id, i in found:
            keep = min(found)
            out.append((None if null else doc_id, None if keep[0] else keep[1], len(found), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in df.collect()], key=str)


def test_cases(docs):
    rows = [(1, "a b"), (2, "a \t b"), (3, None), (4, ""), (5, "x" * 5000), (6, "x" * 5000), (7, "x" * 4999 + "y"), (8, "x" * 2048), (9, "x" * 4096),
            (None, "a b"), (None, None), (10, "é" * 3000), (11, "é" * 3000), (12, "one"), (12, "one"), (13, " one"), (14, "x" * 2048 + "z"), (15, "x" * 2048 + "z")]
    out = exact_dedup.exact_groups(docs(*rows))
    assert got(out) == expected(rows)
    kept = [tuple(r) for r in out.filter("kept").select("text_sha256").collect()]
    assert len(kept) == len(set(kept)) == len({r[3] for r in expected(rows)})
    assert out.filter("kept AND NOT (doc_id <=> keep_id)").isEmpty()


def test_small_blocks_go_through_all_levels(docs):
    texts = ["abcdefgh" * 4, "abcdefgh" * 4, "abcdefgh" * 4 + "a", "abcdefgh" * 5, "hgfedcba" * 4, "abcd", "abcdabcd", "abcdabcd", "abcdabc", "abcdabc"]
    rows = list(enumerate(texts))
    assert got(exact_dedup.exact_groups(docs(*rows), block=4)) == expected(rows)


def test_order_of_blocks_counts(docs):
    rows = [(1, "aabb"), (2, "bbaa"), (3, "aabb"), (4, "bbaa"), (5, "aaaa"), (6, "bbbb")]
    assert got(exact_dedup.exact_groups(docs(*rows), block=2)) == expected(rows)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab \n", max_size=9), max_size=30))
def test_any_texts(docs, texts):
    rows = list(enumerate(texts))
    assert got(exact_dedup.exact_groups(docs(*rows), block=2)) == expected(rows)


def test_blocks_that_share_a_key_stay_apart(docs, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.length(c[0]).cast("long"))
    rows = [(1, "aa"), (2, "bb"), (3, "aa"), (4, "cc"), (5, "bb"), (6, "d")]
    assert got(exact_dedup.exact_groups(docs(*rows))) == expected(rows)


def test_empty_table_and_carried_rows(docs):
    assert exact_dedup.exact_groups(docs()).count() == 0
    out = exact_dedup.exact_groups(docs((1, "a", "en", "s"), (2, "a", None, "t")), carry=True).filter("kept").select("row.*")
    assert [r["source"] for r in out.collect()] == ["s"] and out.columns[-1] == "score"
