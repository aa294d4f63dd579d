import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from tallyboard.llm import mixing


def filled(sizes):
    """Targets by sharing again and again until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        share = {s: 3 * sizes[s] if s in full else rest * weight[s] / open_ if open_ else 0 for s in names}
        more = {s for s in names if s not in full and share[s] >= 3 * sizes[s]}
        if not more:
            return share
        full |= more


def sainte_lague(targets, seats):
    won, turns = Counter(), sorted((((2 * k - 1) / t, i, s) for i, (s, t) in enumerate(targets.items()) if t for k in range(1, seats + 2)), key=lambda x: x[:2])
    for _, _, s in turns[:seats]:
        won[s] += 1
    return won


ROWS = ([(i, "w " * (i % 40), None, "s%d" % (i % 7)) for i in range(200)] + [(900, "x " * 3000, None, "hot"), (901, None, None, None), (902, "one", None, None),
        (903, "", None, "é"), (904, " ", None, "é"), (None, "a b c", None, "hot"), (905, "a b", None, "\u20ac"), (905, "a b", None, "\u20ac"), (906, "k " * 5, None, "\U0001F600")])


def test_targets_and_taken(docs):
    sizes = Counter()
    for _, text, _, source in ROWS:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = filled(sizes)
    found = mixing.mix(docs(*ROWS)).collect()
    assert len(found) == len(ROWS)
    by_id = {r["doc_id"]: r for r in found}
    taken = Counter()
    for (doc_id, _, _, source), in zip(ROWS):
        r = by_id[doc_id]
        assert abs(r["target"] - want[source]) < 1e-6 and r["source_size"] == sizes[source]
    source_of = {r[0]: r[3] for r in ROWS}
    for r in found:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source_of[r["doc_id"]]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= mixing.BLOCK_WORDS, (s, taken[s], t)
    again = mixing.mix(docs(*ROWS).repartition(5)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, found), key=str)


def laid_out(rows, seed, shards, block=8, most=3):
    """Words of each row by shard: the order laid out word by word, a shard's blocks counted off it."""
    words = [(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, (_, t, _, _) in enumerate(rows)]
    sizes, orders = Counter(), {}
    for (i, n), (doc_id, text, _, source) in zip(words, rows):
        sizes[source] += n
        drawn = hashlib.md5(f"{seed}:{'null' if doc_id is None else doc_id}:{hashlib.md5((text or '').encode()).hexdigest()}".encode()).hexdigest()
        orders.setdefault(source, []).append((drawn, n, i))
    want, seats = filled(sizes), round(sum(sizes.values()) / block)
    names = sorted(want, key=lambda s: (s is None, (s or "").encode()))
    targets = {s: want[s] for s in names}
    got = [Counter() for _ in rows]
    at, before = Counter(), Counter()
    for shard in range(shards):
        won = sainte_lague(targets, seats * (shard + 1) // shards)
        for s in names:
            order = [i for _, n, i in sorted(orders[s]) for _ in range(n)]
            for _ in range((won[s] - before[s]) * block):
                if at[s] < most * len(order):
                    got[order[at[s] % len(order)]][shard] += 1
                    at[s] += 1
        before = won
    return got


def test_shards_take_their_quotas(docs):
    """Every shard's words of every document, against the order laid out word by word; another number of shards, another layout of the same words."""
    data = [r for i, r in enumerate(ROWS) if r not in ROWS[:i]]
    by_id = {r[0]: i for i, r in enumerate(data)}
    takes = {}
    for shards in (1, 5, 16):
        want = laid_out(data, mixing.SEED, shards)
        found = mixing.mix(docs(*data), shards=shards).collect()
        takes[shards] = {r["doc_id"]: r["taken"] for r in found}
        for r in found:
            assert {s["shard"]: s["words"] for s in r["by_shard"]} == dict(want[by_id[r["doc_id"]]]), r
            assert sum(s["words"] for s in r["by_shard"]) == r["taken"]
    assert takes[1] == takes[5] == takes[16]


def test_rows_without_a_key_are_spread(docs):
    got = mixing.mix(docs(*[(None, f"t{i} a b", None, "s") for i in range(50)], (1, "x " * 20, None, "t"))).collect()
    assert len(got) == 51 and sum(r["taken"] > 0 for r in got) > 1


def test_quotas_are_sainte_lague(spark):
    for sizes in ({"a": 100, "b": 5, "c": 33, "d": 61}, {"a": 1000, "b": 1000, "c": 1000}, {"a": 7, "b": 0, "c": 9999, "d": 4, "e": 3, "f": 2}):
        aims = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
        targets = {r["source"]: r["target"] for r in aims.orderBy("place").collect()}
        got = mixing.quotas(aims, block=8, shards=4)
        seats, before = int(sum(sizes.values()) / 8 + 0.5), Counter()
        for shard in range(4):
            want = sainte_lague(targets, seats * (shard + 1) // 4)
            quota = {r["source"]: r["quota"] for r in got.filter(F.col("shard") == shard).collect()}
            assert quota == {s: want[s] - before[s] for s in sizes}, (sizes, shard)
            before = want


def test_rows_taken(docs):
    data = docs(*ROWS)
    out = mixing.taken_rows(data)
    assert out.columns == data.columns
    words = out.groupBy("source").agg(F.sum(mixing.rows.n_words("text")).alias("n")).collect()
    taken = mixing.mix(data, carry=True).groupBy("row.source").agg(F.sum("taken").alias("n")).collect()
    assert {r["source"]: r["n"] for r in words if r["n"]} == {r["source"]: r["n"] for r in taken if r["n"]}


def test_nothing(docs):
    assert mixing.mix(docs()).count() == 0
    assert [r["taken"] for r in mixing.mix(docs((1, None), (2, " "))).collect()] == [0, 0]
