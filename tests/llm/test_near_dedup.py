import random

import numpy as np

from llm_helpers import brute, changed, got
from tallyboard.llm import near_dedup as n
from tallyboard.llm.components import components


def test_groups_as_by_all_pairs(docs):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(500)]
    rows, shared = [], [rng.choice(vocabulary) for _ in range(60)]
    for g in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([30, 120, 400]))]
        rows += [(len(rows) + k, changed(rng, base, k % 3)) for k in range(rng.randint(1, 5))]
    # A hot bucket of texts that share a passage and little else, with a pair of near copies in it.
    rows += [(1000 + i, " ".join(shared + [rng.choice(vocabulary) for _ in range(40)])) for i in range(40)]
    pair = shared + [rng.choice(vocabulary) for _ in range(200)]
    rows += [(2000, " ".join(pair)), (2001, changed(rng, pair, 2)), (2002, "two words"), (2003, "two  words"), (2004, None), (2005, " "), (2005, ""),
             (None, "two words"), (2006, "a b c d e " * 300), (2007, "a b c d e " * 300 + "end"), (2008, "w " * 20000), (2009, "w " * 20001)]
    assert got(n.near_groups(docs(*rows))) == brute(rows)


def test_chains_stay_whole(docs):
    """The lightest of three is like the second alone; the second and the third meet in buckets whose head is the first."""
    rng = random.Random(11)
    new = lambda n: [f"u{rng.random()}" for _ in range(n)]
    rows = []
    for g in range(40):
        a = new(200)
        b = a + new(14)
        rows += [(3 * g + i, " ".join(t)) for i, t in enumerate([a, b, new(42) + b])]
    want = brute(rows)
    assert want == sorted(((i, i - i % 3) for i in range(120)), key=str)
    assert got(n.near_groups(docs(*rows))) == want


def test_equal_texts_meet_without_bands(docs):
    """All bands of four texts lie in the passage they share, and none are alike: the copies of the heaviest are one class still."""
    passage = " ".join(f"p{i}" for i in range(40))
    longer = lambda name, size: passage + " " + " ".join(f"{name}x{i}" for i in range(size))
    copy = longer("b13083", 9)
    rows = [(0, passage), (1, longer("a6448", 8)), (2, longer("a19927", 8)), (3, copy), (4, copy.replace(" ", "  "))]
    rows += [(10 + i, " ".join(f"f{i}x{j}" for j in range(20))) for i in range(100)]
    want = brute(rows)
    assert want == sorted([(i, i) for i, _ in rows if i != 4] + [(4, 3)], key=str)
    assert got(n.near_groups(docs(*rows))) == want


def test_large_group_of_near_copies_stays_whole(docs):
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 900)}" for _ in range(200)]
    rows = [(i, changed(rng, base, 1)) for i in range(60)] + [(100 + i, " ".join(f"x{rng.randint(0, 10**6)}" for _ in range(50))) for i in range(90)]
    found = n.near_groups(docs(*rows)).collect()
    assert {r["class_id"] for r in found if r["doc_id"] < 60} == {0}
    assert [r["class_size"] for r in found if r["kept"] and r["doc_id"] < 60] == [60] and sum(r["kept"] for r in found) == 91


def test_samples_agree_as_often_as_the_similarity():
    rng = np.random.default_rng(0)
    a = np.sort(rng.integers(0, 1 << 63, 500).astype(np.uint64))
    b = np.sort(np.concatenate([a[:350], rng.integers(0, 1 << 63, 150).astype(np.uint64)]))
    wa, wb = (0.5 + (x % np.uint64(7)).astype(np.float32) / 7 for x in (a, b))
    drawn = n.signatures(np.concatenate([a, b]), np.concatenate([wa, wb]), np.array([0, 500, 1000]), 3000)
    assert abs((drawn[:, 0] == drawn[:, 1]).mean() - n._similarity((a, wa.astype(float)), (b, wb.astype(float)))) < 0.03


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100 + i, 99) for i in range(20)] + [(5, 5), (200, 201), (201, 200)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(41)} | {i: 99 for i in range(99, 120)} | {200: 200, 201: 200}


def test_nothing(docs):
    assert n.near_groups(docs()).count() == 0
    assert got(n.near_groups(docs((1, "alone here")))) == [(1, 1)]
