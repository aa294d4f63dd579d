import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tallyboard.llm import simhash

M = (1 << 64) - 1


def bits_of(number):
    out = ""
    for k in range(1, 5):
        x = (number + k * 0x9E3779B97F4A7C15) & M
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & M
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & M
        out += f"{x ^ (x >> 31):064b}"
    return out


def fingerprint(text):
    """By definition, a term and a bit at a time."""
    words = [int.from_bytes(hashlib.md5(w.encode()).digest()[:8], "big") for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    terms = Counter()
    for w in words:
        terms[w] += 1
    for i in range(max(1, len(words) - 4) if words else 0):
        run = 0
        for w in words[i:i + 5]:
            run = (run * 0xD1342543DE82EF95 + w) & M
        terms[run] += 5
    votes = [0] * 256
    for number, weight in terms.items():
        for j, bit in enumerate(bits_of(number)):
            votes[j] += weight if bit == "1" else -weight
    return f"{int(''.join('1' if v > 0 else '0' for v in votes), 2):064x}"


def alike(a, b):
    return 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 256


def brute(rows):
    """The contract: rows (doc_id, text)."""
    texts = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).hexdigest()))
    out = []
    for at, (doc_id, t) in enumerate(texts):
        f = texts[(at + 1) % len(texts)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + f[:half]
        own, changed, after = map(fingerprint, (t, edited, f))
        out.append((doc_id, len(t), hashlib.sha256(edited.encode()).hexdigest(), own, changed, alike(own, changed), alike(own, after)))
    return sorted(out, key=str)


def linked(prints, radius):
    """Classes by comparing all pairs: the least id of each."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    return [find(i) for i in range(len(prints))]


@pytest.fixture(scope="module")
def some():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(300)] + ["über", "東京", "x" * 40]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 4, 5, 6, 40, 300])))) for i in range(60)]
    rows += [(None, "no id here"), (None, "no id here"), (7, "the same id"), (7, "another text of the same id"), (7, "the same id"), (70, None), (71, " \n\t "),
             (72, "a\x0bb\x0cc\rd\x1fe f"), (73, "a"), (74, rows[5][1] or "e"), (75, "long " * 60_000)]
    return rows


def frame(docs, rows):
    return docs(*rows)


def test_as_by_definition(docs, some):
    got = simhash.compared(frame(docs, some))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(some)


def test_stretches_of_any_size(docs, some):
    """Rows dealt over many stretches, some empty, some of one row, give what one stretch gives."""
    got = simhash.compared(frame(docs, some).repartition(5), part_bytes=200)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(some)


@pytest.mark.parametrize("rows", [[], [(4, "one text only")], [(None, None)]])
def test_small_tables(docs, rows):
    got = sorted((tuple(r) for r in simhash.fingerprinted(frame(docs, rows)).collect()), key=str)
    assert [r[:7] for r in got] == brute(rows) and all(r[7] == r[0] for r in got)


def test_counters_do_not_run_over():
    text = b" ".join([b"same"] * 3000 + [b"a b c d e f g"] * 200)
    assert simhash.fingerprints([b"", text, b"other"])[1].tobytes().hex() == fingerprint(text.decode())


@pytest.mark.parametrize("radius,few,many", [(7, 16, 8192), (7, 2, 4), (12, 0, 40)])
def test_classes_as_by_all_pairs(spark, radius, few, many):
    """Clouds around centres, chains, and one block that a third of all share; buckets of all kinds."""
    rng = random.Random(radius * 100 + few)
    flip = lambda x, n: x ^ sum(1 << b for b in rng.sample(range(256), n))
    prints = {rng.getrandbits(256) for _ in range(100)}
    for _ in range(6):
        centre = rng.getrandbits(256)
        prints |= {flip(centre, rng.randint(0, radius + 2)) for _ in range(15)}
        for _ in range(8):  # a chain of steps of just the radius, and one step more
            centre = flip(centre, radius)
            prints.add(centre)
        prints.add(flip(centre, radius + 1))
    block = rng.getrandbits(64)
    hot = [(block << 192) | rng.getrandbits(192) for _ in range(60)]
    prints |= {*hot, *(flip(h, radius) for h in hot[:10])}
    prints = sorted(prints)
    rng.shuffle(prints)
    want = linked(prints, radius)
    df = spark.createDataFrame([(i, f"{p:064x}") for i, p in enumerate(prints)], "id long, fingerprint string")
    got = {r["id"]: r["component"] for r in simhash.classes(df, radius, few, many).collect()}
    assert [got.get(i, i) for i in range(len(prints))] == want


def test_near_class_is_the_least_id(docs):
    base = [f"v{i}" for i in range(2000)]
    rows = [(9, " ".join(base)), (4, " ".join(base)), (6, " ".join([*base[:-1], "new"])), (1, " ".join(base[::-1])), (None, " ".join(base))]
    assert simhash.RADIUS >= 256 * (1 - alike(fingerprint(rows[0][1]), fingerprint(rows[2][1])))
    got = Counter((r["doc_id"], r["near_class"]) for r in simhash.fingerprinted(frame(docs, rows)).collect())
    assert got == Counter([(9, 4), (4, 4), (6, 4), (None, 4), (1, 1)])


def test_likeness():
    a, b = np.zeros((1, 32), np.uint8), np.full((1, 32), 255, np.uint8)
    assert simhash.likeness(a, a) == 1 and simhash.likeness(a, b) == 0
