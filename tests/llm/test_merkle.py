import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyboard.llm import merkle, queries, sha256


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text=...):
    fields = list(row[:5])
    if text is not ...:
        fields[4] = text
    return H(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def way(tree, at):
    """Siblings left and right of each level."""
    out = []
    for level in tree[:-1]:
        first = at - at % 8
        out.append((level[first:at], level[at + 1:first + 8]))
        at //= 8
    return out


def brute(rows):
    """The contract, by definition: rows (doc_id, source, lang, n_chars, text)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    order = {lang: sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for lang in langs}
    trees = {lang: levels([leaf(r) for r in mine]) for lang, mine in order.items()}
    top = levels([trees[lang][-1][0] for lang in langs]) if langs else [[None]]
    out = []
    for i, lang in enumerate(langs):
        for at, r in enumerate(order[lang]):
            steps = way(trees[lang], at) + way(top, i)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None
            node = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]) if tampered else r[4])
            for left, right in steps:
                node = H(*left, node, *right)
            out.append((r[0], leaf(r), trees[lang][-1][0], top[-1][0], H(*[s for left, right in steps for s in left + right]), node, node == top[-1][0]))
    return sorted(out, key=str)


def frame(spark, rows, more="digest string, tree string, pos string, key string, chunk string"):
    schema = f"doc_id long, source string, lang string, n_chars long, text string, {more}"
    return spark.createDataFrame([tuple(r) + ("x",) * 5 for r in rows], schema)


def fold(docs):
    tampered = F.when(queries.rows.fold("doc_id", 3) == 0, queries.rows.ascii_lower("text")).otherwise(F.col("text"))
    return merkle.folded(merkle.build(docs, replacements={"tampered": {"text": tampered}}), "tampered")


def got(docs):
    return sorted((tuple(r) for r in fold(docs).collect()), key=str)


def test_states_are_those_of_sha256():
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 9, 64, 65, 600):
        digests = rng.integers(0, 256, (n, 32)).astype(np.uint8)
        grown, states = merkle.grow(digests, True)
        want = levels([d.tobytes().hex() for d in digests])
        assert [[d.tobytes().hex() for d in level] for level in grown] == want
        chunk = merkle._Chunk(grown, states)
        assert (chunk.fold(np.arange(n), digests) == grown[-1]).all()
    # A state kept before a child takes in the rest as the whole does.
    kept = sha256.take(sha256.take(sha256.begin(1), digests[:1]), digests[1:2])
    again = sha256.take(sha256.unpacked(sha256.packed(kept)), digests[2:3])
    assert sha256.finish(again, 3).tobytes().hex() == H(*[d.tobytes().hex() for d in digests[:3]])


def test_as_by_definition(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("ab"), rng.choice(["de", "en", None, "Zz", "ü"]), rng.choice([None, i]), f"Text {i} ÄB") for i in range(150)]
    rows += [(500, None, "one", None, None), (None, "s", "en", 1, "null Key"), (None, "s", "en", 1, "null Key"), (7, "s", "en", 1, ""), (7, "s", "en", 1, ""),
             (8, "s", "en", 1, "X" * 300_000), (-5, "", "", 0, "Ö:;-")]
    assert got(frame(spark, rows)) == brute(rows)


def test_trees_of_several_chunks(spark):
    """More leaves than a chunk holds: paths lead through the chunks above; a lone chunk at the end has all its levels."""
    rows = [(i, "s", "en" if i < 2 * merkle.SPAN + 3 else "de", i, f"T{i}") for i in range(2 * merkle.SPAN + 3 + 70)]
    assert got(frame(spark, rows)) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 9])
def test_small_tables(spark, n):
    rows = [(i, None, "en", None, "T") for i in range(n)]
    assert got(frame(spark, rows)) == brute(rows)


def test_a_changed_row_is_found_and_no_other(spark):
    rows = [(i, "s", "en", 1, "A" if i == 13 else "a") for i in range(40)]
    docs = frame(spark, rows)
    kept = merkle.build(docs, replacements={"changed": {"text": F.lower("text")}})
    assert [r["doc_id"] for r in merkle.folded(kept, "changed").filter("not verified").collect()] == [13]
    assert merkle.folded(kept).filter("not verified").isEmpty()
