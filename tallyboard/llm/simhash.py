"""Fingerprints of texts whose bits agree the more, the more the texts have in common.

Terms are the words of a text and its runs of five words (of all words, where
there are fewer); a run weighs three words. A term has a number that depends on
its words alone, and 256 bits made from that number. Each occurrence of a term
votes on every bit of the fingerprint, for or against as the term's bit is set;
a bit is set when more weight is for it than against. A text without a word has
no bit set. Likeness is the share of equal bits: 1 for equal texts, about a half
for texts with nothing in common.

``compared`` puts each text beside an edited text and beside the next document.
``classes`` finds fingerprints within a Hamming radius by permuted block tables:
two fingerprints with at most r different bits agree on one of r + 1 blocks.

Null texts are empty. Rows with equal ids follow by the MD5 of their text, null
ids come last, repeated rows stay rows. An empty table gives no row. A task
needs some 40 bytes of memory for each byte of its longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import rows
from .components import components
from .hashing import IS_SPACE, mix
from .token_store import _batches

BITS = 256
RUN = 5
RUN_WEIGHT = 5
#: Different bits of fingerprints that count as near.
RADIUS = 7
#: Members of a bucket whose pairs are joined, and those that one task compares.
FEW, MANY = 16, 8192
#: Digits of a block that still tell enough members apart; with fewer left, what remains is compared pair by pair.
LEAST_DIGITS = 3

#: What tells the four words of a term's bits apart, and the factor of a run's words.
_STEPS, _FACTOR = np.arange(1, BITS // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
#: Terms whose bits are counted at once, and terms that a byte can count.
_TOGETHER, _BYTE = 1 << 13, 255


def _word_numbers(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the words in the bytes and the number of each: the first eight bytes of its MD5."""
    solid = np.concatenate([[False], ~IS_SPACE[raw], [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    letters = raw[solid[1:-1]]
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
    known = b"".join(hashlib.md5(w, usedforsecurity=False).digest()[:8] for w in coded.dictionary.to_pylist())
    return starts, np.frombuffer(known, ">u8").astype(np.uint64)[coded.indices.to_numpy()]


def _votes(terms: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    """Of each owner and bit, the terms whose bit is set; ``owners`` ascend."""
    out = np.zeros((n, BITS), np.int64)
    for a in range(0, len(terms), _TOGETHER):
        mine, owner = terms[a:a + _TOGETHER], owners[a:a + _TOGETHER]
        words = mix(mine[:, None] + _STEPS)
        bits = np.unpackbits(words.astype(">u8").view(np.uint8), axis=1).view(np.uint64)  # eight counters a number
        heads = np.flatnonzero(np.diff(owner, prepend=-1))
        cuts = np.union1d(heads, np.arange(0, len(mine), _BYTE))
        counted = np.add.reduceat(bits, cuts, axis=0).view(np.uint8)
        out[owner[heads]] += np.add.reduceat(counted, np.searchsorted(cuts, heads), axis=0, dtype=np.int64)
    return out


def fingerprints(texts: Sequence[bytes]) -> np.ndarray:
    """Fingerprints of the texts, (n, 32) bytes."""
    raw = np.frombuffer(b" ".join(texts), np.uint8)
    starts, words = _word_numbers(raw)
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    first = np.searchsorted(starts, begins)
    n = np.diff(first)
    runs = np.where(n > 0, np.maximum(n - RUN + 1, 1), 0)
    owners = np.repeat(np.arange(len(texts)), runs)
    at = np.arange(runs.sum()) + np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs)
    end = np.repeat(first[1:], runs)
    terms, padded = np.zeros(len(at), np.uint64), np.append(words, np.zeros(RUN, np.uint64))
    for j in range(RUN):
        terms = np.where(at + j < end, terms * _FACTOR + padded[at + j], terms)
    votes = RUN_WEIGHT * _votes(terms, owners, len(texts)) + _votes(words, np.repeat(np.arange(len(texts)), n), len(texts))
    return np.packbits(2 * votes > (RUN_WEIGHT * runs + n)[:, None], axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal bits of fingerprints."""
    return 1 - np.bitwise_count(a ^ b).sum(axis=-1) / BITS


# Each text beside its edited text and the next one.

_COMPARED = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _hex(prints: np.ndarray) -> list[str]:
    return [p.tobytes().hex() for p in prints]


def _beside(ids: Sequence[int | None], texts: list[str], following: list[str]) -> dict:
    """The results of some texts and the texts that follow them."""
    halves = [len(t) // 2 for t in texts]
    edited = [(t[:len(t) - h] + f[:h]).encode() for t, f, h in zip(texts, following, halves)]
    # Most texts follow another one of them.
    distinct = list(dict.fromkeys([*texts, *following]))
    place = {t: i for i, t in enumerate(distinct)}
    prints = fingerprints([*(t.encode() for t in distinct), *edited])
    own, other = (prints[[place[t] for t in some]] for some in (texts, following))
    changed = prints[len(distinct):]
    return {"doc_id": pa.array(ids, pa.int64()), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            "edited_sha256": [hashlib.sha256(e).hexdigest() for e in edited], "fingerprint": _hex(own),
            "edited_fingerprint": _hex(changed), "near_edited": likeness(own, changed), "near_next": likeness(own, other)}


def _stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a sorted stretch but its last, whose next text is elsewhere; the ends give their texts."""
    held: tuple[list, list] = ([], [])
    part, head = None, None
    for batch in _batches(batches, "text"):
        ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
        if part is None:
            part, head = batch["part"][0].as_py(), texts[0]
        ids, texts = held[0] + ids, held[1] + texts
        held = ids[-1:], texts[-1:]
        if len(texts) > 1:
            found = _beside(ids[:-1], texts[:-1], texts[1:])
            none = pa.nulls(len(texts) - 1, pa.string())
            yield pa.RecordBatch.from_pydict(found | {"part": pa.nulls(len(texts) - 1, pa.int32()), "head": none, "tail": none})
    if part is not None:
        empty = {name: pa.nulls(1, kind) for name, kind in (("n_chars", pa.int64()), *((c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")),
                                                            ("near_edited", pa.float64()), ("near_next", pa.float64()))}
        yield pa.RecordBatch.from_pydict({"doc_id": pa.array(held[0], pa.int64()), **empty, "part": pa.array([part], pa.int32()), "head": [head], "tail": held[1]})


def compared(docs: DataFrame, key: str = "doc_id", text: str = "text", part_bytes: int = rows.PART_BYTES) -> DataFrame:
    """Per row its fingerprint, that of its edited text, and their likeness and that to the next document's.

    Texts lie in stretches of the descending key, each sorted in a task of its
    own, and are shuffled once. The last row of a stretch meets the first of the
    next one in a join of one row a stretch.
    """
    dealt = rows.in_order(docs, key, text, descending=True, part_bytes=part_bytes).select("doc_id", "text", F.spark_partition_id().alias("part"))
    found = rows.stored(dealt.mapInArrow(_stretch, f"{_COMPARED}, part int, head string, tail string"), "fingerprints")

    ends = found.filter("part is not null")
    around = Window.orderBy("part")
    # One number a stretch; after the last comes the first.
    after = ends.select("part", F.coalesce(F.lead("part").over(around), F.first("part").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next"))
    heads = ends.select(F.col("part").alias("next"), F.col("head").alias("following"))
    last = ends.select("doc_id", "part", "tail").join(after, "part").join(heads, "next").select("doc_id", "tail", "following")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, "tail"):
            yield pa.RecordBatch.from_pydict(_beside(*(batch[c].to_pylist() for c in ("doc_id", "tail", "following"))))

    return found.filter("part is null").drop("part", "head", "tail").unionByName(last.mapInArrow(close, _COMPARED))


# Fingerprints within a radius.

_WORDS = [f"w{i}" for i in range(BITS // 64)]


def _words(hexed: Column) -> list[Column]:
    """The 64-bit words of a fingerprint in hexadecimal digits."""
    half = lambda i: F.conv(F.substring(hexed, 8 * i + 1, 8), 16, 10).cast("long")
    return [F.shiftleft(half(2 * i), 32).bitwiseOR(half(2 * i + 1)).alias(w) for i, w in enumerate(_WORDS)]


def _digits() -> Column:
    """The hexadecimal digits of a fingerprint from its words."""
    return F.concat(*[F.lpad(F.hex(w), 16, "0") for w in _WORDS])


def _distance(a: str, b: str) -> Column:
    return reduce(Column.__add__, [F.bit_count(F.col(f"{a}.{w}").bitwiseXOR(F.col(f"{b}.{w}"))) for w in _WORDS])


def _tables(members: DataFrame, cuts: list[int]) -> DataFrame:
    """The members once for each block of their remaining digits: ``key`` stands for the blocks agreed on so far.

    Members without ``rest`` have agreed on nothing yet, and all digits remain.
    """
    rest = F.col("rest") if "rest" in members.columns else _digits()
    blocks = [F.struct(F.lit(i).alias("block"), F.xxhash64("key", F.lit(i), F.substring(rest, a + 1, b - a)).alias("key")) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    kept = [c for c in members.columns if c != "key"]
    return members.select(*kept, F.explode(F.array(*blocks)).alias("_b")).select(*kept, "_b.block", "_b.key")


def _joined(bucket: pa.Table, radius: int) -> pa.Table:
    """Links from the least id of each class inside a bucket to the others of it; a class grows by what is near its members."""
    bucket = bucket.sort_by("id")
    ids = bucket["id"].to_numpy()
    words = np.stack([bucket[w].to_numpy() for w in _WORDS], axis=1).view(np.uint64)
    open_, x, y = np.arange(len(ids)), [], []
    while len(open_):
        first, open_ = open_[0], open_[1:]
        reached = [first]
        while reached and len(open_):
            near = np.bitwise_count(words[open_] ^ words[reached.pop()]).sum(axis=1) <= radius
            reached += (found := open_[near]).tolist()
            open_ = open_[~near]
            x += [ids[first]] * len(found)
            y += ids[found].tolist()
    return pa.table({"x": pa.array(x, pa.int64()), "y": pa.array(y, pa.int64())})


def classes(prints: DataFrame, radius: int = RADIUS, few: int = FEW, many: int = MANY) -> DataFrame:
    """``id, component`` of fingerprints that have another one within the radius; classes are closed under such links.

    ``prints`` has ``id`` (long, unique) and ``fingerprint`` (64 hexadecimal
    digits, distinct). There is a table for each of radius + 1 blocks, keyed by
    it. The pairs of a bucket of up to ``few`` members come from a join; one of up
    to ``many`` gives its classes from a task of its own, a link a member at most.
    In a larger one all are compared with its least id; where it still holds
    several classes, its members go on to tables over the remaining digits, which
    tell more of them apart. So no link between classes is lost, whatever a
    bucket holds. Where a block would have fewer than three digits, members agree
    on three quarters of all and their buckets are not split further.
    """
    length = BITS // 4
    members = prints.select("id", *_words(F.col("fingerprint")), F.lit(0).cast("long").alias("key"))
    links: DataFrame | None = None
    while True:
        cuts = [length * i // (radius + 1) for i in range(radius + 2)]
        last = length < LEAST_DIGITS * (radius + 1)
        dealt = _tables(members, cuts)
        shared = rows.stored(dealt.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
        live = rows.stored(dealt.join(shared, "key"), "members")
        small = live.filter(F.col("n") <= few)
        pairs = small.alias("a").join(small.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id")) & (_distance("a", "b") <= radius))
        middle = live.filter(F.col("n") > few) if last else live.filter(F.col("n").between(few + 1, many))
        joined = middle.select("key", "id", *_WORDS).groupBy("key").applyInArrow(lambda bucket: _joined(bucket, radius), "x long, y long")
        found = [pairs.select(F.col("a.id").alias("x"), F.col("b.id").alias("y")), joined]
        large = live.filter(F.col("n") > many)
        if not last and not large.isEmpty():
            least = large.groupBy("key").agg(F.min(F.struct("id", *_WORDS)).alias("least"))
            found.append(large.join(least, "key").alias("a").filter((F.col("id") != F.col("least.id")) & (_distance("a", "a.least") <= radius))
                         .select(F.col("least.id").alias("x"), F.col("id").alias("y")))
        new = rows.stored(reduce(DataFrame.unionByName, found).distinct(), "near")
        links = new if links is None else links.unionByName(new)
        labels = components(links, "x", "y")
        if len(found) < 3:
            return labels
        large = rows.stored(large.join(labels, "id", "left").withColumn("mine", F.coalesce("component", "id")), "large")
        several = large.groupBy("key").agg(F.min("mine").alias("lo"), F.max("mine").alias("hi")).filter("lo < hi").select("key")
        starts, ends = (F.element_at(F.array(*[F.lit(c) for c in some]), F.col("block") + 1) for some in (cuts[:-1], cuts[1:]))
        rest = F.col("rest") if "rest" in large.columns else _digits()
        rest = F.concat(F.substr(rest, F.lit(1), starts), F.substr(rest, ends + 1))
        length -= min(b - a for a, b in zip(cuts, cuts[1:]))
        members = rows.stored(large.join(several, "key", "left_semi").select("id", *_WORDS, "key", rest.alias("rest")), "members")


def fingerprinted(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``compared`` with ``near_class``, the least id of those whose fingerprints are linked within the radius."""
    found = rows.stored(compared(docs, key, text), "compared")
    prints = rows.numbered(found.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "prints", "id")
    linked = classes(prints.select("id", "fingerprint"), radius)
    grouped = prints.join(linked, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = grouped.groupBy("component").agg(F.min("least").alias("near_class"))
    named = grouped.join(least, "component").select("fingerprint", "near_class")
    return found.join(named, "fingerprint").select(*found.columns, "near_class")
