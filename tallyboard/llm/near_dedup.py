"""Near-duplicate detection by consistent weighted sampling.

A text is the multiset of its runs of five words, each weighted by how often it
occurs there (tf) and how rare it is among the documents (idf). Improved
consistent weighted sampling draws from each text samples that two texts share
with the probability of their weighted Jaccard similarity; bands of samples are
the buckets. In a bucket, every text is compared with one of them, the first, by
the weighted Jaccard similarity of the whole texts. Those that are not like it go
on to smaller buckets, of that band and one more, so that a bucket which holds
several groups comes apart without all its pairs. Links make components. Where a
bucket is still in several components then, its texts are joined exactly: two
texts as similar as asked share one of the rarest runs of each, by weight a known
part of the text, and all pairs that do so are compared.

Inverse document frequency here tells common runs from others. A run in fewer
than ``COMMON`` of the documents has the full weight; the frequencies of the
others are counted over all documents. There are never more than the mean number
of runs in a text divided by ``COMMON`` of them, whatever the input, and that is
what is broadcast. Weights fall to ``IDF_FLOOR`` and no further, since a large group of
near copies makes its own runs common, and would otherwise hide itself: two
texts of a group that holds a third of all, and share 86 % of their runs, are still alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rows
from .components import components
from .hashing import counted, mix, shingles
from .token_store import _batches

WORDS = 5
SIMILARITY = 0.8
BANDS, SAMPLES = 12, 4
COMMON = 0.01
IDF_FLOOR = 0.6
#: How often buckets that hold unlike texts are split by one more band.
SPLITS = 2
#: Counters by which the exact join tells rare runs from others.
COUNTERS = 1 << 16
#: Room for rounding in bounds on weights.
_SLACK = 1e-6
#: Documents a chunk has at least when common runs are looked for.
CHUNK = 1000
_AT_ONCE = 1 << 16
_LEVELS = 1 << 16


def _encoded(texts: pa.Array) -> list[bytes]:
    return [(t or "").encode("utf-8", "replace") for t in texts.to_pylist()]


def _common_runs(docs: DataFrame, total: int) -> dict[str, np.ndarray]:
    """Runs in at least ``COMMON`` of all documents, ascending, with the number of documents that have them.

    A run that is common among all is half as common at least in chunks that add
    up to half of that. So chunks name their runs from half the share on, the sums
    from half the total on are few, and those are counted exactly.
    """
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list[np.ndarray], n: int) -> pa.RecordBatch:
            runs, uses = np.unique(np.concatenate(found), return_counts=True)
            mine = uses >= n * COMMON / 2
            return pa.RecordBatch.from_arrays([pa.array(runs[mine].view(np.int64)), pa.array(uses[mine])], ["run", "uses"])

        found, n, last = [], 0, None
        for batch in _batches(batches, "text"):
            found.append(counted(*shingles(_encoded(batch["text"]), WORDS))[0])
            n += len(batch)
            if n >= CHUNK:
                if last:
                    yield out(*last)
                last, found, n = (found, n), [], 0
        # What is left at the end joins the last chunk: small chunks would name too much.
        if last or n:
            yield out((last[0] if last else []) + found, (last[1] if last else 0) + n)

    least = total * COMMON
    named = docs.select("text").mapInArrow(name, "run long, uses long").groupBy("run").agg(F.sum("uses").alias("uses"))
    few = np.sort(np.array([r["run"] for r in named.filter(F.col("uses") >= least / 2).collect()], np.int64).view(np.uint64))
    if not len(few):
        return {"runs": few, "uses": np.empty(0, np.int64)}
    sent = docs.sparkSession.sparkContext.broadcast(few)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses = np.zeros(len(sent.value), np.int64)
        for batch in _batches(batches, "text"):
            runs = counted(*shingles(_encoded(batch["text"]), WORDS))[0]
            at = np.minimum(np.searchsorted(sent.value, runs), len(uses) - 1)
            uses += np.bincount(at[sent.value[at] == runs], minlength=len(uses))
        has = np.flatnonzero(uses)
        yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(uses[has])], ["at", "uses"])

    sums = docs.select("text").mapInArrow(count, "at long, uses long").groupBy("at").agg(F.sum("uses").alias("uses"))
    found = np.array(sorted((r["at"], r["uses"]) for r in sums.filter(F.col("uses") >= least).collect()), np.int64).reshape(-1, 2)
    return {"runs": few[found[:, 0]], "uses": found[:, 1]}


class Weights:
    """Weight of a run: 1 for rare ones, towards the floor for those in nearly all documents."""

    def __init__(self, common: dict[str, np.ndarray], total: int):
        self.runs = common["runs"]
        idf = np.log(total / np.maximum(common["uses"], 1)) / np.log(1 / COMMON)
        self.values = (IDF_FLOOR + (1 - IDF_FLOOR) * np.clip(idf, 0, 1)).astype(np.float32)

    def of(self, runs: np.ndarray) -> np.ndarray:
        out = np.ones(len(runs), np.float32)
        if len(self.runs):
            at = np.minimum(np.searchsorted(self.runs, runs), len(self.runs) - 1)
            hit = self.runs[at] == runs
            out[hit] = self.values[at[hit]]
        return out


def _quantiles() -> tuple[np.ndarray, np.ndarray]:
    """Gamma(2, 1) by quantile, and its logarithm: what the sampling draws, by 16 bits."""
    x = np.concatenate([np.geomspace(1e-4, 0.05, 4000)[:-1], np.linspace(0.05, 20, 200_000)])
    cdf = 1 - (1 + x) * np.exp(-x)
    gamma = np.interp((np.arange(_LEVELS) + 0.5) / _LEVELS, cdf, x)
    return gamma.astype(np.float32), np.log(gamma).astype(np.float32)


def signatures(runs: np.ndarray, weights: np.ndarray, offsets: np.ndarray, samples: int) -> np.ndarray:
    """Samples of weighted sets: a row for each sample, a column for each set that has runs.

    For a run of weight S, each sample draws r and c from Gamma(2, 1) and b
    uniformly, all from the run itself: t = floor(ln S / r + b),
    ln a = ln c - r (t - b + 1). The sample is the run with the least a, and its t.
    """
    gamma, log_gamma = _GAMMA
    out = np.zeros((samples, len(offsets) - 1), np.uint64)
    log_weights = np.log(weights).astype(np.float32)
    low = np.uint64(_LEVELS - 1)
    for k in range(samples):
        x = mix(runs + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        r, b = gamma[x & low], ((x >> np.uint64(32)) & low).astype(np.float32) / np.float32(_LEVELS)
        t = np.floor(log_weights / r + b)
        a = log_gamma[(x >> np.uint64(16)) & low] - r * (t - b + 1)
        least = np.minimum.reduceat(a, offsets[:-1])
        hits = np.flatnonzero(a == np.repeat(least, np.diff(offsets)))
        at = hits[np.searchsorted(hits, offsets[:-1])]
        out[k] = mix(x[at] + t[at].astype(np.int64).view(np.uint64))
    return out


_GAMMA = _quantiles()


def _bands(texts: list[bytes], weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    """The keys of each text's bands, a row for each text, and the texts' weights; texts without words have the same keys in all."""
    runs, uses, offsets = counted(*shingles(texts, WORDS))
    keys = np.zeros((len(texts), BANDS), np.uint64)
    full = np.flatnonzero(np.diff(offsets))
    value = weights.of(runs) * uses.astype(np.float32)
    # So many runs at once as the caches hold.
    ends = offsets[full + 1]
    cuts = np.flatnonzero(np.diff(ends // _AT_ONCE)) + 1
    for part in np.split(full, cuts):
        if len(part):
            a, b = offsets[part[0]], offsets[part[-1] + 1]
            drawn = signatures(runs[a:b], value[a:b], np.append(offsets[part], b) - a, BANDS * SAMPLES)
            for band in range(BANDS):
                key = np.full(len(part), band + 1, np.uint64)
                for row in drawn[band * SAMPLES:(band + 1) * SAMPLES]:
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + row)
                keys[part, band] = key
    return keys, np.bincount(np.repeat(np.arange(len(texts)), np.diff(offsets)), value, len(texts))


def _digest(text: bytes) -> bytes:
    return hashlib.blake2b(b" ".join(text.split()), digest_size=16).digest()


def similarity(a: bytes, b: bytes, weights: Weights) -> float:
    """Weighted Jaccard similarity of two texts."""
    return _similarity(_weighted(a, weights), _weighted(b, weights))


def _weighted(text: bytes, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    runs, uses, _ = counted(*shingles([text], WORDS))
    return runs, weights.of(runs).astype(np.float64) * uses


def _similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    both = b[0][at] == a[0]
    shared = np.minimum(a[1][both], b[1][at[both]]).sum()
    return float(shared / (a[1].sum() + b[1].sum() - shared))


def _first_in_bucket(members: DataFrame) -> DataFrame:
    """Members (``row_id, weight, key, mask``) with the ``head`` of their bucket, if they are not it.

    The head is the lightest: texts that share a passage and little else are most like the one that has least beside it.
    """
    heads = members.groupBy("key").agg(F.min(F.struct("weight", "row_id")).alias("head"), F.count("*").alias("n")).filter("n > 1")
    heads = rows.stored(heads.select("key", F.col("head.row_id").alias("head")), "heads")
    return members.join(heads, "key").filter(F.col("row_id") != F.col("head"))


def _compare(pairs: DataFrame, texts: DataFrame, weights) -> DataFrame:
    """``row_id, head, alike`` of distinct pairs, by their whole texts."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None
        for batch in batches:
            out = []
            for head, text, head_text in zip(*[batch[c].to_pylist() for c in ("head", "text", "head_text")]):
                if head != last:
                    last, kept = head, _weighted((head_text or "").encode("utf-8", "replace"), weights.value)
                out.append(_similarity(_weighted((text or "").encode("utf-8", "replace"), weights.value), kept) >= SIMILARITY)
            yield pa.RecordBatch.from_arrays([batch["row_id"], batch["head"], pa.array(out, pa.bool_())], ["row_id", "head", "alike"])

    # Texts are no side to broadcast, however few they are here: the plan is that of a large table.
    heads = texts.select(F.col("row_id").alias("head"), F.col("text").alias("head_text"))
    both = pairs.hint("merge").join(texts, "row_id").hint("merge").join(heads, "head")
    return rows.stored(both.select("row_id", "head", "text", "head_text").mapInArrow(compare, "row_id long, head long, alike boolean"), "compared")


def _buckets(signed: DataFrame, masks) -> DataFrame:
    """Members ``row_id, weight, key, mask`` of the buckets that each row's sets of bands (bits of a mask) name: all keys of the set in one."""
    each = signed.withColumn("mask", F.explode(masks))
    own = F.filter("keys", lambda _, band: F.getbit(F.col("mask"), band) == 1)
    return each.select("row_id", "weight", F.xxhash64("mask", own).alias("key"), "mask")


def _run_uses(texts: DataFrame) -> np.ndarray:
    """How many of the texts have the runs of each counter."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses = np.zeros(COUNTERS, np.int64)
        for batch in _batches(batches, "text"):
            runs = counted(*shingles(_encoded(batch["text"]), WORDS))[0]
            uses += np.bincount((runs % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        has = np.flatnonzero(uses)
        yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(uses[has])], ["at", "uses"])

    out = np.zeros(COUNTERS, np.int64)
    for r in texts.select("text").mapInArrow(count, "at long, uses long").groupBy("at").agg(F.sum("uses").alias("uses")).collect():
        out[r["at"]] = r["uses"]
    return out


def _prefix(texts: list[bytes], weights: Weights, uses: np.ndarray) -> tuple[np.ndarray, ...]:
    """The rarest runs of each text (a repeated run counts as several): text, run, weight of the text, weight of this and all less rare runs.

    A text shares ``SIMILARITY`` of its weight at least with one that is alike, so
    the rarest shared run has that much of the weight from there on. The order
    is the same for all texts; that it is by rarity is for speed only.
    """
    runs, times, offsets = counted(*shingles(texts, WORDS))
    at = np.repeat(np.arange(len(runs)), times)
    copy = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))[at]
    token = mix(runs[at] + copy.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.lexsort((token, uses[(runs[at] % np.uint64(COUNTERS)).astype(np.int64)], row))
    row, token, value = row[order], token[order], weights.of(runs).astype(np.float64)[at[order]]
    weight = np.bincount(row, value, len(texts))
    before = np.cumsum(value) - value
    left = weight[row] - (before - (np.cumsum(weight) - weight)[row])
    kept = left >= SIMILARITY * weight[row] * (1 - _SLACK)
    return row[kept], token[kept], weight[row[kept]], left[kept]


def _near_pairs(rest: DataFrame, texts: DataFrame, weights) -> DataFrame:
    """``row_id, head`` of all pairs of rows of ``rest`` (``row_id, component``) in two components that can be alike.

    Of the lighter text the rarest shared run comes earlier still: the shared
    weight is S / (1 + S) of both texts' together, or 2 S / (1 + S) of the lighter.
    """
    mine = rows.stored(texts.hint("merge").join(rest, "row_id"), "rest-texts")
    uses = mine.sparkSession.sparkContext.broadcast(_run_uses(mine))

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, "text"):
            row, token, weight, left = _prefix(_encoded(batch["text"]), weights.value, uses.value)
            light = left >= 2 * SIMILARITY / (1 + SIMILARITY) * weight * (1 - _SLACK)
            ids, component = (batch[c].to_numpy()[row] for c in ("row_id", "component"))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, component, token.view(np.int64), weight, left, light)], ["row_id", "component", "token", "weight", "left", "light"])

    schema = "row_id long, component long, token long, weight double, left double, light boolean"
    found = rows.stored(mine.select("row_id", "component", "text").mapInArrow(prefix, schema), "prefixes")
    wanted = found.groupBy("token").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.max("light").alias("light")).filter("light AND least < most")
    found = rows.stored(found.join(wanted.select("token"), "token"), "shared-prefixes")
    a, b = found.alias("a"), found.filter("light").alias("b")
    share = SIMILARITY / (1 + SIMILARITY) * (1 - _SLACK)
    near = (f"a.token = b.token AND a.component <> b.component AND (b.weight < a.weight OR b.weight = a.weight AND b.row_id < a.row_id) "
            f"AND b.weight >= a.weight * {SIMILARITY * (1 - _SLACK)!r} AND least(a.left, b.left) >= (a.weight + b.weight) * {share!r}")
    return rows.stored(a.join(b, F.expr(near)).select("a.row_id", F.col("b.row_id").alias("head")).distinct(), "near-pairs")


def _classes(table: DataFrame, weights) -> DataFrame:
    """``id, component`` of rows with equal or similar texts, connected by links."""
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, "text"):
            texts = _encoded(batch["text"])
            keys, weight = _bands(texts, weights.value)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch["row_id"], pa.array(weight), pa.array([_digest(t) for t in texts], pa.binary()), lists], ["row_id", "weight", "digest", "keys"])

    signed = rows.stored(table.select("row_id", "text").mapInArrow(sample, "row_id long, weight double, digest binary, keys array<long>"), "signatures")
    # Equal texts are linked by their digest, and one of them goes through the bands.
    equal = signed.groupBy("digest").agg(F.min("row_id").alias("head"), F.count("*").alias("n")).filter("n > 1").select("digest", "head")
    equal = rows.stored(equal, "equal-heads")  # a stage of its own, so that the join can be split where many are equal
    links = rows.stored(signed.select("row_id", "digest").join(equal, "digest").filter("row_id <> head").select("row_id", "head"), "equal")
    signed = rows.stored(signed.drop("digest").join(links.select("row_id"), "row_id", "left_anti"), "distinct-signatures")
    alone = [F.lit(1 << band).cast("long") for band in range(BANDS)]
    members = _buckets(signed, F.array(*alone))
    texts, first = None, None
    for level in range(SPLITS + 1):
        met = rows.stored(_first_in_bucket(members), "met")
        first = met if first is None else first
        pairs = rows.stored(met.select("row_id", "head").distinct(), "candidates")
        if texts is None:
            # All that is compared later is among these.
            asked = pairs.select("row_id").union(pairs.select("head")).distinct()
            texts = rows.stored(table.select("row_id", "text").hint("merge").join(asked, "row_id"), "candidate-texts")
        compared = _compare(pairs, texts, weights)
        links = links.union(compared.filter("alike").select("row_id", "head"))
        if level == SPLITS:
            break
        rest = met.join(compared.filter("NOT alike").select("row_id", "head"), ["row_id", "head"])
        rest = rest.groupBy("row_id").agg(F.collect_set("mask").alias("masks"))  # a bit for each band: no more than there are sets of bands
        if rest.isEmpty():
            break
        wider = F.flatten(F.transform("masks", lambda m: F.filter(F.array(*[m.bitwiseOR(b) for b in alone]), lambda w: w != m)))
        members = _buckets(signed.join(rest, "row_id"), F.array_distinct(wider))

    # All are compared with the head of a bucket, not with each other: one component, or the pairs between its components are open.
    labels = components(links, "row_id", "head")
    placed = first.join(labels.withColumnRenamed("id", "row_id"), "row_id", "left").select("key", "row_id", F.coalesce("component", "row_id").alias("component"))
    placed = rows.stored(placed, "placed")
    several = placed.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least < most")
    rest = rows.stored(placed.join(several.select("key"), "key").select("row_id", "component").distinct(), "rest")
    if rest.isEmpty():
        return labels
    compared = _compare(_near_pairs(rest, texts, weights), texts, weights)
    return components(labels.select(F.col("id").alias("row_id"), F.col("component").alias("head")).union(compared.filter("alike").select("row_id", "head")), "row_id", "head")


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """One row per row of ``docs``: the key, ``class_id``, ``class_size``, ``kept``.

    A class holds texts that are connected by equality (white space aside) or by
    a weighted Jaccard similarity of ``SIMILARITY`` or more. ``class_id`` is its
    least key (null keys after all others), and the row that has it stays; of rows
    equal in key any one. A null text is empty; empty texts are equal. Other
    columns are ignored, or returned whole as ``row`` with ``carry``.
    """
    spark = docs.sparkSession
    if carry:
        table = rows.numbered(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), "rows")
        table = table.select("row_id", F.col("row")[key].alias("doc_id"), rows.whole(F.col("row")[text]).alias("text"), "row")
    else:
        table = rows.numbered(docs.select(F.col(key).alias("doc_id"), rows.whole(text).alias("text")), "documents")
    total = table.count()
    weights = spark.sparkContext.broadcast(Weights(_common_runs(table, max(1, total)), max(1, total)))
    classes = _classes(table, weights).withColumnRenamed("id", "row_id")

    heads = table.select("row_id", "doc_id", *(["row"] if carry else []))
    members = rows.stored(classes.join(heads.select("row_id", "doc_id"), "row_id"), "members")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_id"))).alias("first")
    groups = rows.stored(members.groupBy("component").agg(first, F.count("*").alias("class_size")), "classes")
    placed = members.join(groups, "component").select(
        "row_id", F.col("first.doc_id").alias("class_id"), "class_size", (F.col("row_id") == F.col("first.row_id")).alias("kept"))
    single = F.col("kept").isNull()
    return (heads.hint("merge") if carry else heads).join(placed, "row_id", "left").select(
        *(["row"] if carry else []), F.col("doc_id").alias(key),
        F.when(single, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"), F.coalesce("kept", F.lit(True)).alias("kept"))
