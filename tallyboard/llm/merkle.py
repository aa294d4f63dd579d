"""A manifest of a dataset: a tree of SHA-256 digests whose parents keep the states of their hash.

Each row is a leaf. The leaves of a group (a language) form a tree, in the order
of their key: runs of eight nodes become their digest until one is left. The
roots of all groups form one more tree in the same way. A parent keeps the state
of its hash before each child, so a changed child is folded by resuming that
state with the new digest and the siblings to the right of it; what is left of
it is never hashed again, and no other text is read.

A tree is built in chunks of 4,096 leaves, each an independent group of a task;
the roots of the chunks are the leaves of the next tier. A leaf is folded inside
its chunk and then along the path of the chunk, which all its leaves share. A
chunk and a path have a bounded size, whatever the group holds.

Nulls, ties: a null field counts as ``-`` and a null group is a group of its
own, the first. Rows with a null key come first; rows with equal keys follow by
their digest. Repeated rows are leaves of their own. An empty table has no rows
and a null root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import position
from . import rows, sha256

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 8
#: Levels of a chunk, and the leaves that it has at most.
LEVELS = 4
SPAN = FAN ** LEVELS

_CHUNK = "tree bigint, chunk bigint, total bigint, n int, nodes binary, states binary, root binary"
_STEP = struct.Struct("<BB")


def digest(fields: dict[str, Column]) -> Column:
    """The SHA-256 of the fields, as bytes: ``-`` for a null, else its length in bytes, a colon and the value."""
    def framed(value: Column) -> Column:
        written = value.cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written))

    return F.unhex(F.sha2(F.concat(*[framed(value) for value in fields.values()]), 256))


# The tree of one chunk.

def _sizes(n: int, alone: bool) -> list[int]:
    """Nodes of each level from the leaves up. A chunk that is a whole tree stops at one node, others have all levels."""
    out = [n]
    while out[-1] > 1 if alone else len(out) <= LEVELS:
        out.append(-(-out[-1] // FAN))
    return out


def grow(leaves: np.ndarray, alone: bool) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Digests (n, 32) of each level, and of each level but the last the states (8, n) before each node."""
    levels, states = [leaves], []
    for n_parents in _sizes(len(leaves), alone)[1:]:
        level, kept = levels[-1], np.empty((8, len(levels[-1])), np.uint32)
        now = sha256.begin(n_parents)
        for slot in range(min(FAN, len(level))):
            mine = level[slot::FAN]
            kept[:, slot::FAN] = now[:, :len(mine)]
            now[:, :len(mine)] = sha256.take(now[:, :len(mine)], mine)
        parents = sha256.finish(now, FAN)
        if len(level) % FAN:
            parents[-1:] = sha256.finish(now[:, -1:], len(level) % FAN)
        levels.append(parents)
        states.append(kept)
    return levels, states


@dataclass
class _Chunk:
    levels: list[np.ndarray]
    states: list[np.ndarray]

    @classmethod
    def of(cls, n: int, nodes: bytes, states: bytes, alone: bool) -> _Chunk:
        cuts = np.cumsum(_sizes(n, alone))
        return cls(np.split(np.frombuffer(nodes, np.uint8).reshape(-1, 32), cuts[:-1]),
                   np.split(sha256.unpacked(states), cuts[:-2], axis=1) if len(cuts) > 1 else [])

    def steps(self, at: int) -> bytes:
        """The way from a leaf to the root of the chunk: of each level the state before the node, and its siblings."""
        out = []
        for level, kept in zip(self.levels, self.states):
            first = at - at % FAN
            left, right = level[first:at], level[at + 1:first + FAN]
            out += [_STEP.pack(len(left), len(right)), sha256.packed(kept[:, at:at + 1]), left.tobytes(), right.tobytes()]
            at //= FAN
        return b"".join(out)

    def siblings(self, at: int) -> list[bytes]:
        """The siblings on that way as hex text, left to right and level by level."""
        out = []
        for level in self._texts():
            first = at - at % FAN
            out += [level[64 * first:64 * at], level[64 * (at + 1):64 * (first + FAN)]]
            at //= FAN
        return out

    def _texts(self) -> list[bytes]:
        if not hasattr(self, "texts"):
            self.texts = [sha256.text(level).tobytes() for level in self.levels[:-1]]
        return self.texts

    def fold(self, at: np.ndarray, digests: np.ndarray) -> np.ndarray:
        """The root for each replacement of a leaf by a digest; each resumes the state that its parent kept."""
        for level, kept in zip(self.levels, self.states):
            last = np.minimum(at - at % FAN + FAN, len(level))  # of its run
            now = sha256.take(kept[:, at], digests)
            for ahead in range(1, FAN):
                more = np.flatnonzero(at + ahead < last)
                if len(more):
                    now[:, more] = sha256.take(now[:, more], level[at[more] + ahead])
            digests, taken = np.empty_like(digests), last - (at - at % FAN)
            for n in np.unique(taken):
                digests[taken == n] = sha256.finish(now[:, taken == n], int(n))
            at = at // FAN
        return digests


def _walk(path: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """State, left and right siblings of each step of a path."""
    at = 0
    while at < len(path):
        left, right = _STEP.unpack_from(path, at)
        cuts = np.cumsum([at + _STEP.size, 32, 32 * left, 32 * right])
        state, before, after = (path[a:b] for a, b in zip(cuts, cuts[1:]))
        yield sha256.unpacked(state), *(np.frombuffer(x, np.uint8).reshape(-1, 32) for x in (before, after))
        at = int(cuts[-1])


def fold_path(path: bytes, digests: np.ndarray) -> np.ndarray:
    """The root for each replacement of the node at the start of the path by a digest."""
    for state, left, right in _walk(path):
        now = sha256.take(np.repeat(state, len(digests), axis=1), digests)
        for sibling in right:
            now = sha256.take(now, sibling[None])
        digests = sha256.finish(now, len(left) + 1 + len(right))
    return digests


# Tables of chunks.

def _build(table: pa.Table) -> pa.Table:
    """One row of a chunk from its leaves."""
    table = table.sort_by("pos")
    first = {name: table[name][0].as_py() for name in ("tree", "chunk", "total")}
    leaves = np.frombuffer(b"".join(table["digest"].to_pylist()), np.uint8).reshape(-1, 32)
    levels, states = grow(leaves, first["total"] <= SPAN)
    return pa.table({**{name: pa.array([v], pa.int64()) for name, v in first.items()}, "n": pa.array([len(leaves)], pa.int32()),
                     "nodes": [b"".join(level.tobytes() for level in levels)], "states": [b"".join(map(sha256.packed, states))],
                     "root": [levels[-1].tobytes()]})


def _tiers(leaves: DataFrame, name: str) -> list[DataFrame]:
    """Chunks of the trees of ``leaves`` (tree, pos, total, digest), then chunks over the roots of chunks, up to one a tree."""
    tiers = []
    while True:
        cut = leaves.select("tree", F.floor(F.col("pos") / SPAN).alias("chunk"), "pos", "total", "digest")
        tiers.append(rows.stored(cut.groupBy("tree", "chunk").applyInArrow(_build, _CHUNK), name))
        above = tiers[-1].filter(F.col("total") > SPAN)
        if above.isEmpty():
            return tiers
        leaves = above.select("tree", F.col("chunk").alias("pos"), F.ceil(F.col("total") / SPAN).alias("total"), F.col("root").alias("digest"))


def _tops(tiers: Sequence[DataFrame]) -> DataFrame:
    """``tree, digest``: the root of each tree."""
    tops = [t.filter(F.col("total") <= SPAN).select("tree", F.col("root").alias("digest")) for t in tiers]
    out = tops[0]
    for more in tops[1:]:
        out = out.unionByName(more)
    return out


def _leaf_paths(chunks: DataFrame) -> DataFrame:
    """``tree, pos, path`` of every leaf of the chunks, from the leaf to the end of the chunk's own path."""
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk.of(row["n"], row["nodes"], row["states"], row["total"] <= SPAN)
                for start in range(0, row["n"], 256):
                    here = range(start, min(start + 256, row["n"]))
                    yield pa.RecordBatch.from_pydict({
                        "tree": pa.array([row["tree"]] * len(here), pa.int64()), "pos": pa.array([row["chunk"] * SPAN + i for i in here], pa.int64()),
                        "path": pa.array([chunk.steps(i) + row["path"] for i in here], pa.binary())})

    return chunks.mapInArrow(expand, "tree bigint, pos bigint, path binary")


def _paths(tiers: Sequence[DataFrame], base: DataFrame, name: str) -> DataFrame:
    """The chunks of the lowest tier with the path from the root of each; ``base`` has those of the trees (tree, path)."""
    above = None
    for tier in reversed(tiers):
        here = tier.filter(F.col("total") <= SPAN).join(base, "tree")
        if above is not None:
            down = _leaf_paths(above).withColumnRenamed("pos", "chunk")
            here = here.unionByName(tier.filter(F.col("total") > SPAN).join(down, ["tree", "chunk"]), allowMissingColumns=True)
        above = rows.stored(here, name)
    return above


@dataclass
class Manifest:
    """The written tables of a tree over a dataset."""

    leaves: DataFrame  #: a row each: key, tree, pos, digest, and the replacements asked for
    chunks: DataFrame  #: of the groups' trees: nodes, states, and the path to the root of the whole
    groups: DataFrame  #: tree, the group's value, total, subroot
    root: bytes | None
    key: str


def build(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", key: str = "doc_id",
          replacements: dict[str, dict[str, Column]] | None = None) -> Manifest:
    """The manifest of the rows.

    ``replacements`` names digests of changed rows, to be folded later: of each,
    the changed fields. Only digests are shuffled; texts are read once.
    """
    spark = docs.sparkSession
    own = {f: F.col(f) for f in fields}
    hashed = docs.select(F.col(key).alias("key"), F.col(group).alias("group"), digest(own).alias("digest"),
                         *[digest(own | changed).alias(name) for name, changed in (replacements or {}).items()])
    hashed = rows.numbered(hashed, "leaves")
    counted = rows.stored(hashed.groupBy("group").agg(F.count("*").alias("total")), "groups")
    groups = position(counted.withColumn("all", F.lit(0)), "all", ["group"], "tree").drop("all")
    groups = rows.stored(groups, "groups")
    named = groups.withColumnRenamed("group", "_group")
    placed = hashed.join(named, F.col("group").eqNullSafe(F.col("_group"))).drop("_group", "group")
    leaves = rows.stored(position(placed, "tree", ["key", "digest", "row_id"], "pos"), "leaves")

    tiers = _tiers(leaves.select("tree", "pos", "total", "digest"), "chunks")
    subroots = rows.stored(_tops(tiers), "subroots")
    n = subroots.count()
    above = _tiers(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(n).cast("long").alias("total"), "digest"), "top")
    root = _tops(above).first()
    start = spark.createDataFrame([(0, b"")], "tree long, path binary")
    base = rows.stored(_leaf_paths(_paths(above, start, "top-paths")).select(F.col("pos").alias("tree"), "path"), "paths")
    return Manifest(leaves, _paths(tiers, base, "paths"), groups.join(subroots.withColumnRenamed("digest", "subroot"), "tree"),
                    bytes(root["digest"]) if root else None, key)


def folded(manifest: Manifest, replacement: Column | str = "digest") -> DataFrame:
    """``key, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    ``folded_root`` is the root with the leaf replaced by ``replacement``, from
    the leaf, its siblings and the kept states; ``verified`` whether that is the root.
    """
    root = manifest.root.hex() if manifest.root else None
    replacement = F.col(replacement) if isinstance(replacement, str) else replacement
    leaves = manifest.leaves.select("tree", F.floor(F.col("pos") / SPAN).alias("chunk"), "pos", "key", "digest", replacement.alias("other"))
    chunks = manifest.chunks.drop("root").join(manifest.groups.select("tree", "subroot"), "tree")

    def fold(mine: pa.Table, chunk: pa.Table) -> pa.Table:
        row = chunk.to_pylist()[0]
        inside = _Chunk.of(row["n"], row["nodes"], row["states"], row["total"] <= SPAN)
        above = [sha256.text(s).tobytes() for _, left, right in _walk(row["path"]) for s in (left, right)]
        at = mine["pos"].to_numpy() % SPAN
        proofs = [hashlib.sha256(b"".join(inside.siblings(int(i)) + above)).hexdigest() for i in at]
        others = np.frombuffer(b"".join(mine["other"].to_pylist()), np.uint8).reshape(-1, 32)
        roots = fold_path(row["path"], inside.fold(at, others))
        roots = [r.decode() for r in sha256.text(roots).view("S64").ravel()]
        return pa.table({"key": mine["key"], "leaf": [d.hex() for d in mine["digest"].to_pylist()], "subroot": [row["subroot"].hex()] * len(at), "root": pa.array([root] * len(at), pa.string()),
                         "proof_sha256": proofs, "folded_root": roots, "verified": [r == root for r in roots]})

    kind = manifest.leaves.schema["key"].dataType.simpleString()
    schema = f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    found = leaves.groupBy("tree", "chunk").cogroup(chunks.groupBy("tree", "chunk")).applyInArrow(fold, schema)
    return found.withColumnRenamed("key", manifest.key)
