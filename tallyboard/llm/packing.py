"""Packing documents into sequences of at most so many tokens.

There are no more sizes than a sequence has tokens, so the whole instance is a
histogram: how many pieces there are of each size. It is solved on that
histogram, in two steps. Dominance reduction: for a piece, from the largest on,
look for a set of it alone, it and one other, or it and two others, that no other
set with it can beat; where there is one it is fixed for as many sequences as its
pieces last, and the instance shrinks, until none is found. Best fit: what is
left goes, from the largest piece on, to the fullest open sequence with room. The plan says how many
sequences have which sizes; the pieces then take the places of their size by
number, all at once.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import small_batches
from . import rows
from .token_store import _batches
from .tokens import ENCODE_BYTES, END_ID, Encoder, with_end

LENGTH = 1024
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class _Sizes:
    """A multiset of sizes, sorted."""

    def __init__(self, counts: Mapping[int, int]):
        self.count = {s: n for s, n in counts.items() if n > 0}
        self.sorted = sorted(self.count)

    def take(self, size: int, n: int = 1) -> None:
        self.count[size] -= n
        if not self.count[size]:
            del self.count[size]
            self.sorted.remove(size)

    def put(self, size: int, n: int = 1) -> None:
        if size not in self.count:
            bisect.insort(self.sorted, size)
        self.count[size] = self.count.get(size, 0) + n

    def most(self, room: int) -> int:
        """The largest size that fits, 0 if none does."""
        i = bisect.bisect_right(self.sorted, room)
        return self.sorted[i - 1] if i else 0

    def smallest(self, n: int) -> int:
        """The sum of the n smallest, very much if there are fewer."""
        total = 0
        for s in self.sorted:
            k = min(n, self.count[s])
            total, n = total + k * s, n - k
            if not n:
                return total
        return 1 << 60


def _balanced(left: _Sizes, room: int) -> int:
    """The largest size that fits together with one at least as large; 0 if no two fit."""
    i = bisect.bisect_right(left.sorted, room // 2) - 1
    for i in range(i, -1, -1):
        size = left.sorted[i]
        if left.count[size] > 1 or i + 1 < len(left.sorted) and size + left.sorted[i + 1] <= room:
            return size
    return 0


def _dominating(left: _Sizes, room: int) -> tuple[int, ...] | None:
    """Sizes to fill the room with that no other choice beats; None if none is known.

    A choice beats another whose pieces fit, in groups, within its own pieces.
    """
    one = left.most(room)
    if not one:
        return ()
    if one == room or left.smallest(2) > room:
        return (one,)  # all others fit within it: they are no more than the room, or they are single
    if left.smallest(3) > room:
        left.take(one)
        two = left.most(room - one)
        left.put(one)
        if two and _balanced(left, room) <= two:
            return (one, two)  # of any two the larger fits within the first and the smaller within the second
    return None


def reduced(counts: Mapping[int, int], length: int = LENGTH) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Fixed sequences as (sizes, how many), and the sizes that are left."""
    left, fixed, again = _Sizes(counts), [], True
    while again:
        again = False
        for size in sorted(left.count, reverse=True):
            while size in left.count:
                left.take(size)
                found = _dominating(left, length - size)
                left.put(size)
                if found is None:
                    break
                # As many such sequences as their pieces last: the reasons hold as the rest only shrinks.
                chosen = (size, *found)
                times = min(left.count[s] // chosen.count(s) for s in chosen)
                for s in set(chosen):
                    left.take(s, chosen.count(s) * times)
                fixed.append((chosen, times))
                again = True
    return fixed, dict(left.count)


def best_fit(counts: Mapping[int, int], length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (sizes, how many): sizes from the largest, each into the fullest sequence with room."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(room: int, sizes: tuple[int, ...], n: int) -> None:
        if room not in open_:
            bisect.insort(rooms, room)
            open_[room] = []
        open_[room].append((sizes, n))

    def fill(room: int, sizes: tuple[int, ...], n: int, size: int, count: int) -> int:
        """Fill n sequences with the size as often as it fits, one after another; what is left of the count."""
        each = room // size
        full = min(n, count // each)
        if full:
            put(room - each * size, sizes + (size,) * each, full)
        count, n = count - full * each, n - full
        if n and count:
            put(room - count * size, sizes + (size,) * count, 1)
            count, n = 0, n - 1
        if n:
            put(room, sizes, n)
        return count

    for size in sorted(counts, reverse=True):
        count = counts[size]
        while count:
            i = bisect.bisect_left(rooms, size)
            if i == len(rooms):
                count = fill(length, (), -(-count // (length // size)), size, count)
            else:
                room = rooms.pop(i)
                groups = open_.pop(room)
                for sizes, n in groups:
                    if count:
                        count = fill(room, sizes, n, size, count)
                    else:
                        put(room, sizes, n)
    return [g for groups in open_.values() for g in groups]


def plan(counts: Mapping[int, int], length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (sizes, how many) that hold all pieces of the histogram."""
    fixed, rest = reduced(counts, length)
    return fixed + best_fit(rest, length)


def pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """A row per piece: only documents longer than ``length`` are cut, and the first piece takes what is over."""
    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        for batch in _batches(batches, "text", ENCODE_BYTES):
            ids, ends = with_end(*encoder.column(batch["text"]), end_id)
            sizes = np.diff(ends)
            n = -(-sizes // length)
            doc = np.repeat(np.arange(len(sizes)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            first = sizes - (n - 1) * length
            start = np.where(piece == 0, 0, first[doc] + (piece - 1) * length)
            size = np.where(piece == 0, first[doc], length)
            data, at = memoryview(ids.astype("<u4", copy=False)).cast("B"), ends[:-1][doc] + start
            crc = np.array([zlib.crc32(data[4 * a:4 * (a + s)]) for a, s in zip(at.tolist(), size.tolist())], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(size), pa.array(crc)],
                [f.split()[0] for f in PIECES.split(", ")])

    return slim.mapInArrow(cut, PIECES)


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: the key, ``piece, start, length, ids_crc32, sequence_id, offset``.

    A null text is empty and has the end id alone. Places in a sequence start at
    0 and leave no gap. Rows of equal keys are packed each for itself; an empty
    table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    with small_batches(spark):
        cut = rows.numbered(pieces(docs, tokenizer, key, text, length, end_id), "pieces")
    # A task numbers its rows by 2^33 times its own number, so the high bits deal out each size evenly.
    cut = cut.withColumn("part", F.shiftright("row_id", 33))
    counts = rows.stored(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row a size

    # For each size the stretches of its numbers: sequences from ``sequence`` on, ``each`` places in one from ``offset`` on.
    stretches: dict[int, list[tuple[int, int, int, int]]] = {}
    next_sequence, used = 0, dict.fromkeys(histogram, 0)
    for sizes, times in plan(histogram, length):
        offset = 0
        for size in dict.fromkeys(sizes):
            each = sizes.count(size)
            stretches.setdefault(size, []).append((used[size], next_sequence, each, offset))
            used[size] += each * times
            offset += each * size
        next_sequence += times
    table = spark.sparkContext.broadcast({s: np.array(v, np.int64) for s, v in stretches.items()})

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def place(size: pd.Series, number: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(size), 2), np.int64)
        sizes, numbers = size.to_numpy(), number.to_numpy()
        for s in np.unique(sizes):
            mine, of = sizes == s, table.value[s]
            first, sequence, each, offset = of[np.searchsorted(of[:, 0], numbers[mine], "right") - 1].T
            nth = numbers[mine] - first
            out[mine, 0], out[mine, 1] = sequence + nth // each, offset + nth % each * s
        return pd.DataFrame({"sequence_id": out[:, 0], "offset": out[:, 1]})

    in_part = Window.partitionBy("part", "length").orderBy("row_id")
    ranked = cut.withColumn("rank", F.row_number().over(in_part) - 1).join(first, ["part", "length"])
    placed = ranked.withColumn("placed", place("length", (F.col("first") + F.col("rank")).cast("long")))
    return placed.select(F.col("doc_id").alias(key), "piece", "start", "length", "ids_crc32", "placed.sequence_id", "placed.offset")
