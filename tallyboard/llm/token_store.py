"""Token ids in ORC files.

ORC keeps integers by run-length encoding in stripes. Each stripe has an index of
its row groups, with the least and greatest document id, and a Bloom filter on
them, so a reader skips stripes and row groups that cannot have a document, and
stripes are read side by side. Files lie in ascending order of the document ids,
each a stretch of them; ``start`` counts ids from the beginning of the stretch.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import small_batches
from . import rows
from .tokens import ENCODE_BYTES, END_ID, Encoder, with_end

SCHEMA = "doc_id bigint, shard int, place bigint, start bigint, ids array<int>"
#: A writer keeps a stripe until it is full, a reader takes one whole.
STRIPE_BYTES = 16 << 20
ROW_GROUP = 1000
BATCH_BYTES = 4 << 20
#: A writer looks after so many rows whether its stripe is full.
ROWS_BETWEEN_CHECKS = 250


def _batches(batches: Iterator[pa.RecordBatch], text: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes of text, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(batch)]):
            if b > a:
                yield batch.slice(a, b - a)


def write(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID,
          stripe_bytes: int = STRIPE_BYTES, row_group: int = ROW_GROUP, part_bytes: int = rows.PART_BYTES) -> None:
    """Encode every text and write its ids in ascending order of the key to ORC files under ``path``.

    A file holds about ``part_bytes`` of text; rows of one key may lie in several.
    A null text is empty and has the end id alone. Rows with a null key come
    first; rows of equal keys stay rows, in the order of the MD5 of their texts.
    Other columns are ignored.
    """
    dealt = rows.in_order(docs, key, text, part_bytes=part_bytes).select("doc_id", F.spark_partition_id().alias("shard"), "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, start, place = Encoder.of(tokenizer), 0, 0
        for batch in _batches(batches, "text", ENCODE_BYTES):
            ids, ends = with_end(*encoder.column(batch["text"]), end_id)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["shard"], pa.array(place + np.arange(len(batch))), pa.array(start + ends[:-1]), lists],
                ["doc_id", "shard", "place", "start", "ids"])
            start, place = start + int(ends[-1]), place + len(batch)

    with small_batches(docs.sparkSession):
        (dealt.mapInArrow(encode, SCHEMA).write.option("orc.compress", "zstd").option("orc.stripe.size", stripe_bytes)
         .option("orc.rows.between.memory.checks", ROWS_BETWEEN_CHECKS).option("orc.row.index.stride", row_group).option("orc.create.index", "true")
         .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(path)


def lookup(spark: SparkSession, path: str, *doc_ids: int) -> DataFrame:
    """The rows of some documents; files, stripes and row groups without them are skipped."""
    return read(spark, path).filter(F.col("doc_id").isin(*doc_ids))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files; ``start`` counts the ids of all before it."""
    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["ids"]
            ends = lists.offsets.to_numpy().astype(np.int64)
            data = memoryview(lists.values.to_numpy().astype("<u4", copy=False)).cast("B")
            sums = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["shard"], batch["start"], pa.array(np.diff(ends)), pa.array(np.array(sums, np.int64))],
                ["doc_id", "shard", "start", "n_tokens", "ids_crc32"])

    found = read(spark, path).mapInArrow(crc, "doc_id long, shard int, start long, n_tokens long, ids_crc32 long")
    with small_batches(spark):
        found = rows.stored(found, "token-digests")
    # One row a file: the ids before it.
    sizes = found.groupBy("shard").agg(F.sum("n_tokens").alias("ids"))
    before = sizes.select("shard", F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return found.join(before, "shard").select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
