"""What the operators share: texts, words, row numbers, tables written on the way, label folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


#: Bytes of text in a stretch of ordered rows.
PART_BYTES = 64 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: str | Column) -> Column:
    """The words of a text as an array; none for an empty or null text."""
    trimmed = F.trim(whole(text), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def n_words(text: str | Column) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row, also where lambdas refer to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fold(key: str | Column, parts: int) -> Column:
    """The fold of a row: CRC-32 of its key as text, modulo ``parts``; null keys are in no fold."""
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(parts))


def in_order(docs: DataFrame, key: str, text: str, descending: bool = False, part_bytes: int = PART_BYTES) -> DataFrame:
    """``doc_id, text`` by ascending key, nulls first, or descending, nulls last: a sorted stretch in each partition.

    Null texts are empty. Rows with equal keys follow by the MD5 of their text.
    There are as many stretches as the texts need; equal rows may lie in several,
    so a hot key is split. Texts are shuffled once.
    """
    slim = docs.select(F.col(key).cast("long").alias("doc_id"), whole(text).alias("text"))
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-total // part_bytes))
    first = F.col("doc_id").desc_nulls_last() if descending else F.col("doc_id").asc_nulls_first()
    order = [first, "_tie", "_row"]
    slim = slim.withColumns({"_tie": F.md5(F.col("text").cast("binary")), "_row": F.monotonically_increasing_id()})
    return slim.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")


def stored(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """The rows, written to a new folder under the shared work folder and read again.

    Later steps start from the files, whatever executors are lost meanwhile, and
    numbers given while writing stay as they are.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str, column: str = "row_id") -> DataFrame:
    """The rows with a number of their own in ``column``, written, so that repeated rows stay apart."""
    return stored(df.withColumn(column, F.monotonically_increasing_id()), name)


def ascii_lower(text: str | Column) -> Column:
    """The text with only A-Z lower-cased."""
    text = F.col(text) if isinstance(text, str) else text
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))
