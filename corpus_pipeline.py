"""A corpus from raw documents: language, exact and near copies, mix of sources, packed sequences.

Each stage is written as Parquet and read again as the next one's documents. All
but the last return documents as they came, with the columns they came with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.llm import exact_dedup, language_id, mixing, near_dedup, packing, rows
from tallyboard.llm.queries import tokenizer
from tallyboard.session import scratch_path

#: A document goes when no language has this share of its bytes.
LEAST_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those of no language. The network learns from those that have ``lang``.

    Where none has there is nothing to tell languages by, and all documents with a letter stay.
    """
    network = language_id.learn(docs) if "lang" in docs.columns else None
    if network is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = language_id.identify(docs, network, carry=True)
    return found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the least id stays."""
    return exact_dedup.exact_groups(docs, carry=True).filter("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts the one with the least id stays."""
    return near_dedup.near_groups(docs, carry=True).filter("kept").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, and the one that a source's last block cuts with the words before the cut."""
    return mixing.taken_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their sequence and place."""
    return packing.pack(docs, tokenizer())


STAGES = [("language", identify_language), ("exact copies", drop_exact_copies), ("near copies", drop_near_copies), ("mix", mix_sources), ("packing", pack_sequences)]

#: SQL has no trained network, no sampling and no packing; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the table of documents."""
    docs = rows.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
