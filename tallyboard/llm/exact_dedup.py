"""Exact deduplication by naming blocks.

A text is cut into blocks of a fixed number of characters. The distinct blocks
are sorted and numbered, so that equal blocks, and only they, have one name.
Then the names of neighbours are paired and the distinct pairs are sorted and
numbered in turn, until one name is left for a text. Texts are equal when they
have as many blocks and the same last name: names stand for contents, so there
are no collisions.

A block that occurs once names no copy, and its document is settled at once;
only documents whose blocks all occur elsewhere too go on to the pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rows

BLOCK = 2048


def unified(text: str | Column) -> Column:
    """The text with each run of white space as one space; null counts as empty."""
    return F.regexp_replace(rows.whole(text), rows.SPACES, " ")


def _blocks(text: Column, size: int) -> Column:
    found = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % size), F.lit(0))
    return F.when(text == "", F.array(F.lit(""))).otherwise(found)


def _named(contents: DataFrame, *keys: str) -> DataFrame:
    """Distinct contents with a name: their number in sorted order of their part."""
    return contents.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def _first_names(blocks: DataFrame) -> DataFrame:
    """``row_id, n, pos, name`` of the rows all of whose blocks occur twice or more.

    The contents are dealt out once, to be sorted and named. The names go back to
    the rows by a 64-bit key; keys that two contents share, if any, go back by content.
    """
    keyed = blocks.withColumn("key", F.xxhash64("block"))
    distinct = keyed.groupBy("block", "key").agg(F.count("*").alias("uses"))
    several = F.col("uses") > 1
    names = rows.stored(
        _named(distinct, "block").select("key", "name", "uses", F.when(several, F.col("block")).alias("block")), "block-names")
    by_key = rows.stored(
        names.groupBy("key").agg(F.count("*").alias("contents"), F.max("uses").alias("uses"), F.max("name").alias("name")).filter("uses > 1"),
        "block-keys")
    found = keyed.select("row_id", "n", "pos", "key").join(by_key.filter("contents = 1").select("key", "name"), "key")
    shared = by_key.filter("contents > 1").select("key")
    if not shared.isEmpty():
        contested = keyed.join(shared, "key").join(names.filter("uses > 1").select("block", "name"), "block")
        found = found.select("row_id", "n", "pos", "name").union(contested.select("row_id", "n", "pos", "name"))
    whole = found.groupBy("row_id", "n").agg(F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("names")).filter(F.size("names") == F.col("n"))
    return whole.select("row_id", "n", F.inline("names"))


def identities(blocks: DataFrame) -> DataFrame:
    """``row_id, n, name`` of the rows that may have copies: equal texts, and only they, agree in ``n`` and ``name``."""
    now = rows.stored(_first_names(blocks), "names")
    done, level = now.filter("n = 1").select("row_id", "n", "name"), 0
    longest = now.agg(F.max("n")).first()[0] or 0
    while 2**level < longest:
        name = lambda odd: F.max(F.when(F.col("pos") % 2 == odd, F.col("name")))
        pairs = (now.filter(F.col("n") > 2**level).groupBy("row_id", "n", F.shiftright("pos", 1).alias("pos"))
                 .agg(name(0).alias("left"), F.coalesce(name(1), F.lit(-1).cast("long")).alias("right")))
        pairs = rows.stored(pairs, "pairs")
        names = rows.stored(_named(pairs.select("left", "right").distinct(), "left", "right"), "pair-names")
        now, level = rows.stored(pairs.join(names, ["left", "right"]).select("row_id", "n", "pos", "name"), "names"), level + 1
        done = done.union(now.filter((F.col("n") <= 2**level)).select("row_id", "n", "name"))
    return done


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK, carry: bool = False) -> DataFrame:
    """One row per row of ``docs``: the key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are compared after each run of white space became one space. Of equal
    texts the row with the least key stays (null keys after all others); of rows
    equal in key and text too, any one stays. A null text is an empty one. Other
    columns are ignored, or returned whole as ``row`` with ``carry``. An empty
    table gives no rows.
    """
    cut = lambda df, source: (df.withColumn("unified", unified(source)).withColumn("blocks", _blocks(F.col("unified"), block))
                              .withColumn("sha", F.sha2(F.col("unified").cast("binary"), 256)).drop("unified"))
    if carry:
        # The rows are written as they are, and cut as they are read: their texts are there once.
        table = rows.numbered(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), "rows")
        table = cut(table.withColumn("doc_id", F.col("row")[key]), F.col("row")[text])
    else:
        table = rows.numbered(cut(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), "text").drop("text"), "blocks")
    blocks = table.select("row_id", F.size("blocks").alias("n"), F.posexplode("blocks").alias("pos", "block"))
    heads = table.select("row_id", "doc_id", "sha", *(["row"] if carry else []))

    members = rows.stored(identities(blocks).join(heads.select("row_id", "doc_id"), "row_id"), "members")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_id"))
    groups = rows.stored(
        members.groupBy("n", "name").agg(F.min(order).alias("first"), F.count("*").alias("group_size")).filter("group_size > 1")
        .select("n", "name", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.row_id").alias("keep_row")), "groups")
    copies = members.join(groups, ["n", "name"]).select("row_id", "keep_id", "keep_row", "group_size")
    single = F.col("group_size").isNull()
    # Whole rows are no side to broadcast to, however few copies there are here: the plan is that of a large table.
    return (heads.hint("merge") if carry else heads).join(copies, "row_id", "left").select(
        *(["row"] if carry else []),
        F.col("doc_id").alias(key),
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("row_id") == F.col("keep_row"))).alias("kept"),
        F.col("sha").alias("text_sha256"))
