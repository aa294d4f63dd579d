"""Mixing sources to target weights.

Targets are words per source. They are filled in blocks of equal size, which
Sainte-Lague apportionment gives to the sources by highest quotients, shard after
shard, so that a shard's quotas are whole numbers and the quotas of all shards
add up. A source's documents lie end to end in an order drawn by the seed, again
and again; shard after shard takes its quota of blocks from where the shard
before has ended, so a shard's words are a run of that order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import rows

BLOCK_WORDS = 8
SHARDS = 16
MOST = 3
SEED = "mix-1"
#: Hexadecimal digits of the seeded order that make a bucket: 4,096 a source.
BUCKET = 3


def _long(c: Column) -> Column:
    return c.cast("long")


def targets(sources: DataFrame, weights: Sequence[float] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """``source, source_size, place, target``: the target words of each source.

    Sources in order of their code points, null last, weigh ``weights`` in turn
    and share the words of all by weight; no target is above ``most`` times its
    source's size, and what is above is shared by the others, by weight.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weigh = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int") + 1)
    placed = sources.select("source", "source_size", F.row_number().over(by_name).alias("place")).withColumn("weight", weigh)
    # A source is full at a level of cap / weight; those that are full first stand first.
    cap = _long(F.col("source_size") * most)
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    all_rows = Window.partitionBy()
    levels = (placed.withColumn("cap", cap).withColumn("total", F.sum("source_size").over(all_rows))
              .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
              .withColumn("open_weight", F.sum("weight").over(after)))
    full = levels.withColumn("full", F.col("cap") * F.col("open_weight") <= F.col("weight") * F.col("left"))
    open_ = full.withColumn("rest", F.col("total") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(all_rows)) \
        .withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)).over(all_rows))
    share = F.col("rest").cast("double") * F.col("weight") / F.nullif(F.col("open"), F.lit(0.0))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.least(share, F.col("cap").cast("double")))
    return open_.select("source", "source_size", "place", target.alias("target"))


def quotas(aims: DataFrame, block: int = BLOCK_WORDS, shards: int = SHARDS) -> DataFrame:
    """``source, shard, quota, upto``: the blocks each shard (from 0) takes of each source, and those up to its end.

    The seats of a house of ``total / block`` go to the highest quotients
    ``target / (2 k - 1)``; the house of shard ``j`` is its share of the seats
    after those of the shards before. Ties go to the source that stands first.
    """
    houses = (aims.withColumn("total", F.sum("target").over(Window.partitionBy()))
              .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
              .withColumn("house", _long(F.floor(F.round(F.col("total") / block) * (F.col("shard") + 1) / shards))))
    one = Window.partitionBy("shard")
    # Seats at the level where a block costs one seat; then give or take the few that rounding left over.
    part = F.col("target") / F.nullif(F.col("total"), F.lit(0.0))
    level = part * F.col("house")
    seats = houses.withColumn("seats", F.when(F.col("total") > 0, _long(F.floor(level + 0.5))).otherwise(0))
    seats = seats.withColumn("over", F.sum("seats").over(one) - F.col("house")).withColumn("sources", F.count("*").over(one))
    # Rounding moves no level by more than a seat a source, so a source gains or loses no more than its part of these.
    reach = F.ceil((F.abs("over") + F.col("sources")) * part).cast("int") + 1
    moved = F.when(F.col("over") > 0, F.col("seats") + 1 - F.col("step")).otherwise(F.col("seats") + F.col("step"))
    steps = (seats.filter((F.col("over") != 0) & (F.col("target") > 0)).withColumn("step", F.explode(F.sequence(F.lit(1), reach))).withColumn("k", moved).filter("k > 0")
             .withColumn("cost", (2 * F.col("k") - 1) / F.col("target")))
    sign = F.signum(F.col("over"))
    turn = F.row_number().over(one.orderBy(-sign * F.col("cost"), -sign * F.col("place")))
    changed = (steps.withColumn("turn", turn).filter(F.col("turn") <= F.abs("over"))
               .groupBy("shard", "place").agg(F.count("*").alias("moves")))
    upto = (seats.join(changed, ["shard", "place"], "left")
            .withColumn("upto", F.col("seats") - _long(F.signum("over")) * F.coalesce("moves", F.lit(0))))
    earlier = F.lag("upto", 1, 0).over(Window.partitionBy("place").orderBy("shard"))
    return upto.select("source", "place", "shard", (F.col("upto") - earlier).alias("quota"), "upto")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = (1, 2, 3),
        most: int = MOST, block: int = BLOCK_WORDS, shards: int = SHARDS, seed: str = SEED, carry: bool = False) -> DataFrame:
    """One row per row of ``docs``: the key, ``size``, ``source_size``, ``target``, ``taken``, ``by_shard``.

    ``size`` counts words, 0 for a null text. ``by_shard`` lists the shards that
    take words of the document, with their number; a shard's quota of a source may
    begin and end within a document. ``taken`` is their sum, repeats included: whole
    passes over the source, then its documents in the seeded order up to the last
    block of the last shard. Never more than ``most`` times the size. The order is
    drawn by key and text, so rows without a key are spread as others are. A null
    source is a source of its own. With ``carry`` the row comes whole as ``row``,
    without the text's words counted again.
    """
    kept = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    text_md5 = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    drawn = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("null")), text_md5).cast("binary"))
    sized = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), rows.n_words(text).alias("size"), drawn.alias("drawn"), *kept)
    sized = rows.numbered(sized, "sizes")
    slim = sized.select("row_id", "doc_id", "source", "size", "drawn", F.substring("drawn", 1, BUCKET).alias("bucket"))

    buckets = rows.stored(slim.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")), "buckets")
    in_source = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(in_source), F.lit(0)))
    aims = rows.stored(targets(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, most), "targets")
    # Where each shard ends in the source's order; a source has as many ends as there are shards.
    ends = quotas(aims, block, shards).groupBy("place").agg(F.array_sort(F.collect_list(F.struct("shard", "upto"))).alias("ends"))
    until = lambda end: F.least(end["upto"] * block, F.col("source_size") * most)
    plan = aims.join(ends, "place").withColumn("ends", F.transform("ends", until))
    # One row for each bucket of a source, met by its documents.
    plan = starts.alias("s").join(plan.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source"))).select(
        "s.source", "bucket", "bucket_start", "source_size", "target", "ends")
    plan = rows.stored(plan, "mix-plan")

    in_bucket = Window.partitionBy("source", "bucket").orderBy("drawn", "size", "row_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = slim.withColumn("before", F.coalesce(F.sum("size").over(in_bucket), F.lit(0)))
    met = placed.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.bucket") == F.col("p.bucket")))
    # Words of a document up to an end: a size for each pass before it, and what the last pass has reached.
    size, at, whole = F.col("size"), F.col("bucket_start") + F.col("before"), F.nullif(F.col("source_size"), F.lit(0))
    reached = met.withColumn("at", at).withColumn("_source_size", whole)
    words_to = "cast(coalesce((end div _source_size) * size + greatest(0, least(size, end % _source_size - at)), 0) as bigint)"
    reached = reached.withColumn("upto", F.expr(f"transform(ends, end -> {words_to})"))
    steps = F.expr("transform(upto, (n, i) -> named_struct('shard', i, 'words', if(i = 0, n, n - upto[i - 1])))")
    out = reached.select("row_id", F.col("doc_id").alias(key), size, "source_size", "target", F.element_at("upto", -1).alias("taken"),
                         F.filter(steps, lambda s: s["words"] > 0).alias("by_shard"))
    return (out.hint("merge").join(sized.select("row_id", "row"), "row_id") if carry else out).drop("row_id")


def taken_rows(docs: DataFrame, text: str = "text", most: int = MOST, **settings) -> DataFrame:
    """The rows the mix takes, with their columns as they were.

    A row comes once for each whole pass over its source. The row that a source's
    last block cuts comes once more, with its words before the cut, a space between. Columns that
    count the text's characters, ``n_chars``, follow the cut. Rows without words
    come once where their source is taken at all.
    """
    got = mix(docs, text=text, most=most, carry=True, **settings)
    size, taken = F.col("size"), F.col("taken")
    whole = F.when(size > 0, F.expr("taken div nullif(size, 0)")).otherwise(F.when(F.col("target") > 0, 1).otherwise(0)).cast("int")
    left = F.when(size > 0, taken - whole * size).otherwise(0).cast("int")
    copies = F.concat(F.array_repeat(F.lit(-1), whole), F.when(left > 0, F.array(left)).otherwise(F.array().cast("array<int>")))
    each = got.withColumn("cut", F.explode(copies))
    row = F.col("row")
    cut_text = F.when(F.col("cut") < 0, row[text]).otherwise(F.array_join(F.slice(rows.words(row[text]), 1, F.greatest("cut", F.lit(1))), " "))
    out = each.withColumn("cut_text", cut_text)
    columns = [F.col("cut_text").alias(c) if c == text else F.when(F.col("cut") < 0, row[c]).otherwise(F.length("cut_text")).cast(docs.schema[c].dataType).alias(c)
               if c == "n_chars" else row[c].alias(c) for c in docs.columns]
    return out.select(*columns)
