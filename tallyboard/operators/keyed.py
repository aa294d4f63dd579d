"""Key-based building blocks: restrict, enrich, fan out, latest, uniqueness."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def restrict_to(df: DataFrame, roster: DataFrame, key: str = "inst_id") -> DataFrame:
    """Rows whose key is on the roster (F1). Catalyst broadcasts the key side when its size allows."""
    return df.join(roster.select(key), key, "left_semi")


def enrich(base: DataFrame, right: DataFrame, key: str = "inst_id") -> DataFrame:
    """Add the columns of ``right`` by key (K3); keys unknown to ``base`` are dropped."""
    return base.join(right, key, "left")


def fan_out(facts: DataFrame, members: DataFrame, key: str = "account_id") -> DataFrame:
    """Give each installation the fact of its account (J6). ``facts`` is unique on ``key``."""
    return members.select(key, "inst_id").join(facts, key).drop(key)


def latest_max(df: DataFrame, keys: list[str], order: str, values: dict[str, str]) -> DataFrame:
    """Largest value among the rows of the newest snapshot of each key.

    The maximum of ``(order, value)`` pairs needs one pre-aggregated pass: no window,
    no join back.
    """
    picks = [F.max(F.struct(F.col(order), F.col(source)))[source].alias(name) for name, source in values.items()]
    return df.groupBy(*keys).agg(*picks)


def latest_row(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Whole newest row per key (W1); ``order`` must end in a unique column."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.max(F.struct(*order, *rest))
    return df.groupBy(*keys).agg(packed.alias("_top")).select(*keys, "_top.*")


def one_row(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the greatest, by ``order`` first. What was landed twice counts once; one pre-aggregated pass."""
    rest = [c for c in df.columns if c not in keys]
    lead = [c for c in order or [] if c in rest]
    top = F.max(F.struct(*lead, *[c for c in rest if c not in lead])).alias("_top")
    return df.groupBy(*keys).agg(top).select(*[F.col(c) if c in keys else F.col(f"_top.{c}").alias(c) for c in df.columns])


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Keys that are not unique, with their row counts."""
    return df.groupBy(key).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """The primary-key check of a table load: raises when a key repeats."""
    clash = duplicates(df, key).limit(5).collect()
    if clash:
        raise ValueError(f"{key} repeats: {[r[key] for r in clash]}")
    return df


def tolerant_select(df: DataFrame, columns: list[str]) -> DataFrame:
    """Ordered projection; a column the table does not have is NULL."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[F.col(f"`{have[c.lower()]}`").alias(c) if c.lower() in have
                       else F.lit(None).cast("string").alias(c) for c in columns])


def owned_by(df: DataFrame, owner: str, column: str = "csm") -> DataFrame:
    """Rows of one owner, any case; ``all`` keeps every row that has an owner."""
    return df.filter(F.col(column).isNotNull() if owner == "all" else F.lower(column) == owner.lower())


def in_band(df: DataFrame, band: str) -> DataFrame:
    """Rows of one colour band."""
    return df.filter(F.col("cua_brag") == band)
