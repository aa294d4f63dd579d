"""Text expressions and column-name rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, "<.*?>", "")


def ilike_any(text: Column, patterns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.ilike(p) for p in patterns])


def contains_any(text: Column, needles: list[str]) -> Column:
    """Case-sensitive any-of substring test; NULL text gives NULL, as in SQL."""
    return reduce(lambda a, b: a | b, [text.contains(n) for n in needles])


def version_family(version: Column) -> Column:
    """``3.8.0.627`` -> ``3.8``, ``3.10.0.1`` -> ``3.10``."""
    return F.substring_index(version, ".", 2)


def os_code(name: Column) -> Column:
    """First three letters of the platform, upper case, any ``tag_`` in front removed."""
    return F.upper(F.substring(F.regexp_replace(name, "^.*_", ""), 1, 3))


def drop_wildcard(version: Column) -> Column:
    """``3.7.x`` and ``3.7`` name the same release line."""
    return F.replace(version, F.lit(".x"), F.lit(""))


def display_cell(text: Column) -> Column:
    """A stored text cell as shown: epoch milliseconds become a date, the rest stays."""
    from .time import ms_to_date
    from .values import EPOCH_MS_FROM

    whole = F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))
    return F.when(whole > F.lit(EPOCH_MS_FROM), ms_to_date(whole).cast("string")).otherwise(text)


def cell_number(text: Column) -> Column:
    """The number in a text cell that is nothing but a number, else NULL."""
    return F.when(text.rlike(r"^[0-9]+(\.[0-9]+)?$"), text.try_cast("double"))
