"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double; NULL when the whole is zero or unknown."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``, rounded half away from zero; NULL on a zero whole."""
    return F.round(F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double")), digits)


_NUMBER_HEAD = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"


def loose_real(text: Column) -> Column:
    """Text to double the forgiving way: leading number, else 0.0; NULL stays NULL."""
    head = F.regexp_extract(text, _NUMBER_HEAD, 1)
    return F.when(text.isNotNull(), F.coalesce(head.try_cast("double"), F.lit(0.0)))


def items_in(text: Column, delimiter: str = ",") -> Column:
    """Number of delimited items in a text: delimiters + 1."""
    gone = F.replace(text, F.lit(delimiter), F.lit(""))
    return ((F.length(text) - F.length(gone)) / F.lit(len(delimiter)) + F.lit(1)).cast("bigint")
