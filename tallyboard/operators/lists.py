"""Text lists of a group's distinct values, for values out of a small domain.

Lists of a group's members are no cells: they are long tables with a row per member.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def set_list(df: DataFrame, keys: list[str], value: str, sep: str = ", ") -> DataFrame:
    """Sorted distinct values of a group, for values out of a known small domain.

    Duplicates are gone before the values are gathered, so a hot key costs no more
    than its distinct values.
    """
    items = F.array_sort(F.collect_list(value))
    return (df.filter(F.col(value).isNotNull()).select(*keys, value).distinct()
            .groupBy(*keys).agg(F.array_join(items, sep).alias(value)))
