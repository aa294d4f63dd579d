"""Support matrix from published HTML tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.html import CELL_ROWS, row_mapper
from ..functions.time import as_of_ntz, month_year


def html_rows(pages: DataFrame, container: str = "tbody", row: str = "tr", cell: str = "td") -> DataFrame:
    """Every non-empty row of cells in every container; ``tag`` is carried along."""
    return pages.select("page_id", "tag", "html").mapInPandas(row_mapper(container, row, cell), CELL_ROWS)


def support_level(standard: Column, extended: Column, eol: Column, as_of: dt.datetime) -> Column:
    """Where a version stands at ``as_of``; no usable date gives NULL."""
    now = as_of_ntz(as_of)
    past = lambda day: day.cast("timestamp_ntz") < now
    return (F.when(past(eol), "EOL").when(past(extended), "EX").when(past(standard), "ST")
            .when(standard.cast("timestamp_ntz") > now, "Unreleased"))


def version_support(pages: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Published support dates and the level they give at ``as_of``."""
    cell = lambda i: F.get("cells", F.lit(i))
    dated = html_rows(pages).select(
        F.col("tag").alias("os"), cell(0).alias("version"), month_year(cell(1)).alias("standard"),
        month_year(cell(2)).alias("extended"), month_year(cell(3)).alias("eol"))
    return dated.withColumn("current_level", support_level(F.col("standard"), F.col("extended"), F.col("eol"), as_of))
