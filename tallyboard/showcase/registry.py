"""Registered queries: the library run over the estate, each with its oracle SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .estate import Estate


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    run: Callable[[Estate], DataFrame]
    sql: str | None = None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.run(Estate(spark, sf_dir))


def all_queries() -> list[Query]:
    from . import history_queries, ledger_queries, metric_queries, report_queries, source_queries, warehouse_queries

    modules = (source_queries, ledger_queries, warehouse_queries, metric_queries, history_queries, report_queries)
    return [q for m in modules for q in m.QUERIES]
