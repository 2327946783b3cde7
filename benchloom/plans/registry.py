"""The table of queries: each has a name, a plan and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune

Plan = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Plan] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one scale-factor folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self._folder}/{name}.parquet")
        # a row of this table costs a whole parse, and its file may be a single row group, which one task reads
        return table.repartition(self.spark.sparkContext.defaultParallelism) if name == "documents" else table


def query(sql: str | None = None):
    """Register a plan under the name of its function."""

    def register(plan: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[plan.__name__] = lambda spark, folder: plan(Tables(tune(spark), folder))
        if sql is not None:
            SQL[plan.__name__] = sql
        return plan

    return register
