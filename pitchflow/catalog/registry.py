"""Named queries: a Spark plan each, and the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    plan: Callable[["Tables"], DataFrame]
    sql: str | None


class Tables:
    """The parquet tables of one folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self._folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self.spark.read.parquet(f"{self._folder}/{name}.parquet")
        setattr(self, name, table)
        return table


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def add(plan: Callable[[Tables], DataFrame]):
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = Query(plan, sql)
        return plan

    return add
