from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries and the SQL that they must agree with."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable[[Query], Query]:
        def add(function: Query) -> Query:
            self.queries[function.__name__] = function
            if sql:
                self.oracles[function.__name__] = sql
            return function

        return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def six(value: Column) -> Column:
    """Sums of doubles depend on their order; six digits don't."""
    return F.round(value, 6)


def iso(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss")
