"""Named queries over the supplied tables, each with the SQL it must agree with where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(query: Query) -> Query:
            self.queries[name] = query
            if sql is not None:
                self.sql[name] = sql
            return query

        return keep


def rounded(df: DataFrame) -> DataFrame:
    """Doubles as they are, for comparison with another engine; adding 0.0 turns -0.0 into 0.0.

    Cutting digits would turn a last-bit difference at a tie into one of a whole digit.
    """
    columns: list[Column] = [(F.col(name) + 0.0).alias(name) if kind == "double" else F.col(name) for name, kind in df.dtypes]
    return df.select(*columns)
