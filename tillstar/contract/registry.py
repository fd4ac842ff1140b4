"""Where queries and their SQL twins are entered."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracle import sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        ORACLES[name] = sql(oracle)
        return query

    return add
