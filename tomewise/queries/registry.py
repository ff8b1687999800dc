"""Registry of queries and a few helpers they share."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
KEY = "book_id"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def r6(x: Column | str, digits: int = 6) -> Column:
    """Rounded, without negative zero, for comparison across engines."""
    return F.round(x, digits) + F.lit(0.0)


def rounded(columns: Mapping[str, Column]) -> list[Column]:
    return [r6(c.cast("double")).alias(n) for n, c in columns.items()]


def as_int(columns: Mapping[str, Column]) -> list[Column]:
    return [c.cast("int").alias(n) for n, c in columns.items()]


def exact(columns: Mapping[str, Column]) -> list[Column]:
    """For results of the same arithmetic on either engine, which need no rounding."""
    return [c.cast("double").alias(n) for n, c in columns.items()]
