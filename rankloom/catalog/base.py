"""Registration of the queries the driver runs, and small helpers for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.catalog.sql import with_ctes

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where DuckDB can express it, its SQL counterpart."""
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql if sql.lstrip().startswith("WITH") else with_ctes(sql)
        return fn
    return add


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Doubles rounded: their sums depend on the order of addition."""
    return df.withColumns({c: F.round(c, digits) for c in cols})


def r6(cols: str) -> str:
    """SQL list of rounded columns."""
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols.split())


def day_text(col: str) -> Column:
    return F.date_format(col, "yyyy-MM-dd").alias(col)


def joined(col: str | Column, sep: str = ",") -> Column:
    """List as text, so both engines hash it alike."""
    return F.array_join(col, sep)
