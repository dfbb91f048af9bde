"""Registered queries over the driver's test tables.

Each query maps one operator onto a stand-in for the booking table
(orders for bookings, customer for the feature table, lineitem for
duplicate keys and profiles, events for prediction history).  Every query
reads whole tables; parameters are the operator's own (threshold, seed,
window), never row caps.  ``ORACLE_SQL`` holds the DuckDB text computing the
same result; column names match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def sround(expr: str, digits: int) -> str:
    """DuckDB text that rounds a double the way Spark's ``round`` does.

    Spark rounds HALF_UP on the shortest decimal form of the double (38.37875
    -> 38.3788); DuckDB's ``round`` works on the binary value (38.378749999...
    -> 38.3787).  Casting to DECIMAL first gives Spark's result, and no
    negative zero.
    """
    return f"CAST(round(CAST({expr} AS DECIMAL(38,{digits + 6})), {digits}) AS DOUBLE)"


def exact_avg_sql(expr: str, scale: int = 10, extra: int = 4) -> str:
    """DuckDB twin of Spark's ``avg`` of a ``DECIMAL(38, scale)`` as double:
    exact integer sum, quotient rounded HALF_UP at ``scale + extra`` digits."""
    tot = f"CAST(sum(CAST({expr} AS DECIMAL(38,{scale}))) * {10 ** scale} AS HUGEINT)"
    cnt = f"count({expr})"
    return (f"(CAST((2 * {tot} * {10 ** extra} + sign({tot}) * {cnt}) // (2 * {cnt}) AS DOUBLE)"
            f" / {float(10 ** (scale + extra))})")


def exact(column: str):
    """The double as a decimal with all its digits (the given amounts have
    two), so that sums do not depend on the order of rows."""
    return F.col(column).cast("decimal(38,10)")


def register(name: str, sql: str | None = None):
    """Decorator: add a query (and its DuckDB oracle, when one exists)."""

    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
