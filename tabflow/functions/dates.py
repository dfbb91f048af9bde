"""Date helpers.  ``as_of`` is always an explicit argument (no wall clock)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tabflow.functions._util import as_col


def years_since(year_col, as_of: _dt.date | str) -> Column:
    """``year(as_of) - year_col`` as int; ``year_col`` is an integer year."""
    as_of = _dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return (F.lit(as_of.year) - as_col(year_col).cast("int")).cast("int")


def register_sql_functions(spark: SparkSession) -> None:
    """SQL-callable form, inlined by Catalyst (no Python worker):
    ``years_since(arrival_year INT, as_of DATE) RETURNS INT``."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION years_since(arrival_year INT, as_of DATE) "
        "RETURNS INT RETURN year(as_of) - arrival_year"
    )


def ntz_as_utc(c) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP reading the wall clock as UTC, whatever the
    session time zone (watermarks need TIMESTAMP)."""
    c = as_col(c)
    return F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                            F.date_part(F.lit("SECOND"), c), F.lit("UTC"))


def utc_date(ts) -> Column:
    """Calendar date of a TIMESTAMP instant in UTC, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(as_col(ts)) / F.lit(86400)).cast("int"))
