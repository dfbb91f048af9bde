"""Stand-ins for the booking table family, derived from the test tables.

orders plays the booking table (key ``o_orderkey``).  Snapshots are cut by
order date – an earlier ingest holds the orders placed before a date – so
"old" and "new" differ the way successive ingests do; every row of orders
is still read and processed.  Each DataFrame has a SQL twin used by the
oracle texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.plans.catalog import table

PK = "o_orderkey"
OLD_CUTOFF = "1999-01-01"      # first ingest: orders placed before this date
UPDATE_FROM = "1998-01-01"     # upsert batch: orders placed on/after this date
SNAPSHOT_FROM = "1996-01-01"   # second snapshot: orders before this date were deleted


def ts(day: str) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{day} 00:00:00'")


def status_target() -> Column:
    """Nullable target: NULL for low priority, empty string when unspecified."""
    return (F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
             .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(""))
             .otherwise(F.col("o_orderstatus")))


STATUS_SQL = ("CASE WHEN o_orderpriority = '5-LOW' THEN NULL "
              "WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderstatus END")

HIGH_VALUE_SQL = "CASE WHEN o_totalprice > 200000 THEN 'high' ELSE 'low' END"


def high_value() -> Column:
    return F.when(F.col("o_totalprice") > 200000, F.lit("high")).otherwise(F.lit("low"))


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("status", status_target())


BOOKINGS_SQL = f"SELECT *, {STATUS_SQL} AS status FROM orders"


def old_snapshot(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").where(F.col("o_orderdate") < ts(OLD_CUTOFF))


OLD_SQL = f"SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{OLD_CUTOFF}'"


def _bump_open(df: DataFrame) -> DataFrame:
    return df.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + F.lit(1.0))
                         .otherwise(F.col("o_totalprice")))


_BUMP_SQL = ("SELECT o_orderkey, o_custkey, o_orderstatus, "
             "CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1.0 ELSE o_totalprice END AS o_totalprice, "
             "o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '{d}'")


def update_batch(spark, sf_dir) -> DataFrame:
    """Orders from UPDATE_FROM on, open orders re-priced (+1.0)."""
    return _bump_open(table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= ts(UPDATE_FROM)))


UPDATE_SQL = _BUMP_SQL.format(d=UPDATE_FROM)


def snapshot2(spark, sf_dir) -> DataFrame:
    """Second snapshot: older orders deleted, open orders re-priced, newer ones inserted."""
    return _bump_open(table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= ts(SNAPSHOT_FROM)))


SNAPSHOT2_SQL = _BUMP_SQL.format(d=SNAPSHOT_FROM)


def split_sql(key: str, seed: int = 42, train_buckets: int = 8000) -> str:
    """DuckDB twin of ``split_side``."""
    return (f"CASE WHEN ('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT % 10000 "
            f"< {train_buckets} THEN 'train' ELSE 'test' END")


def hash_sql(key: str, salt) -> str:
    return f"('0x' || substr(md5('{salt}:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT"
