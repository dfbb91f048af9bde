"""Scan, split, diff, union, keyed-table and lookup queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tabflow.functions.dates import years_since
from tabflow.operators import keyed, split
from tabflow.operators.features import project_features
from tabflow.plans import standins as S
from tabflow.plans.catalog import register, table
from tabflow.plans.flows import incremental_split
from tabflow.session import scratch_path
from tabflow.sources.tables import materialize

ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@register("scan_projection", sql="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
""")
def q_scan_projection(spark, sf_dir):
    return (table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
            .select("o_orderkey", "o_custkey", "o_totalprice"))


@register("drop_missing_target", sql=f"""
SELECT o_orderkey, o_custkey, o_totalprice, status FROM ({S.BOOKINGS_SQL}) b WHERE status IS NOT NULL
""")
def q_drop_missing_target(spark, sf_dir):
    return (split.drop_missing_target(S.bookings(spark, sf_dir), "status")
            .select("o_orderkey", "o_custkey", "o_totalprice", "status"))


@register("feature_target_project", sql=f"""
SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, o_totalprice, {S.HIGH_VALUE_SQL} AS label
FROM orders
""")
def q_feature_target_project(spark, sf_dir):
    df = table(spark, sf_dir, "orders").withColumn("label", S.high_value())
    return project_features(df, "o_orderkey", ["o_totalprice", "o_custkey"],
                            ["o_orderstatus", "o_orderpriority"], "label")


@register("hash_split", sql=f"""
SELECT o_orderkey, {S.split_sql('o_orderkey')} AS split FROM ({S.BOOKINGS_SQL}) b WHERE status IS NOT NULL
""")
def q_hash_split(spark, sf_dir):
    return (split.assign_split(S.bookings(spark, sf_dir), S.PK, "status", 0.2, 42)
            .select(S.PK, "split"))


@register("new_keys", sql=f"""
SELECT DISTINCT o.o_orderkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM ({S.OLD_SQL}) s WHERE s.o_orderkey = o.o_orderkey)
""")
def q_new_keys(spark, sf_dir):
    return split.new_keys(table(spark, sf_dir, "orders"), S.old_snapshot(spark, sf_dir), S.PK)


@register("new_rows", sql=f"""
SELECT * FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM ({S.OLD_SQL}) s WHERE s.o_orderkey = l.l_orderkey)
""")
def q_new_rows(spark, sf_dir):
    return split.new_rows(table(spark, sf_dir, "lineitem"), S.old_snapshot(spark, sf_dir),
                          "l_orderkey", seen_pk=S.PK)


@register("union_by_name", sql="SELECT * FROM orders")
def q_union_by_name(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    newer = orders.where(F.col("o_orderdate") >= S.ts(S.OLD_CUTOFF))
    newer = newer.select(*reversed(newer.columns))  # same columns, other order
    return split.union_by_name(S.old_snapshot(spark, sf_dir), newer)


@register("incremental_split", sql=f"""
SELECT o_orderkey, o_totalprice, status, {S.split_sql('o_orderkey')} AS split
FROM ({S.BOOKINGS_SQL}) b WHERE status IS NOT NULL
""")
def q_incremental_split(spark, sf_dir):
    root = scratch_path(spark, "incremental_split")
    first = S.bookings(spark, sf_dir).where(F.col("o_orderdate") < S.ts(S.OLD_CUTOFF))
    incremental_split(first, root, S.PK, "status")                      # first load
    incremental_split(S.bookings(spark, sf_dir), root, S.PK, "status")  # only new keys added
    return (spark.read.parquet(root).select(S.PK, "o_totalprice", "status", "split"))


@register("new_rows_of_batch", sql=f"""
SELECT * FROM ({S.UPDATE_SQL}) u
WHERE NOT EXISTS (SELECT 1 FROM ({S.OLD_SQL}) s WHERE s.o_orderkey = u.o_orderkey)
""")
def q_new_rows_of_batch(spark, sf_dir):
    """An ingest of late orders, some of them seen, against the first load."""
    return split.new_rows_of_batch(S.update_batch(spark, sf_dir), S.old_snapshot(spark, sf_dir), S.PK).select(*ORDER_COLS.split(", "))


@register("incremental_ingest", sql=f"""
SELECT o_orderkey, o_totalprice, status, {S.split_sql('o_orderkey')} AS split
FROM ({S.BOOKINGS_SQL}) b WHERE status IS NOT NULL
""")
def q_incremental_ingest(spark, sf_dir):
    """The split table after a first load and an ingest that overlaps it by a year."""
    root = scratch_path(spark, "incremental_ingest")
    rows = S.bookings(spark, sf_dir)
    incremental_split(rows.where(F.col("o_orderdate") < S.ts(S.OLD_CUTOFF)), root, S.PK, "status")
    incremental_split(rows.where(F.col("o_orderdate") >= S.ts(S.UPDATE_FROM)), root, S.PK, "status", small_ingest=True)
    return spark.read.parquet(root).select(S.PK, "o_totalprice", "status", "split")


@register("sample_keys", sql=f"""
SELECT o_orderkey FROM (SELECT DISTINCT o_orderkey FROM orders) k
ORDER BY {S.hash_sql('o_orderkey', 7)}, o_orderkey LIMIT 20
""")
def q_sample_keys(spark, sf_dir):
    return split.sample_keys(table(spark, sf_dir, "orders"), S.PK, 20, seed=7)


@register("upsert", sql=f"""
SELECT {ORDER_COLS} FROM ({S.OLD_SQL}) o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({S.UPDATE_SQL}) u)
UNION ALL
SELECT {ORDER_COLS} FROM ({S.UPDATE_SQL}) u
""")
def q_upsert(spark, sf_dir):
    return keyed.upsert(S.old_snapshot(spark, sf_dir), S.update_batch(spark, sf_dir), S.PK)


_UPSERT_SQL = f"""
SELECT {ORDER_COLS} FROM ({S.OLD_SQL}) o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({S.UPDATE_SQL}) u)
UNION ALL
SELECT {ORDER_COLS} FROM ({S.UPDATE_SQL}) u
"""


@register("upsert_partitioned", sql=_UPSERT_SQL)
def q_upsert_partitioned(spark, sf_dir):
    """Keyed table on disk, batch by batch: an upsert writes its rows only,
    and a read takes each key's newest."""
    from tabflow.plans.flows import write_keyed
    from tabflow.sources.tables import read_newest

    root = scratch_path(spark, "keyed_partitioned")
    write_keyed(root, S.old_snapshot(spark, sf_dir), S.PK)      # create
    write_keyed(root, S.update_batch(spark, sf_dir), S.PK)      # upsert
    return read_newest(spark, root, S.PK).select(*ORDER_COLS.split(", "))


_FEED_SQL = f"""
SELECT u.o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'insert' ELSE 'update' END AS change_type,
       u.o_custkey, u.o_orderstatus, u.o_totalprice, u.o_orderdate, u.o_orderpriority
FROM ({S.UPDATE_SQL}) u LEFT JOIN ({S.OLD_SQL}) o ON u.o_orderkey = o.o_orderkey
WHERE o.o_orderkey IS NULL OR u.o_custkey IS DISTINCT FROM o.o_custkey
   OR u.o_orderstatus IS DISTINCT FROM o.o_orderstatus OR u.o_totalprice IS DISTINCT FROM o.o_totalprice
   OR u.o_orderdate IS DISTINCT FROM o.o_orderdate OR u.o_orderpriority IS DISTINCT FROM o.o_orderpriority
"""


@register("version_change_feed", sql=_FEED_SQL)
def q_version_change_feed(spark, sf_dir):
    """Keyed table created from the first snapshot (batch 0), upserted with
    the update batch (batch 1); the change feed between the two."""
    from tabflow.plans.flows import batch_changes, write_keyed

    root = scratch_path(spark, "keyed_feed")
    write_keyed(root, S.old_snapshot(spark, sf_dir), S.PK)
    write_keyed(root, S.update_batch(spark, sf_dir), S.PK)
    return batch_changes(spark, root, S.PK, 0, 1)


_CHANGES_SQL = f"""
SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey,
       CASE WHEN o.o_orderkey IS NULL THEN 'insert' WHEN n.o_orderkey IS NULL THEN 'delete' ELSE 'update' END
         AS change_type,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_custkey ELSE n.o_custkey END AS o_custkey,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_orderstatus ELSE n.o_orderstatus END AS o_orderstatus,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_totalprice ELSE n.o_totalprice END AS o_totalprice,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_orderdate ELSE n.o_orderdate END AS o_orderdate,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_orderpriority ELSE n.o_orderpriority END AS o_orderpriority
FROM ({S.OLD_SQL}) o FULL OUTER JOIN ({S.SNAPSHOT2_SQL}) n ON o.o_orderkey = n.o_orderkey
WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL
   OR o.o_custkey IS DISTINCT FROM n.o_custkey OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus
   OR o.o_totalprice IS DISTINCT FROM n.o_totalprice OR o.o_orderdate IS DISTINCT FROM n.o_orderdate
   OR o.o_orderpriority IS DISTINCT FROM n.o_orderpriority
"""


@register("row_changes", sql=_CHANGES_SQL)
def q_row_changes(spark, sf_dir):
    return keyed.row_changes(S.old_snapshot(spark, sf_dir), S.snapshot2(spark, sf_dir), S.PK)


@register("sync_copy", sql=S.SNAPSHOT2_SQL)
def q_sync_copy(spark, sf_dir):
    old = S.old_snapshot(spark, sf_dir)
    changes = materialize(keyed.row_changes(old, S.snapshot2(spark, sf_dir), S.PK), "feed")  # evaluated once
    return keyed.apply_changes(old, changes, S.PK)


@register("key_violations", sql="""
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
""")
def q_key_violations(spark, sf_dir):
    from tabflow.operators.quality import key_violations

    return key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


AS_OF = dt.date(2025, 1, 1)


@register("training_set", sql=f"""
SELECT o.o_orderkey, o.o_custkey, o.o_orderpriority, {S.HIGH_VALUE_SQL} AS label,
       c.c_acctbal, c.c_mktsegment, CAST(2025 - year(o.o_orderdate) AS INTEGER) AS years_since_order
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def q_training_set(spark, sf_dir):
    train = (table(spark, sf_dir, "orders").withColumn("label", S.high_value())
             .withColumn("order_year", F.year("o_orderdate"))
             .select("o_orderkey", "o_custkey", "o_orderpriority", "label", "order_year"))
    ts_df = keyed.training_set(
        train, table(spark, sf_dir, "customer"), ("o_custkey", "c_custkey"), ["c_acctbal", "c_mktsegment"],
        label="label", functions={"years_since_order": (lambda y: years_since(y, AS_OF), ["order_year"])})
    return ts_df.drop("order_year")


@register("lookup_batch", sql="""
SELECT k.o_custkey, c.c_custkey IS NOT NULL AS found, c.c_acctbal, c.c_nationkey
FROM (SELECT DISTINCT o_custkey FROM orders) k
LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'AUTOMOBILE') c ON k.o_custkey = c.c_custkey
""")
def q_lookup_batch(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select("o_custkey").distinct()
    served = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "AUTOMOBILE")
    return keyed.lookup_batch(keys, served, ("o_custkey", "c_custkey"), ["c_acctbal", "c_nationkey"])
