"""Keyed tables: upsert, row-change feed, copy sync, feature lookup, serving by key.

All of these are equi-joins on the key.  Which side is broadcast is left to
Catalyst: a side is broadcast only when its estimated (and, under AQE, its
measured) size is under ``spark.sql.autoBroadcastJoinThreshold``; beyond it
the join is a shuffled sort-merge join.  AQE splits skewed partitions of the
probe side.
"""

from __future__ import annotations

from typing import Callable, Mapping, Optional, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.operators.quality import require_columns

CHANGE_TYPE = "change_type"
INSERT, UPDATE, DELETE = "insert", "update", "delete"


def lookup_rows(table: DataFrame, key: str, columns: Sequence[str], requested: DataFrame,
                what: str = "lookup table", unique: bool = False) -> DataFrame:
    """``key, *columns`` of the rows of ``table`` whose key is in ``requested``.

    The table is reduced to the requested keys first (semi-join), so the work
    follows the request.  A key that is left twice makes the job fail with a
    message naming it, so a join against the result can never emit pairs.
    The count uses the semi-join's key partitioning; a table declared
    ``unique`` is not counted.
    """
    keys = requested.select(key).distinct()
    rows = table.select(key, *columns).join(keys, key, "left_semi")
    if unique:
        return rows
    dup = F.raise_error(F.concat(F.lit(f"Duplicate key in {what}: "), F.col(key).cast("string")))
    counted = rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key)))
    return counted.where(F.when(F.col("_n") > 1, dup).otherwise(F.lit(True))).drop("_n")


def latest_per_key(df: DataFrame, pk: str | Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest ``order_by`` tuple (ties broken by the
    remaining columns, so the pick is deterministic).

    ``max(struct(order..., rest...))`` is an ordinary aggregate: partial
    aggregation keeps one candidate per key per task, so a key holding a
    third of the table never gathers its rows in one place (a row_number
    window would sort them all in one task).
    """
    keys = [pk] if isinstance(pk, str) else list(pk)
    order = list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_m"))
    return picked.select(*keys, *[F.col(f"_m.{c}").alias(c) for c in order + rest]).select(*df.columns)


def dedupe_by_key(df: DataFrame, pk: str | Sequence[str], order_by: Optional[Sequence[str]]) -> DataFrame:
    if not order_by:
        return df
    return latest_per_key(df, pk, order_by)


def upsert(old: DataFrame, new: DataFrame, pk: str | Sequence[str],
           order_by: Optional[Sequence[str]] = None) -> DataFrame:
    """Rows of ``new`` replace ``old`` rows with the same key; others are kept.

    ``new`` must hold the key column (``ValueError`` otherwise).  With
    ``order_by`` duplicate keys in ``new`` are resolved to the greatest
    ordering; without it a repeated (or NULL) key fails the job, naming the
    key.  The check rides on the anti-join's key side: the keys of ``new``
    are counted with a partial aggregate, whose key partitioning the join
    reuses.
    """
    keys = [pk] if isinstance(pk, str) else list(pk)
    for k in keys:
        if k not in new.columns:
            raise ValueError(f"Primary key column '{k}' not found in feature_data")
    new = dedupe_by_key(new, keys, order_by)
    counted = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    key_text = F.concat_ws(",", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    bad = F.col("_n") > 1
    for k in keys:
        bad = bad | F.col(k).isNull()
    dup = F.raise_error(F.concat(F.lit("NULL or duplicate key in upsert batch: "), key_text))
    new_keys = counted.where(F.when(bad, dup).otherwise(F.lit(True))).select(*keys)
    kept = old.join(new_keys, keys, "left_anti")
    return kept.unionByName(new)


def row_changes(old: DataFrame, new: DataFrame, pk: str) -> DataFrame:
    """Change feed between two snapshots keyed by ``pk``.

    One row per changed key with ``change_type`` in (insert, update, delete):
    new values for insert/update, old values for delete; unchanged keys are
    absent.  Values are compared NULL-safely.

    Keys and row hashes (128 bits) of both snapshots are grouped by key, a
    hash aggregate over four numbers a row; values travel only for keys whose
    hashes differ.  A key is never paired with itself, so a repeated key
    cannot multiply rows – it fails the job with the key named (snapshots
    must be unique on the key).
    """
    require_columns(old, [pk], "primary key")
    require_columns(new, [pk], "primary key")
    if set(old.columns) != set(new.columns):
        raise ValueError(f"Snapshots differ in columns: {sorted(set(old.columns) ^ set(new.columns))}")
    cols = [c for c in new.columns if c != pk]
    marked = [x for c in cols for x in (F.col(c), F.col(c).isNull())]  # hashes skip NULLs

    def hashed(df: DataFrame, side: int) -> DataFrame:
        return df.select(pk, F.lit(side).alias("_side"), F.xxhash64(F.lit(1), *marked).alias("_h1"),
                         F.xxhash64(F.lit(2), *marked).alias("_h2"))

    both = hashed(old, 0).union(hashed(new, 1))
    old_side, new_side = F.col("_side") == 0, F.col("_side") == 1
    g = both.groupBy(pk).agg(F.count_if(old_side).alias("_n_old"), F.count_if(new_side).alias("_n_new"),
                             F.min("_h1").alias("_lo1"), F.max("_h1").alias("_hi1"),
                             F.min("_h2").alias("_lo2"), F.max("_h2").alias("_hi2"))
    dup = F.raise_error(F.concat(F.lit("Duplicate key in snapshot: "), F.coalesce(F.col(pk).cast("string"), F.lit("NULL"))))
    kind = (F.when((F.col("_n_old") > 1) | (F.col("_n_new") > 1), dup)
             .when(F.col("_n_old") == 0, F.lit(INSERT))
             .when(F.col("_n_new") == 0, F.lit(DELETE))
             .when((F.col("_lo1") != F.col("_hi1")) | (F.col("_lo2") != F.col("_hi2")), F.lit(UPDATE)))
    changed = (g.select(F.col(pk).alias("_key"), kind.alias(CHANGE_TYPE)).where(F.col(CHANGE_TYPE).isNotNull())
                .withColumn("_from", F.when(F.col(CHANGE_TYPE) == DELETE, 0).otherwise(1)))
    values = old.select(pk, *cols, F.lit(0).alias("_side")).union(new.select(pk, *cols, F.lit(1).alias("_side")))
    picked = values.join(changed, values[pk].eqNullSafe(F.col("_key")) & (F.col("_side") == F.col("_from")))
    return picked.select(pk, CHANGE_TYPE, *cols)


def apply_changes(old: DataFrame, changes: DataFrame, pk: str) -> DataFrame:
    """Bring a copy of ``old`` up to date from a change feed (incremental sync).

    ``apply_changes(old, row_changes(old, new)) == new`` for unique keys.
    The feed is read twice (its keys, its values): pass a stored one.
    """
    touched = changes.select(pk)
    kept = old.join(touched, pk, "left_anti")
    upserted = changes.where(F.col(CHANGE_TYPE) != DELETE).drop(CHANGE_TYPE)
    return kept.unionByName(upserted.select(*old.columns))


FeatureFn = Callable[..., Column]


def training_set(df: DataFrame, features: DataFrame, lookup_key: str | tuple[str, str],
                 feature_names: Sequence[str], label: Optional[str] = None,
                 functions: Mapping[str, tuple[FeatureFn, Sequence[str]]] | None = None,
                 unique: bool = False) -> DataFrame:
    """Enrich ``df`` with looked-up features and function features.

    * lookup: ``feature_names`` are dropped from ``df`` if present and taken
      from ``features`` by key (left join; unmatched key -> NULL).
      ``lookup_key`` is one name or ``(df_key, features_key)``.
    * ``functions``: ``{output_name: (fn, [input columns])}``, each ``fn``
      returns a Column expression (a native expression, no Python worker).

    ``features`` must be unique on its key, so rows never multiply: unless
    it is declared ``unique``, its key column alone is counted first and a
    repeated key fails the job, named.  The join itself is between the two
    inputs, so AQE can split a hot key of ``df`` and the features are neither
    aggregated nor shuffled twice.
    """
    left_key, right_key = (lookup_key, lookup_key) if isinstance(lookup_key, str) else lookup_key
    require_columns(df, [left_key], "lookup key")
    require_columns(features, [right_key, *feature_names], "feature")
    if label is not None:
        require_columns(df, [label], "label")
    base = df.drop(*[c for c in feature_names if c in df.columns and c != left_key])
    feats = features.select(F.col(right_key).alias(left_key), *feature_names)
    if not unique:
        repeated = (feats.where(F.col(left_key).isNotNull()).groupBy(left_key).agg(F.count(F.lit(1)).alias("_n"))
                         .where("_n > 1").select(F.col(left_key).cast("string")).limit(1).scalar())
        dup = F.raise_error(F.concat(F.lit("Duplicate key in feature table: "), repeated))
        feats = feats.where(F.when(repeated.isNotNull(), dup).otherwise(F.lit(True)))
    out = base.join(feats, left_key, "left")
    for name, (fn, inputs) in (functions or {}).items():
        require_columns(out, inputs, "function input")
        out = out.withColumn(name, fn(*[F.col(c) for c in inputs]))
    return out


def lookup_batch(keys: DataFrame, table: DataFrame, pk: str | tuple[str, str],
                 columns: Sequence[str], unique: bool = False) -> DataFrame:
    """Serve a batch of requested keys: ``(key, found, *columns)``.

    Replaces one HTTP request per key with one join per batch.
    """
    left_key, right_key = (pk, pk) if isinstance(pk, str) else pk
    vals = lookup_rows(table.select(F.col(right_key).alias(left_key), *columns), left_key, columns, keys,
                       "served table", unique).withColumn("found", F.lit(True))
    out = keys.select(left_key).join(vals, left_key, "left")
    return out.select(left_key, F.coalesce(F.col("found"), F.lit(False)).alias("found"), *columns)
