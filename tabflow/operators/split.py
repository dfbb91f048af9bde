"""Diff on key and reproducible train/test split.

The split side of a row is a function of its key only (salted md5 bucket),
so it is the same for any partitioning, after a task retry, and when the
table grows: an old key can never change side.  ``randomSplit`` has none of
these properties (its result depends on the partition layout).

Anti-joins pre-aggregate the seen keys (``distinct`` = partial aggregation
before the shuffle), so a key repeated a billion times on the seen side is
collapsed map-side; the join then reuses that hash partitioning.  The
probe side keeps its duplicates (they are rows, not keys) and AQE's skew-join
handling splits a hot key's partition.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.functions.hashing import hash_bucket
from tabflow.operators.quality import require_columns

SPLIT_BUCKETS = 10000
TRAIN, TEST = "train", "test"


def drop_missing_target(df: DataFrame, target: str) -> DataFrame:
    """Drop rows whose target is NULL (empty strings are kept)."""
    require_columns(df, [target], "target")
    return df.dropna(subset=[target])


def _check_test_size(test_size: float) -> None:
    if not 0 < test_size < 1:
        raise ValueError(f"test_size must be between 0 and 1, got {test_size}")


def split_side(pk: str | Column, test_size: float = 0.2, seed: int = 42) -> Column:
    """``'train'`` / ``'test'`` from the key's salted bucket."""
    _check_test_size(test_size)
    cut = round((1.0 - test_size) * SPLIT_BUCKETS)
    return F.when(hash_bucket(pk, seed, SPLIT_BUCKETS) < F.lit(cut), F.lit(TRAIN)).otherwise(F.lit(TEST))


def assign_split(df: DataFrame, pk: str, target: Optional[str], test_size: float = 0.2,
                 seed: int = 42, split_col: str = "split") -> DataFrame:
    """One plan, rows tagged with ``split``: NULL targets and NULL keys dropped."""
    _check_test_size(test_size)
    require_columns(df, [pk], "primary key")
    if target is not None:
        df = drop_missing_target(df, target)
    return df.where(F.col(pk).isNotNull()).withColumn(split_col, split_side(pk, test_size, seed))


def hash_split(df: DataFrame, pk: str, target: Optional[str], test_size: float = 0.2,
               seed: int = 42, check_empty: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``: disjoint, together all rows with a target and a key.

    Raises ``ValueError`` for ``test_size`` outside (0, 1) and, when
    ``check_empty``, for an input left empty after dropping NULL targets
    (one short-circuiting ``isEmpty`` action).
    """
    tagged = assign_split(df, pk, target, test_size, seed, "_split")
    if check_empty and tagged.isEmpty():
        raise ValueError("Cannot split an empty DataFrame")
    train = tagged.where(F.col("_split") == TRAIN).drop("_split")
    test = tagged.where(F.col("_split") == TEST).drop("_split")
    return train, test


def seen_keys(*tables: DataFrame, pk: str) -> DataFrame:
    """Distinct non-NULL keys over several tables (union, then one aggregate)."""
    if not tables:
        raise ValueError("seen_keys needs at least one table")
    keys = tables[0].select(pk)
    for t in tables[1:]:
        keys = keys.unionByName(t.select(pk))
    return keys.where(F.col(pk).isNotNull()).distinct()


def new_keys(df: DataFrame, seen: DataFrame, pk: str) -> DataFrame:
    """Distinct non-NULL keys of ``df`` absent from ``seen``."""
    require_columns(df, [pk], "primary key")
    return (df.select(pk).where(F.col(pk).isNotNull()).distinct()
              .join(seen_keys(seen, pk=pk), pk, "left_anti"))


def new_rows(df: DataFrame, seen: DataFrame, pk: str, seen_pk: Optional[str] = None) -> DataFrame:
    """Full rows of ``df`` whose key is absent from ``seen`` (duplicates kept as-is).

    A left-anti join on the rows themselves: joining rows back to their new
    keys with an inner join would multiply duplicated keys.
    """
    require_columns(df, [pk], "primary key")
    sk = seen_pk or pk
    keys = seen_keys(seen, pk=sk)
    if sk != pk:
        keys = keys.withColumnRenamed(sk, pk)
    return df.where(F.col(pk).isNotNull()).join(keys, pk, "left_anti")


def new_rows_of_batch(df: DataFrame, seen: DataFrame, pk: str, seen_pk: Optional[str] = None) -> DataFrame:
    """``new_rows`` for an ingest that is small beside what has been seen.

    A Bloom filter of the ingest's keys is tested on the seen keys where they
    are; only those that may be in the ingest are shuffled to the exact
    anti-join, which settles false positives.  So the shuffle of the seen side
    follows the ingest, not the table.  An ingest of more keys than a filter
    holds (about three million), or with keys of another type than the seen
    ones, takes the plain way.  Costs one pass over the ingest's keys first.
    """
    from tabflow.operators.keyfilter import blocks_for, build_filter, mark_candidates

    require_columns(df, [pk], "primary key")
    sk = seen_pk or pk
    if df.schema[pk].dataType == seen.schema[sk].dataType:
        n = df.agg(F.approx_count_distinct(pk).alias("n")).first()["n"]
        blocks = blocks_for(n)
        if blocks is not None:
            built = build_filter(df, [pk], blocks)
            seen = mark_candidates(seen.select(sk), [sk], blocks, built).where("_candidate").drop("_candidate")
    return new_rows(df, seen, pk, sk)


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """UNION ALL matching columns by name; column sets must be equal."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=False)
    return out


def sample_keys(df: DataFrame, pk: str, n: int, seed: int = 7, oversample: float = 4.0) -> DataFrame:
    """``n`` pseudo-random distinct keys: the ``n`` smallest salted hashes win.

    Exact, but without shuffling every key: an approximate distinct count
    (HyperLogLog, one pass, partial aggregation) sizes a hash threshold that
    should keep about ``oversample * n`` keys; only rows under it reach the
    ``distinct`` and the top-k.  If fewer than ``n`` distinct keys survive the
    threshold is doubled and the step repeated (all keys below the final
    threshold are kept, so the answer equals the top-``n`` over all keys).
    No key list travels to the driver.
    """
    from tabflow.functions.hashing import HASH_RANGE, hash_int

    if n <= 0:
        return df.select(pk).limit(0)
    keyed_rows = df.select(pk).where(F.col(pk).isNotNull()).withColumn("_h", hash_int(pk, seed))
    approx = keyed_rows.agg(F.approx_count_distinct(pk, 0.02).alias("d")).first()["d"] or 0
    threshold = HASH_RANGE if approx <= n else max(1, int(HASH_RANGE * min(1.0, oversample * n / approx)))
    while True:
        cands = keyed_rows.where(F.col("_h") < F.lit(threshold)).select(pk, "_h").distinct()
        if threshold >= HASH_RANGE or cands.limit(n).count() >= n:
            return cands.orderBy("_h", pk).limit(n).select(pk)
        threshold = min(HASH_RANGE, threshold * 2)
