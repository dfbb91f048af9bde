"""Column guards, key checks and declared-constraint checks."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.config import CatFeature, NumFeature


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "column") -> None:
    """Raise ``ValueError`` naming the first missing column (checked before planning)."""
    have = set(df.columns)
    lower = {c.lower() for c in have}
    for c in columns:
        if c not in have and c.lower() not in lower:
            raise ValueError(f"{what.capitalize()} column '{c}' not found in DataFrame "
                             f"with columns {sorted(have)}")


def key_violations(df: DataFrame, pk: str | Sequence[str]) -> DataFrame:
    """Keys that are NULL or occur more than once: ``(*pk, n_rows)``.

    ``groupBy(...).count()`` aggregates partially before the shuffle, so a key
    holding a third of the table is counted map-side.
    """
    keys = [pk] if isinstance(pk, str) else list(pk)
    require_columns(df, keys, "primary key")
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .where((F.col("n_rows") > 1) | any_null))


def assert_unique(df: DataFrame, pk: str | Sequence[str], what: str = "table") -> DataFrame:
    """``df`` unchanged, but evaluating it fails (naming a key) if a key is
    NULL or repeated.

    The check is a scalar subquery over the key columns only (hash
    aggregate with partial aggregation, then ``LIMIT 1``); it runs as its own
    small job, and the plan of ``df`` itself is untouched.
    """
    keys = [pk] if isinstance(pk, str) else list(pk)
    bad = key_violations(df.select(*keys), keys).select(
        F.concat_ws(",", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])).limit(1).scalar()
    guard = F.when(bad.isNotNull(), F.raise_error(F.concat(F.lit(f"NULL or duplicate key in {what}: "), bad)))
    return df.where(guard.otherwise(F.lit(True)))


def check_constraints(df: DataFrame, num: Sequence[NumFeature] = (),
                      cat: Sequence[CatFeature] = ()) -> DataFrame:
    """Violations of declared bounds and allowed values: one aggregate pass.

    Output rows ``(column_name, rule, violations, checked)``; ``checked`` is
    the number of non-NULL values.  NULLs are not violations.  A boolean
    feature stored as its codes (e.g. 1/0) is checked against the codes.
    """
    exprs, meta = [], []
    for f in num:
        v = F.col(f.name)
        if f.min is not None:
            exprs.append(F.count_if(v < F.lit(f.min)))
            meta.append((f.name, "min"))
        if f.max is not None:
            exprs.append(F.count_if(v > F.lit(f.max)))
            meta.append((f.name, "max"))
    types = dict(df.dtypes)
    for f in cat:
        if f.allowed_values:
            allowed = list(f.allowed_values)
            if (f.encoding is not None and types.get(f.name) != "boolean"
                    and all(isinstance(v, bool) for v in allowed)):
                allowed = list(f.encoding)  # booleans stored as their codes (1/0)
            exprs.append(F.count_if(~F.col(f.name).isin(*allowed)))
            meta.append((f.name, "allowed_values"))
    if not exprs:
        raise ValueError("No constraints declared")
    counted = {name for name, _ in meta}
    aggs = [e.alias(f"v{i}") for i, e in enumerate(exprs)]
    aggs += [F.count(F.col(c)).alias(f"c_{c}") for c in sorted(counted)]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(name).alias("column_name"), F.lit(rule).alias("rule"),
                     F.col(f"v{i}").alias("violations"), F.col(f"c_{name}").alias("checked"))
            for i, (name, rule) in enumerate(meta)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def encode_values(df: DataFrame, features: Sequence[CatFeature], suffix: str = "_code") -> DataFrame:
    """Add ``{col}{suffix}`` = declared code of each value (NULL when not allowed)."""
    out = df
    for f in features:
        if f.encoding is None:
            raise ValueError(f"No encoding declared for '{f.name}'")
        pairs = []
        for value, code in zip(f.allowed_values, f.encoding):
            pairs += [F.lit(value), F.lit(code)]
        out = out.withColumn(f.name + suffix, F.create_map(*pairs)[F.col(f.name)])
    return out
