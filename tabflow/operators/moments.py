"""Profiles kept as mergeable moments.

A profile row holds averages and deviations, which cannot be added up; its
moments can: rows, nulls, sum, mean, squared deviations and extremes per
window and column.  Moments of disjoint sets of rows merge into those of their
union in any order, so rows that come late, in whatever batch, end up in their
window's profile; and those of a subset are taken out again, so a refresh costs
its changes, not the population.  Every step aggregates by window (map-side
first), so a hot window costs nothing extra; tables of moments are small.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.functions._util import as_col
from tabflow.operators.quality import require_columns

MOMENTS = ("n", "nulls", "total", "mean", "m2", "min", "max")


def column_moments(df: DataFrame, window: Column | str, columns: Sequence[str], window_name: str = "window_start",
                   slices: Sequence[str] = ()) -> DataFrame:
    """``(window, *slices, column_name, *MOMENTS)`` of the rows of ``df`` in one pass.

    ``m2`` is the sum of squared deviations from ``mean``.  ``total`` is the
    sum in the column's own type (exact for decimals), so the profiled columns
    must be of one type; a column of nulls has null moments.
    """
    if not columns:
        raise ValueError("No columns to profile")
    require_columns(df, columns, "profiled")
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        aggs += [F.count_if(v.isNull()).alias(f"_nulls{i}"), F.sum(c).alias(f"_total{i}"), F.avg(v).alias(f"_mean{i}"),
                 (F.var_pop(v) * F.count(v)).alias(f"_m2{i}"), F.min(v).alias(f"_min{i}"), F.max(v).alias(f"_max{i}")]
    wide = df.groupBy(as_col(window).alias(window_name), *slices).agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("_n").alias("n"), *[F.col(f"_{m}{i}").alias(m) for m in MOMENTS[1:]])
            for i, c in enumerate(columns)]
    return wide.select(window_name, *slices, F.explode(F.array(*rows)).alias("p")).select(window_name, *slices, "p.*")


def merge_moments(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Moments of the union of disjoint sets of rows: one row per ``keys``.

    Deviations are taken from the merged mean, not from differences of
    squares, so nothing cancels.  A key has one row per set it occurs in.
    """
    own = Window.partitionBy(*keys)
    values = F.col("n") - F.col("nulls")
    mean = F.sum(values * F.col("mean")).over(own) / F.nullif(F.sum(values).over(own), F.lit(0))
    centred = parts.withColumn("_mean", mean).withColumn("_m2", F.col("m2") + values * F.pow(F.col("mean") - F.col("_mean"), F.lit(2)))
    return centred.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.sum("total").alias("total"),
                                      F.first("_mean").alias("mean"), F.sum("_m2").alias("m2"), F.min("min").alias("min"), F.max("max").alias("max"))


def retract_moments(state: DataFrame, removed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Moments of what stays when ``removed``, a subset of the rows, is taken out of ``state``.

    Adds ``stale``: a removed value was the least or largest one, so ``min``
    and ``max`` have to be read from the rows again (they are null here); with
    every other key they still hold.  Keys without a row left go.
    """
    gone = removed.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(m).alias(f"_{m}") for m in MOMENTS])
    on = [state[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    both = state.join(gone, on, "left")
    had, less = F.col("n") - F.col("nulls"), F.coalesce(F.col("_n") - F.col("_nulls"), F.lit(0))
    left = had - less
    mean = F.when(less == 0, F.col("mean")).otherwise((had * F.col("mean") - less * F.col("_mean")) / F.nullif(left, F.lit(0)))
    both = both.withColumn("_new", mean)
    m2 = F.when(less == 0, F.col("m2")).when(left > 0, F.greatest(
        F.lit(0.0), F.col("m2") - F.col("_m2") - left * less / had * F.pow(F.col("_new") - F.col("_mean"), F.lit(2))))
    stale = F.coalesce((F.col("_min") <= F.col("min")) | (F.col("_max") >= F.col("max")), F.lit(False))
    total = F.when(left > 0, F.when(less == 0, F.col("total")).otherwise(F.col("total") - F.col("_total"))).cast(state.schema["total"].dataType)
    return both.select(*[state[k] for k in keys], (F.col("n") - F.coalesce("_n", F.lit(0))).alias("n"),
                       (F.col("nulls") - F.coalesce("_nulls", F.lit(0))).alias("nulls"), total.alias("total"), F.col("_new").alias("mean"),
                       m2.alias("m2"), F.when(~stale, F.col("min")).alias("min"), F.when(~stale, F.col("max")).alias("max"),
                       stale.alias("stale")).where("n > 0")


def refresh_moments(state: DataFrame, before: DataFrame, after: DataFrame, population: DataFrame, window: Column | str,
                    columns: Sequence[str], window_name: str = "window_start", slices: Sequence[str] = ()) -> DataFrame:
    """``state`` brought up to date from changed rows only.

    ``before`` holds the old rows of the changed keys (none for inserts),
    ``after`` their new ones (none for deletes).  ``population``, the table
    after the change, gives least and largest values again for the windows
    whose extreme was taken out; all other moments come from the changes.
    """
    keys = [window_name, *slices, "column_name"]
    taken = retract_moments(state, column_moments(before, window, columns, window_name, slices), keys)
    merged = merge_moments(taken.drop("stale").unionByName(column_moments(after, window, columns, window_name, slices), allowMissingColumns=True), keys)
    stale = taken.where("stale").select(*keys)
    marked = [F.col(k).alias(f"_k{i}") for i, k in enumerate([window_name, *slices])]
    rows = population.select(as_col(window).alias(window_name), *slices, *columns)
    touched = stale.select(*marked).distinct()
    same = [rows[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate([window_name, *slices])]
    again = column_moments(rows.join(touched, same, "left_semi"), window_name, columns, window_name, slices)
    fixed = stale.select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)]).join(
        again.select(*[F.col(k).alias(f"_a{i}") for i, k in enumerate(keys)], F.col("min").alias("_min"), F.col("max").alias("_max")),
        [F.col(f"_s{i}").eqNullSafe(F.col(f"_a{i}")) for i in range(len(keys))])
    both = merged.join(fixed, [merged[k].eqNullSafe(F.col(f"_s{i}")) for i, k in enumerate(keys)], "left")
    known = F.col(f"_s{len(keys) - 1}").isNotNull()  # a column name is never null
    return both.select(*[merged[k] for k in keys], "n", "nulls", "total", "mean", "m2",
                       *[F.when(known, F.col(f"_{m}")).otherwise(merged[m]).alias(m) for m in ("min", "max")])


def moments_profile(moments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, n, nulls, avg, min, max, stddev)`` as :func:`tabflow.operators.monitor.profile_metrics` gives them."""
    values = F.col("n") - F.col("nulls")
    exact = dict(moments.dtypes)["total"].startswith("decimal")  # sums of decimals are divided as decimals
    avg = F.try_divide(F.col("total"), values.cast("decimal(20,0)") if exact else values).cast("double")
    return moments.select(*keys, "n", "nulls", avg.alias("avg"), "min", "max",
                          F.when(values > 1, F.sqrt(F.col("m2") / (values - 1))).alias("stddev"))
