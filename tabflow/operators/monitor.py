"""Column profiles per time window and drift alerts over them.

Profile: one row per ``(window_start, column_name)`` with count, nulls, avg,
min, max and sample stddev.  It is computed as ONE wide aggregate grouped by
window (partial aggregation map-side, so a hot window costs nothing extra),
then the tiny aggregated result is unpivoted – rows are never multiplied by
the number of profiled columns before the shuffle.

Drift: for each ``column_name`` compare a window's average with the previous
window's; ``pct = round((avg - prev) * 100 / prev, 1)``; flag when
``pct > threshold`` (strict, after rounding, signed unless ``two_sided``).
NULL pct (oldest window or previous average 0) never flags.  The alert is
the flag of the newest window.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.functions._util import as_col

PROFILE_STATS = ("n", "nulls", "avg", "min", "max", "stddev")


def window_start(ts, granularity: str = "day") -> Column:
    """Start of the calendar window (``day``, ``week``, ``month``...) as DATE."""
    return F.date_trunc(granularity, as_col(ts)).cast("date")


def profile_metrics(df: DataFrame, window: Column | str, columns: Sequence[str],
                    window_name: str = "window_start", slices: Sequence[str] = ()) -> DataFrame:
    """Per window x slice x column: n (rows), nulls, avg, min, max, stddev (sample).

    ``window`` is a column expression giving each row its window (e.g.
    :func:`window_start`); ``slices`` are optional extra grouping columns
    (one profile per slice value).  Statistics are computed on the double
    value of each column; only the average is taken in the column's own type,
    so that a decimal column is summed exactly.
    """
    if not columns:
        raise ValueError("No columns to profile")
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Columns not found: {missing}")
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        aggs += [
            F.count_if(v.isNull()).alias(f"nulls_{i}"),
            F.avg(c).cast("double").alias(f"avg_{i}"),
            F.min(v).alias(f"min_{i}"),
            F.max(v).alias(f"max_{i}"),
            F.stddev_samp(v).alias(f"stddev_{i}"),
        ]
    wide = df.groupBy(as_col(window).alias(window_name), *slices).agg(*aggs)
    per_col = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("n_rows").alias("n"),
            F.col(f"nulls_{i}").alias("nulls"),
            F.col(f"avg_{i}").alias("avg"),
            F.col(f"min_{i}").alias("min"),
            F.col(f"max_{i}").alias("max"),
            F.col(f"stddev_{i}").alias("stddev"),
        )
        for i, c in enumerate(columns)
    ]
    return (wide.select(window_name, *slices, F.explode(F.array(*per_col)).alias("p"))
                .select(window_name, *slices, "p.*"))


def snapshot_profile(df: DataFrame, refreshed_at: Column | str, columns: Sequence[str],
                     window_name: str = "window") -> DataFrame:
    """Profile of the whole of ``df`` as it stands at one refresh: one row per
    column, its window being the refresh time."""
    at = F.lit(refreshed_at).cast("timestamp_ntz") if isinstance(refreshed_at, str) else refreshed_at
    return profile_metrics(df, at, columns, window_name=window_name)


def drift_series(profile: DataFrame, window_col: str = "window_start", value_col: str = "avg",
                 keys: Sequence[str] = ("column_name",), threshold: float = 50.0,
                 two_sided: bool = False) -> DataFrame:
    """Adds ``prev_avg``, ``pct`` and ``flag`` to each (keys, window) row.

    The window function is partitioned by ``keys`` (column name plus any
    slice); the profile holds one row per (window, keys), so a partition is
    one short series and no single task sees the whole profile.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(window_col).desc())
    prev = F.lead(value_col, 1).over(w)
    # rounded twice: the last bits of a double must not decide a tie (-6.249999999999996 is -6.25, so -6.3)
    pct = F.round(F.round(F.try_divide((F.col(value_col) - F.col("prev_avg")) * F.lit(100.0), F.col("prev_avg")), 7), 1)
    change = F.abs(F.col("pct")) if two_sided else F.col("pct")
    return (profile.withColumn("prev_avg", prev)
                   .withColumn("pct", pct)
                   .withColumn("flag", F.when(change > F.lit(threshold), 1).otherwise(0)))


def drift_alert(series: DataFrame, window_col: str = "window_start",
                keys: Sequence[str] = ("column_name",)) -> DataFrame:
    """Newest window's flag per column: ``(column_name, latest_window, pct, prediction_drift)``.

    ``max_by`` over the window replaces the original's ``FIRST`` over a sorted
    subquery, which has no ordering guarantee after an aggregate.
    """
    return series.groupBy(*keys).agg(
        F.max(window_col).alias("latest_window"),
        F.max_by("pct", window_col).alias("pct"),
        F.max_by("flag", window_col).cast("int").alias("prediction_drift"),
    )
