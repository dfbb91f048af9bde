"""Error metrics and champion/challenger comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.operators.keyed import latest_per_key


def _check(df: DataFrame, label: str, prediction: str) -> None:
    if label not in df.columns:
        raise ValueError(f"Label column '{label}' is missing from the predictions DataFrame.")
    if prediction not in df.columns:
        raise ValueError(f"Prediction column '{prediction}' is missing from the predictions DataFrame.")


def error_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                  nulls: str = "drop") -> DataFrame:
    """One-row ``(n, mse, mae, r2)`` in ONE aggregate pass.

    ``r2 = 1 - SSE / SST`` with ``SST = var_pop(label) * n`` (a numerically
    stable, mergeable moment – no second pass for the mean).  Constant label
    -> r2 NULL.  ``nulls``: ``"drop"`` rows with a NULL label/prediction or
    ``"raise"``.
    """
    _check(df, label, prediction)
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    if nulls == "raise":
        y = F.when(y.isNull() | p.isNull(), F.raise_error(F.lit("NULL label or prediction"))).otherwise(y)
        rows = df
    elif nulls == "drop":
        rows = df.where(y.isNotNull() & p.isNotNull())
    else:
        raise ValueError(f"nulls must be 'drop' or 'raise', got {nulls!r}")
    err = y - p
    agg = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("_sse"),
        F.var_pop(y).alias("_var"),
    )
    r2 = F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_var") * F.col("n"))
    return agg.select("n", "mse", "mae", F.when(F.col("_var") > 0, r2).alias("r2"))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                           positive: float = 1.0) -> DataFrame:
    """One-row ``(n, accuracy, precision, recall)`` for a binary classifier."""
    _check(df, label, prediction)
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    pos = F.lit(positive)
    agg = df.where(y.isNotNull() & p.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y == p).alias("_ok"),
        F.count_if((p == pos) & (y == pos)).alias("_tp"),
        F.count_if(p == pos).alias("_pp"),
        F.count_if(y == pos).alias("_ap"),
    )
    return agg.select(
        "n",
        F.try_divide(F.col("_ok").cast("double"), F.col("n")).alias("accuracy"),
        F.try_divide(F.col("_tp").cast("double"), F.col("_pp")).alias("precision"),
        F.try_divide(F.col("_tp").cast("double"), F.col("_ap")).alias("recall"),
    )


def champion_challenger(runs: DataFrame, registry: DataFrame, model_col: str = "model",
                        run_col: str = "run_id", run_order: str = "run_order",
                        version_col: str = "version", metric: str = "mae") -> DataFrame:
    """Compare each model's newest run with its current registered version.

    ``runs``: ``(model, run_id, run_order, mae)``; ``registry``:
    ``(model, version, run_id)``.  Current = highest version (made explicit).
    ``promote`` is true iff the new metric is strictly smaller, or no version
    is registered yet.  Output ``(model, current_run, new_run, current_mae,
    new_mae, promote)``.  Both picks are aggregates (no per-model sort).
    """
    newest = latest_per_key(runs.select(model_col, run_order, run_col, metric), model_col, [run_order])
    current = latest_per_key(registry.select(model_col, version_col, run_col), model_col, [version_col])
    # run ids are only unique within a model
    cur = (current.join(runs.select(model_col, run_col, F.col(metric).alias("current_mae")), [model_col, run_col], "left")
                  .select(model_col, F.col(run_col).alias("current_run"), "current_mae"))
    new = newest.select(model_col, F.col(run_col).alias("new_run"), F.col(metric).alias("new_mae"))
    out = new.join(cur, model_col, "left")
    promote = F.col("current_run").isNull() | (F.col("new_mae") < F.col("current_mae"))
    return out.select(model_col, "current_run", "new_run", "current_mae", "new_mae",
                      F.coalesce(promote, F.lit(False)).alias("promote"))
