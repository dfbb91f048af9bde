"""Fitting imputation, scaling and category indexes in one scan.

The fitted pipeline's stages each scan the training rows, and its indexers
bring every level to the driver.  Here one aggregate over grouping sets gives
the moments of all numeric columns and the counts of all categories' levels;
the deviation of a mean-imputed column follows from them (imputed values add
nothing to the squared deviations).  Level tables stay distributed, however
many levels a column has: their ranks come from a range-partitioned numbering,
and rows get their index by a join that AQE can split.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.operators.features import global_row_number
from tabflow.operators.quality import require_columns
from tabflow.sources.tables import materialize


@dataclass(frozen=True)
class Fitted:
    """``numbers``: ``column_name, mean, stddev`` (of the imputed column), a row per numeric column;
    ``levels``: ``column_name, value, n, index``, a row per level."""

    numbers: DataFrame
    levels: DataFrame


def one_scan(df: DataFrame, num: Sequence[str], cat: Sequence[str]) -> DataFrame:
    """The aggregate itself: a row per level of each category, and one with the moments of all numbers.

    ``_set`` is the position of the row's category in ``cat`` (null for the
    moments), ``_value`` its level (null: rows without one), ``_n`` its rows.
    """
    require_columns(df, [*num, *cat], "feature")
    own = df.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(num)],
                    *[F.col(c).cast("string").alias(f"_c{i}") for i, c in enumerate(cat)])
    moments = [m for i in range(len(num)) for m in (F.count(f"_x{i}").alias(f"_count{i}"), F.avg(f"_x{i}").alias(f"_mean{i}"),
                                                    (F.var_pop(f"_x{i}") * F.count(f"_x{i}")).alias(f"_m2{i}"))]
    names = [f"_c{i}" for i in range(len(cat))]
    if not cat:
        return own.agg(F.count(F.lit(1)).alias("_n"), *moments).withColumns({"_set": F.lit(None).cast("int"), "_value": F.lit(None).cast("string")})
    marks = [F.grouping(c).alias(f"_g{i}") for i, c in enumerate(names)]
    sets = own.groupingSets([[], *[[F.col(c)] for c in names]], *names).agg(F.count(F.lit(1)).alias("_n"), *moments, *marks)
    kind = F.coalesce(*[F.when(F.col(f"_g{i}") == 0, i) for i in range(len(cat))])
    return sets.withColumns({"_set": kind, "_value": F.coalesce(*names)}).drop(*names, *[f"_g{i}" for i in range(len(cat))])


def fit(df: DataFrame, num: Sequence[str], cat: Sequence[str]) -> Fitted:
    """One scan of ``df``.  A numeric column without a value gets no mean
    (rows stay null); its deviation, and that of a single row, is null.
    Nulls are no level; levels rank by rows descending, then by value.  An
    empty table fits no numbers and no levels."""
    if not num and not cat:
        raise ValueError("No feature columns specified in config")
    found = materialize(one_scan(df, num, cat), "onepass")
    total = F.col("_n")
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"_mean{i}").alias("mean"),
                     F.when((total > 1) & (F.col(f"_count{i}") > 0), F.sqrt(F.col(f"_m2{i}") / (total - 1))).alias("stddev")) for i, c in enumerate(num)]
    empty = F.array().cast("array<struct<column_name:string,mean:double,stddev:double>>")
    numbers = found.where("_set is null").select(F.explode(F.array(*rows) if rows else empty).alias("s")).select("s.*")
    names = F.get(F.array(*[F.lit(c) for c in cat]).cast("array<string>"), F.col("_set"))
    levels = found.where("_set is not null and _value is not null").select(names.alias("column_name"), F.col("_value").alias("value"), F.col("_n").alias("n"))
    ranked = global_row_number(levels, [F.col("column_name"), F.col("n").desc(), F.col("value")], "_at")
    first = ranked.groupBy(F.col("column_name").alias("_name")).agg(F.min("_at").alias("_first"))  # a row per column
    index = ranked.join(F.broadcast(first), F.col("column_name") == F.col("_name"))
    return Fitted(numbers, index.select("column_name", "value", "n", (F.col("_at") - F.col("_first")).alias("index")))


def transform(df: DataFrame, fitted: Fitted, num: Sequence[str], cat: Sequence[str]) -> DataFrame:
    """``df`` with ``{c}_imputed``, ``{c}_scaled`` (imputed by the mean, over the
    deviation; 0.0 for a constant) and ``{c}_indexed``; a null or unseen level
    gets the slot after the last one."""
    out = df
    for c in num:
        own = fitted.numbers.where(F.col("column_name") == c)
        sd = own.select("stddev").scalar()
        out = out.withColumn(f"{c}_imputed", F.coalesce(F.col(c).cast("double"), own.select("mean").scalar()))
        out = out.withColumn(f"{c}_scaled", F.when(sd == 0, F.lit(0.0)).otherwise(F.col(f"{c}_imputed") / sd))
    for c in cat:
        own = fitted.levels.where(F.col("column_name") == c)
        known = own.select(F.col("value").alias("_value"), F.col("index").alias("_index"))
        joined = out.join(known, F.col(c).cast("string") == F.col("_value"), "left")
        unseen = own.select(F.count(F.lit(1))).scalar()
        out = joined.withColumn(f"{c}_indexed", F.coalesce(F.col("_index"), unseen)).drop("_value", "_index")
    return out
