"""Feature preparation: SQL forms of the MLlib stages, and the MLlib pipeline.

The SQL forms (``category_index``, ``impute_mean``, ``scale_unit_std``,
``one_hot``) compute exactly what ``StringIndexer``, ``Imputer(mean)``,
``StandardScaler(withMean=False)`` and ``OneHotEncoder(dropLast=True)``
compute, as plain DataFrame plans: global statistics are scalar subqueries
(one aggregate pass, merged by Catalyst into one job), never a window over
the whole table.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.config import TableSpec
from tabflow.operators.quality import require_columns


def project_features(df: DataFrame, pk: Optional[str], num: Sequence[str], cat: Sequence[str],
                     target: Optional[str]) -> DataFrame:
    """Key, then feature columns in sorted (deterministic) order, then target."""
    feats = sorted(set(num) | set(cat))
    if not feats:
        raise ValueError("No feature columns specified in config")
    cols = ([pk] if pk else []) + feats + ([target] if target else [])
    require_columns(df, cols, "feature")
    return df.select(*cols)


def category_index(df: DataFrame, col: str, order: str = "frequencyDesc",
                   out: str = "index") -> DataFrame:
    """Level table ``(value, index, n)`` as ``StringIndexer`` orders it.

    ``frequencyDesc``: by count descending, ties by value ascending;
    ``alphabetAsc``: by value.  NULL is not a level.  Distributed numbering:
    the level counts are range-partitioned in index order, each partition
    numbers its rows locally and adds the row count of the partitions before
    it (a table with one row per partition), so no task holds all levels.
    """
    require_columns(df, [col], "categorical")
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    if order == "frequencyDesc":
        keys = [F.col("n").desc(), F.col("value").asc()]
    elif order == "alphabetAsc":
        keys = [F.col("value").asc()]
    else:
        raise ValueError(f"Unsupported order '{order}'")
    return global_row_number(counts, keys, out)


def global_row_number(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """0-based position of each row in ``order`` without a single-task window.

    The rows are range-partitioned in ``order`` and written once to the
    shared folder together with their partition id, so the local numbering
    and the per-partition offsets are computed from the same fixed layout
    (range bounds come from a sample and would not be guaranteed equal if
    the shuffle ran twice).
    """
    from tabflow.sources.tables import materialize

    ranged = materialize(df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()),
                         "row_number")
    local = ranged.withColumn(
        "_local", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)) - 1)
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # one row per partition: a bounded table (size = partition count), broadcast
    offsets = sizes.withColumn(
        "_off", F.coalesce(F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))
    return (local.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
                 .select(*df.columns, (F.col("_off") + F.col("_local")).cast("bigint").alias(out)))


def impute_mean(df: DataFrame, cols: Sequence[str], suffix: str = "_imputed") -> DataFrame:
    """``{c}_imputed = coalesce(c, mean(c))`` on doubles (an int column is
    cast first, so the mean is not truncated).  All-NULL column -> error."""
    require_columns(df, cols, "numeric")
    stats = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols])
    out = df
    for c in cols:
        m = stats.select(c).scalar()
        fill = F.when(m.isNull(), F.raise_error(F.lit(f"Column '{c}' has only NULL values"))).otherwise(m)
        out = out.withColumn(c + suffix, F.coalesce(F.col(c).cast("double"), fill))
    return out


def scale_unit_std(df: DataFrame, cols: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """``c / stddev_samp(c)`` without centring; constant column -> 0.0."""
    require_columns(df, cols, "numeric")
    stats = df.agg(*[F.stddev_samp(F.col(c).cast("double")).alias(c) for c in cols])
    out = df
    for c in cols:
        sd = stats.select(c).scalar()
        out = out.withColumn(c + suffix, F.when(sd == 0, F.lit(0.0))
                             .otherwise(F.col(c).cast("double") / sd))
    return out


def one_hot_name(col: str, level) -> str:
    clean = "".join(ch if ch.isalnum() else "_" for ch in str(level))
    return f"{col}_is_{clean}"


def one_hot(df: DataFrame, col: str, levels: Sequence, drop_last: bool = True) -> DataFrame:
    """0/1 column per level in the given order, the last level dropped.

    ``levels`` is the ordered level list (e.g. from :func:`category_index`);
    fewer than two levels with ``drop_last`` is an error, as in MLlib.
    A value outside ``levels`` (or NULL) gets all zeros.
    """
    if drop_last and len(levels) < 2:
        raise ValueError(f"One-hot encoding of '{col}' needs at least 2 levels")
    used = list(levels[:-1]) if drop_last else list(levels)
    return df.withColumns({one_hot_name(col, lv): F.coalesce((F.col(col) == F.lit(lv)).cast("int"), F.lit(0))
                           for lv in used})


def preprocessing_stages(spec: TableSpec, label_order: str = "alphabetAsc",
                         handle_invalid: str = "keep") -> list:
    """MLlib stages: label index -> mean imputer -> numeric assembler ->
    unit-std scaler -> per-category indexers -> one-hot encoders ->
    categorical assembler -> final assembler.

    Output names: ``label``, ``{c}_imputed``, ``features_num``,
    ``scaled_features``, ``{c}_indexed``, ``{c}_encoded``, ``features_cat``,
    ``features``.  Differences from the original stage list, each fixing a
    failure mode: the label index is alphabetical (a frequency order swaps
    0/1 when class balance shifts); category indexers keep unseen/NULL
    values in an extra slot instead of failing at scoring time.  Boolean
    and integer inputs must be cast by :func:`prepare_inputs` first.
    """
    from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler

    if spec.target is None:
        raise ValueError("Target column not specified in config")
    num, cat = spec.num_names, spec.cat_names
    if not num and not cat:
        raise ValueError("No feature columns specified in config")
    stages: list = [StringIndexer(inputCol=spec.target, outputCol="label", stringOrderType=label_order)]
    parts = []
    if num:
        stages += [
            Imputer(inputCols=num, outputCols=[f"{c}_imputed" for c in num], strategy="mean"),
            VectorAssembler(inputCols=[f"{c}_imputed" for c in num], outputCol="features_num"),
            StandardScaler(inputCol="features_num", outputCol="scaled_features", withStd=True, withMean=False),
        ]
        parts.append("scaled_features")
    if cat:
        # one indexer over all categorical columns: one pass over the data
        stages += [StringIndexer(inputCols=cat, outputCols=[f"{c}_indexed" for c in cat],
                                 handleInvalid=handle_invalid)]
        stages += [OneHotEncoder(inputCols=[f"{c}_indexed" for c in cat],
                                 outputCols=[f"{c}_encoded" for c in cat], dropLast=True)]
        stages += [VectorAssembler(inputCols=[f"{c}_encoded" for c in cat], outputCol="features_cat")]
        parts.append("features_cat")
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return stages


def prepare_inputs(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast numeric features to double (Imputer would truncate an int mean)
    and boolean/integer categoricals to string (StringIndexer rejects booleans)."""
    types = dict(df.dtypes)
    casts = {}
    for c in spec.num_names:
        if types.get(c) != "double":
            casts[c] = F.col(c).cast("double")
    for c in spec.cat_names:
        if types.get(c) == "boolean":
            casts[c] = F.col(c).cast("int").cast("string")
        elif types.get(c) != "string":
            casts[c] = F.col(c).cast("string")
    if spec.target and types.get(spec.target) not in (None, "string"):
        casts[spec.target] = F.col(spec.target).cast("string")
    return df.withColumns(casts) if casts else df
