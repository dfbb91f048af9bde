"""Id continuation and drift injection as table operators.

New ids come from ``spark.range`` (partitioned, no driver loop); the only
value that travels to the driver is one aggregate (the largest id number).
"""

from __future__ import annotations

from typing import Mapping, Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions.ids import format_id, id_suffix, quote_prefix


def max_id_number(df: DataFrame, id_col: str, prefix: str) -> tuple[Optional[int], int]:
    """``(largest number after prefix, digits of the widest such id)``; one aggregate."""
    num = id_suffix(id_col, prefix)
    digits = F.length(F.regexp_extract(F.col(id_col), quote_prefix(prefix) + r"(\d+)", 1))
    row = df.agg(F.max(num).alias("mx"), F.max(F.when(num.isNotNull(), digits)).alias("w")).first()
    return row["mx"], row["w"] or 0


def next_ids(df: DataFrame, id_col: str, n: int, prefix: str, width: Optional[int] = None,
             keep_width: bool = False, num_partitions: Optional[int] = None) -> DataFrame:
    """``n`` consecutive ids after the largest existing one: column ``new_id``.

    Only ids containing ``prefix`` count.  Padding: ``width`` if given; else
    the observed width of existing ids when ``keep_width``; else the number
    of digits of the maximum (the original rule, which turns ``INN01207``
    into ``INN1208``).  Ids never get truncated.  ``n == 0`` gives an empty
    frame; no existing id raises ``ValueError``.
    """
    if n < 0:
        raise ValueError(f"n must be >= 0, got {n}")
    mx, observed = max_id_number(df, id_col, prefix)
    if mx is None:
        raise ValueError(f"No existing ids with prefix '{prefix}' in column '{id_col}'")
    w = width if width is not None else (observed if keep_width else len(str(mx)))
    spark = df.sparkSession
    ids = spark.range(mx + 1, mx + 1 + n, numPartitions=num_partitions) if num_partitions \
        else spark.range(mx + 1, mx + 1 + n)
    return ids.select(F.col("id").alias("_num"), format_id(prefix, F.col("id"), w).alias("new_id"))


def shift_columns(df: DataFrame, factors: Mapping[str, float]) -> DataFrame:
    """Multiply columns by factors, keeping each column's type (drift injection)."""
    types = dict(df.dtypes)
    missing = [c for c in factors if c not in types]
    if missing:
        raise ValueError(f"Columns not found: {missing}")
    return df.withColumns({c: (F.col(c) * F.lit(f)).cast(types[c]) for c, f in factors.items()})
