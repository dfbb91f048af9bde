"""Model fitting and scoring with ``pyspark.ml`` (stays in the JVM).

``score`` uses ``PipelineModel.transform`` – Catalyst still prunes columns
around it.  ``score_with_udf`` is the slow path for models that are not
MLlib pipelines: an Arrow-batched pandas UDF over a struct of the inputs.
"""

from __future__ import annotations

from typing import Callable, Iterator, Optional, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.config import ModelParams, TableSpec
from tabflow.operators.features import prepare_inputs, preprocessing_stages
from tabflow.operators.split import union_by_name
from tabflow.sources.tables import materialize_for_fit

#: Rows of a task in a fit: tree training caches them, some 370 bytes each with ten features.
FIT_ROWS = 1 << 18


def model_pipeline(spec: TableSpec, params: Optional[ModelParams] = None, classifier=None):
    """Preprocessing stages + ``GBTClassifier`` (binary) as one Pipeline, or
    another ``pyspark.ml`` classifier of ``features`` and ``label``.

    ``max_depth``, ``n_estimators`` -> ``maxIter``, ``learning_rate`` ->
    ``stepSize`` (the original validated the last two but ignored them).
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier

    if classifier is not None:
        return Pipeline(stages=preprocessing_stages(spec) + [classifier])
    p = params or spec.params
    gbt = GBTClassifier(featuresCol="features", labelCol="label", maxDepth=p.max_depth,
                        maxIter=p.n_estimators, stepSize=p.learning_rate, seed=p.seed)
    return Pipeline(stages=preprocessing_stages(spec) + [gbt])


def train_and_score(train: DataFrame, test: DataFrame, spec: TableSpec,
                    params: Optional[ModelParams] = None, materialize_input: bool = True, classifier=None):
    """Fit on ``train`` and transform ``test``: ``(PipelineModel, scored test)``.

    The estimators make several passes over the training input (indexers,
    imputer, scaler, tree rounds).  With ``materialize_input`` the prepared
    training columns are written once to the shared folder and every pass
    scans those files, ``FIT_ROWS`` a task, instead of recomputing the input plan.
    """
    cols = [c for c in [spec.target, *spec.feature_names] if c in train.columns]
    fit_input = prepare_inputs(train.select(*cols), spec)
    if materialize_input:
        _, fit_input = materialize_for_fit(fit_input, "train_input", FIT_ROWS)
    model = model_pipeline(spec, params, classifier).fit(fit_input)
    return model, model.transform(prepare_inputs(test, spec))


def score(model, df: DataFrame, spec: TableSpec, served: Optional[Sequence[str]] = None) -> DataFrame:
    """``prediction`` + served columns (key first) for every row of ``df``."""
    cols = list(served or spec.features_to_serve or [spec.primary_key])
    scored = model.transform(prepare_inputs(df, spec))
    return scored.select("prediction", *cols)


def score_population(model, train: DataFrame, test: DataFrame, spec: TableSpec,
                     served: Optional[Sequence[str]] = None) -> DataFrame:
    """Score train UNION ALL test (the whole population)."""
    return score(model, union_by_name(train, test), spec, served)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)


def score_with_udf(df: DataFrame, predict: Callable, inputs: Sequence[str],
                   out: str = "prediction", return_type: str = "double") -> DataFrame:
    """Score with an arbitrary Python model: ``predict(pandas.DataFrame) -> array``.

    Runs as a scalar pandas UDF (Arrow batches, one call per batch).
    """
    @F.pandas_udf(return_type)
    def _udf(batch: pd.DataFrame) -> pd.Series:
        return pd.Series(predict(batch))

    return df.withColumn(out, _udf(F.struct(*[F.col(c) for c in inputs])))


def score_with_model(df: DataFrame, payload: bytes, open_model: Callable[[bytes], Callable], inputs: Sequence[str],
                     outputs: str = "prediction double") -> DataFrame:
    """``df`` with the columns ``outputs`` (a DDL list) of an arbitrary Python model.

    ``payload`` is the serialised model; it is broadcast once to each executor
    (not shipped with every task) and ``open_model(payload)`` is called once a
    task, before its first batch.  The opened model takes a pandas DataFrame of
    ``inputs`` and returns one value a row, or for several outputs a DataFrame
    or a sequence of columns.  Batches reach it by Arrow; a task holds one at a
    time.  An input column named like an output is replaced.  ``open_model``
    must be importable on the workers, or be a local function, which travels by value.
    """
    from pyspark.sql.types import StructType

    missing = [c for c in inputs if c not in df.columns]
    if missing:
        raise ValueError(f"Columns not found: {missing}")
    names = StructType.fromDDL(outputs).names
    shared = df.sparkSession.sparkContext.broadcast(payload)

    @F.pandas_udf(outputs if len(names) > 1 else StructType.fromDDL(outputs)[0].dataType)
    def predicted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = open_model(shared.value)
        for batch in batches:
            out = model(batch)
            if len(names) == 1:
                yield pd.Series(out)
            else:
                yield out[names] if isinstance(out, pd.DataFrame) else pd.DataFrame(dict(zip(names, out)))

    if len(names) == 1:
        return df.withColumn(names[0], predicted(F.struct(*[F.col(c) for c in inputs])))
    kept = [F.col(c) for c in df.columns if c not in names]
    scored = df.select(*df.columns, predicted(F.struct(*[F.col(c) for c in inputs])).alias("_scored"))
    return scored.select(*kept, *[F.col(f"_scored.{n}").alias(n) for n in names])
