"""Fitted models whose fit SQL can repeat: a Gaussian naive Bayes classifier
behind the same preprocessing pipeline as the boosted trees.

Its parameters are moments per class, so the oracle fits it again and every
prediction, log-odds, error metric and promotion is compared, not only which
rows were scored.
"""

from __future__ import annotations

import dataclasses

from pyspark.ml.classification import NaiveBayes
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabflow.operators.evaluate import error_metrics
from tabflow.operators.model import train_and_score
from tabflow.plans import standins as S
from tabflow.plans.catalog import register, sround
from tabflow.plans.flows import evaluate_and_promote, log_run
from tabflow.plans.queries_model import LABEL_SQL, ORDERS_SPEC, feature_ctes, frames
from tabflow.session import scratch_path

#: The incumbent knows the numeric columns only.
NUMERIC_SPEC = dataclasses.replace(ORDERS_SPEC, cat_features=())


def _bayes():
    return NaiveBayes(modelType="gaussian", featuresCol="features", labelCol="label")


def _scored_ctes(name: str, feats: list[str]) -> str:
    """CTE ``name``: the population with ``odds``, the log-odds of class 1 by
    moments per class of the training rows.  Variances are raised by 1e-9 of
    the largest, as the classifier does."""
    ks = range(len(feats))
    cols = ", ".join(f"{e} AS f{k}" for k, e in enumerate(feats))
    moments = ", ".join(f"avg(f{k}) AS m{k}, avg(f{k} * f{k}) - avg(f{k}) * avg(f{k}) AS v{k}" for k in ks)
    widest = ", ".join(f"var_pop(f{k})" for k in ks)

    def part(c: str) -> str:
        return " + ".join(f"(f{k} - {c}.m{k}) * (f{k} - {c}.m{k}) / ({c}.v{k} + e) + ln({c}.v{k} + e)" for k in ks)

    return f"""{name}_f AS (SELECT o_orderkey, o_totalprice, o_orderpriority, split, {LABEL_SQL} AS label, {cols} FROM imp, sd),
{name}_m AS (SELECT label, ln(count(*)) AS prior, {moments} FROM {name}_f WHERE split = 'train' GROUP BY label),
{name}_e AS (SELECT 1e-9 * greatest({widest}) AS e FROM {name}_f WHERE split = 'train'),
{name} AS (
  SELECT f.o_orderkey, f.o_totalprice, f.o_orderpriority, f.split, f.label,
         b.prior - a.prior - (({part('b')}) - ({part('a')})) / 2 AS odds
  FROM {name}_f f, {name}_e, (SELECT * FROM {name}_m WHERE label = 0) a, (SELECT * FROM {name}_m WHERE label = 1) b
)"""


_CTES, _FEATS = feature_ctes()
_PREDICTION = "CASE WHEN odds > 0 THEN 1.0 ELSE 0.0 END"


@register("fit_and_score", sql=f"""
WITH {_CTES},
{_scored_ctes("scored", _FEATS)}
SELECT o_orderkey, o_totalprice, o_orderpriority, label, {_PREDICTION} AS prediction, {sround("odds", 3)} AS log_odds
FROM scored
""")
def q_fit_and_score(spark, sf_dir):
    """Fit on the training split, score the whole population: served columns,
    label, prediction and log-odds."""
    population, train, _ = frames(spark, sf_dir)
    _, scored = train_and_score(train, population, ORDERS_SPEC, materialize_input=False, classifier=_bayes())
    raw = vector_to_array("rawPrediction")
    return scored.select(*ORDERS_SPEC.features_to_serve, "label", "prediction", F.round(raw[1] - raw[0], 3).alias("log_odds"))


_METRICS = (f"count(*) AS n, avg(abs(label - ({_PREDICTION}))) AS mae, "
            f"1 - sum(abs(label - ({_PREDICTION}))) / (var_pop(label) * count(*)) AS r2")


@register("fit_evaluate_promote", sql=f"""
WITH {_CTES},
{_scored_ctes("old", _FEATS[:len(ORDERS_SPEC.num_names)])},
{_scored_ctes("new", _FEATS)},
runs AS (
  SELECT 0 AS run_order, {_METRICS} FROM old WHERE split = 'test'
  UNION ALL SELECT 1 AS run_order, {_METRICS} FROM new WHERE split = 'test'
)
SELECT 'orders_bayes' AS model, CAST(row_number() OVER (ORDER BY run_order) AS BIGINT) AS run, {sround("mae", 9)} AS mse,
       {sround("mae", 9)} AS mae, {sround("r2", 9)} AS r2,
       run_order = 0 OR mae < lag(mae) OVER (ORDER BY run_order) AS promoted
FROM runs
""")
def q_fit_evaluate_promote(spark, sf_dir):
    """Train an incumbent on the numeric columns and a challenger on all, log
    both runs, promote by strictly smaller MAE: the run table with its errors
    and which runs became versions."""
    root = scratch_path(spark, "fitted")
    runs_t, reg_t = f"{root}/runs", f"{root}/versions"
    _, train, test = frames(spark, sf_dir)
    for spec in (NUMERIC_SPEC, ORDERS_SPEC):
        _, scored = train_and_score(train, test, spec, materialize_input=False, classifier=_bayes())
        log_run(spark, runs_t, "orders_bayes", error_metrics(scored).first(), spec.params)
        evaluate_and_promote(spark, runs_t, reg_t, "orders_bayes")
    runs, versions = spark.read.parquet(runs_t), spark.read.parquet(reg_t).select("run_id", F.lit(True).alias("promoted"))
    first = runs.agg(F.min("run_order")).scalar()
    return runs.join(versions, "run_id", "left").select(
        "model", (F.col("run_order") - first + 1).cast("long").alias("run"),
        *[F.round(c, 9).alias(c) for c in ("mse", "mae", "r2")], F.coalesce("promoted", F.lit(False)).alias("promoted"))
