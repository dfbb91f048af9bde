"""Scoring with given models, whose predictions SQL can recompute.

The population is that of the training queries: orders with features
aggregated from lineitem and looked up from customer, orders without lines
included (their features are null).
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tabflow.operators.ensemble import Ensemble, Node, score_ensemble
from tabflow.operators.model import score_with_model
from tabflow.operators.monitor import drift_series, profile_metrics, window_start
from tabflow.plans import standins as S
from tabflow.plans.catalog import exact, exact_avg_sql, register, sround
from tabflow.plans.flows import write_keyed
from tabflow.plans.queries_model import _POPULATION_SQL, training_rows
from tabflow.session import scratch_path
from tabflow.sources.tables import read_newest

#: A linear model: weights by feature, value of a missing feature, bias; class 1 where the margin is above 0.
LINEAR = {"weights": {"n_lines": -0.5, "sum_qty": 0.0625, "avg_discount": -8.0, "years_since_order": 0.125},
          "missing": {"n_lines": 0.0, "sum_qty": 0.0, "avg_discount": 0.05, "years_since_order": 27.0}, "bias": -4.5}


def linear_opener():
    """Opens the linear model of a JSON text: margins and classes of a batch
    (a local function travels by value, so workers need not import this module)."""

    def open_linear(payload: bytes):
        import json

        spec = json.loads(payload)

        def predict(batch):
            total = spec["bias"]
            for name, weight in spec["weights"].items():
                total = total + weight * batch[name].astype("float64").fillna(spec["missing"][name])
            return total, (total > 0).astype("float64")

        return predict

    return open_linear


_LINEAR_SQL = " + ".join([f"CAST({LINEAR['bias']} AS DOUBLE)"] + [
    f"CAST({w} AS DOUBLE) * coalesce(CAST({c} AS DOUBLE), {LINEAR['missing'][c]})" for c, w in LINEAR["weights"].items()])


@register("score_python_model", sql=f"""
WITH {_POPULATION_SQL}, m AS (SELECT *, {_LINEAR_SQL} AS margin FROM pop)
SELECT o_orderkey, o_totalprice, {sround("margin", 6)} AS margin, CASE WHEN margin > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM m
""")
def q_score_python_model(spark, sf_dir):
    """A Python model, broadcast and opened once a task, over the whole population."""
    out = score_with_model(training_rows(spark, sf_dir), json.dumps(LINEAR).encode(), linear_opener(), list(LINEAR["weights"]),
                           "margin double, prediction double")
    return out.select(S.PK, "o_totalprice", F.round("margin", 6).alias("margin"), "prediction")


#: Three given trees: size of the order, its kind, its age and discount.
ENSEMBLE = Ensemble(
    trees=(Node("sum_qty", 96.5, Node("n_lines", 2.0, -1.0, -0.25), Node("n_lines", 4.0, 0.75, 1.25)),
           Node("o_orderpriority", ("1-URGENT", "2-HIGH"), Node("avg_discount", 0.0512345, 0.5, -0.5), 0.125),
           Node("c_mktsegment", ("BUILDING", "MACHINERY"), -0.375, Node("years_since_order", 28.0, 0.25, -0.125))),
    weights=(1.0, 0.5, 0.25), bias=-0.0625)

_ENSEMBLE_SQL = """
CAST(-0.0625 AS DOUBLE)
  + 1.0 * CASE WHEN sum_qty <= 96.5 THEN CASE WHEN n_lines <= 2 THEN -1.0 ELSE -0.25 END ELSE CASE WHEN n_lines <= 4 THEN 0.75 ELSE 1.25 END END
  + 0.5 * CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CASE WHEN avg_discount <= 0.0512345 THEN 0.5 ELSE -0.5 END ELSE 0.125 END
  + 0.25 * CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN -0.375 ELSE CASE WHEN years_since_order <= 28 THEN 0.25 ELSE -0.125 END END
"""


@register("serve_ensemble", sql=f"""
WITH {_POPULATION_SQL}, m AS (SELECT *, {_ENSEMBLE_SQL} AS margin FROM pop)
SELECT o_orderkey, o_totalprice, o_orderpriority, {sround("margin", 6)} AS margin,
       CASE WHEN margin > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM m
""")
def q_serve_ensemble(spark, sf_dir):
    """Predictions and served columns of the whole population by a given tree ensemble, as one projection."""
    out = score_ensemble(training_rows(spark, sf_dir), ENSEMBLE, [S.PK, "o_totalprice", "o_orderpriority"])
    return out.withColumn("margin", F.round("margin", 6))


@register("ensemble_refresh", sql=f"""
WITH {_POPULATION_SQL}, m AS (SELECT *, CASE WHEN {_ENSEMBLE_SQL} > 0 THEN 1.0 ELSE 0.0 END AS prediction FROM pop),
q AS (SELECT o_orderdate, CASE WHEN o_orderdate >= TIMESTAMP '{S.UPDATE_FROM}' THEN 1.0 - prediction ELSE prediction END AS prediction FROM m),
p AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS window_start, 'prediction' AS column_name, count(*) AS n,
        {exact_avg_sql("prediction")} AS avg FROM q GROUP BY 1),
s AS (SELECT *, lead(avg, 1) OVER (ORDER BY window_start DESC) AS prev FROM p),
d AS (SELECT *, {sround("(avg - prev) * 100.0 / nullif(prev, 0)", 1)} AS pct FROM s)
SELECT window_start, column_name, n, {sround("avg", 6)} AS avg, pct, CASE WHEN pct > 50.0 THEN 1 ELSE 0 END AS flag FROM d
""")
def q_ensemble_refresh(spark, sf_dir):
    """Predictions upserted into a keyed table; a refresh turns those of late
    orders around; averages, changes and flags per month of the newest rows."""
    preds = score_ensemble(training_rows(spark, sf_dir), ENSEMBLE, [S.PK, "o_orderdate"]).drop("margin")
    root = scratch_path(spark, "ensemble_preds")
    write_keyed(root, preds, S.PK)
    late = read_newest(spark, root, S.PK).where(F.col("o_orderdate") >= S.ts(S.UPDATE_FROM))
    write_keyed(root, late.withColumn("prediction", 1.0 - F.col("prediction")), S.PK)
    state = read_newest(spark, root, S.PK).withColumn("prediction", exact("prediction"))
    series = drift_series(profile_metrics(state, window_start("o_orderdate", "month"), ["prediction"]))
    return series.select("window_start", "column_name", "n", F.round("avg", 6).alias("avg"), "pct", "flag")
