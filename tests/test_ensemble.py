"""Given models as column functions: compiled tree ensembles and broadcast Python models."""

import json
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabflow.operators.ensemble import Ensemble, Node, by_name, from_mllib, margin, score_ensemble
from tabflow.operators.model import score_with_model


def plain(tree, row):
    while isinstance(tree, Node):
        x = row[tree.feature]
        left = x is not None and (x in tree.test if isinstance(tree.test, tuple) else x <= tree.test)
        tree = tree.left if left else tree.right
    return tree


def test_ensemble_equals_walk(spark):
    r = random.Random(1)

    def grow(depth):
        if depth == 0 or r.random() < 0.2:
            return r.randint(-8, 8) / 8
        f = r.choice("abc")
        return Node(f, ("x", "z") if f == "c" else float(r.randint(-3, 3)), grow(depth - 1), grow(depth - 1))

    e = Ensemble(tuple(grow(4) for _ in range(8)), tuple(r.choice([0.5, 1.0, 0.25]) for _ in range(8)), 0.125)
    data = [(i, r.choice([None, -5.0, 0.0, 1.5, 3.0]), r.choice([None, -3, 0, 2, 3]), r.choice([None, "x", "y", "z"])) for i in range(300)]
    df = spark.createDataFrame(data, "id long, a double, b int, c string")
    got = score_ensemble(df, e, ["id"]).collect()
    for g in got:
        row = dict(zip(("id", "a", "b", "c"), data[g.id]))
        total = e.bias + sum(w * plain(t, row) for t, w in zip(e.trees, e.weights))
        assert g.margin == pytest.approx(total, abs=1e-12) and g.prediction == float(total > 0)
    plan = score_ensemble(df, e, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert score_ensemble(df.limit(0), e, ["id"]).count() == 0
    with pytest.raises(ValueError, match="Columns not found"):
        score_ensemble(df.drop("a"), e, ["id"])
    with pytest.raises(ValueError):
        Ensemble((1.0,), ())


def test_compiled_ensemble_equals_mllib_transform(spark):
    from tabflow.operators.features import prepare_inputs
    from tabflow.operators.model import train_and_score
    from tabflow.plans.queries_model import ORDERS_SPEC, frames

    population, train, test = frames(spark, "/root/testdata/sf0.001")
    model, _ = train_and_score(train, test, ORDERS_SPEC, materialize_input=False)
    gbt = model.stages[-1]
    scored = model.transform(prepare_inputs(population, ORDERS_SPEC)).withColumn("_x", vector_to_array("features"))
    ensemble = from_mllib(gbt)
    assert len(ensemble.trees) == len(gbt.trees) and all(isinstance(f, int) for f in ensemble.features())
    own = margin(ensemble, lambda i: F.col("_x")[i])
    got = scored.select("prediction", vector_to_array("rawPrediction")[1].alias("raw"), own.alias("own")).collect()
    assert {g.prediction for g in got} == {0.0, 1.0}
    assert all(g.prediction == float(g.own > 0) for g in got)
    assert all(abs(g.raw - g.own) < 1e-9 for g in got)
    assert by_name({0: F.lit(2)})(0) is not None


def opener():
    def open_model(payload):
        import json

        import pandas as pd

        spec, calls = json.loads(payload), [0]

        def predict(batch):
            calls[0] += 1
            return batch["a"].fillna(spec["missing"]) * spec["weight"], pd.Series([calls[0]] * len(batch))

        return predict

    return open_model


def test_python_model_is_opened_once_a_task(spark):
    df = spark.range(0, 24_000, 1, 2).select(F.when(F.col("id") % 5 != 0, F.col("id").cast("double")).alias("a"), "id", F.lit("kept").alias("text"))
    payload = json.dumps({"weight": 0.5, "missing": -2.0}).encode()
    out = score_with_model(df, payload, opener(), ["a"], "y double, batch long")
    assert out.columns == ["a", "id", "text", "y", "batch"]
    assert out.where(F.col("y") != F.coalesce("a", F.lit(-2.0)) * 0.5).count() == 0
    # 12,000 rows a task are two batches; the model of a task saw both
    assert sorted(r.batch for r in out.groupBy("batch").count().collect()) == [1, 2]
    one = score_with_model(df, payload, lambda p: lambda b: b["a"].fillna(0) + 1, ["a"])
    assert one.where(F.col("prediction") == F.coalesce("a", F.lit(0.0)) + 1).count() == 24_000
    replaced = score_with_model(df, payload, opener(), ["a"], "text double, batch long")
    assert replaced.columns == ["a", "id", "text", "batch"] and dict(replaced.dtypes)["text"] == "double"
    assert score_with_model(df.limit(0), payload, opener(), ["a"], "y double, batch long").count() == 0
    with pytest.raises(ValueError, match="Columns not found"):
        score_with_model(df, payload, opener(), ["zz"])
