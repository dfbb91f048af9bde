import pytest
from pyspark.ml.evaluation import RegressionEvaluator

from tabflow.operators import evaluate


@pytest.fixture()
def preds(spark):
    # FIXTURES F4
    return spark.createDataFrame([(3.0, 2.5), (5.0, 5.1), (6.0, 5.9), (8.0, 7.8), (9.0, 9.2)],
                                 "label double, prediction double")


def test_error_metrics_exact(preds):
    m = evaluate.error_metrics(preds).first()
    assert m.n == 5
    assert m.mse == pytest.approx(0.07)
    assert m.mae == pytest.approx(0.22)
    assert m.r2 == pytest.approx(0.9846491228070176)


def test_error_metrics_equal_mllib(preds):
    m = evaluate.error_metrics(preds).first()
    ev = RegressionEvaluator()
    for name in ("mse", "mae", "r2"):
        assert getattr(m, name) == pytest.approx(ev.evaluate(preds, {ev.metricName: name}))


@pytest.mark.parametrize("col", ["label", "prediction"])
def test_error_metrics_missing(preds, col):
    with pytest.raises(ValueError, match=col.capitalize() if col == "label" else "Prediction"):
        evaluate.error_metrics(preds.drop(col))


def test_constant_label_r2_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "label double, prediction double")
    assert evaluate.error_metrics(df).first().r2 is None


def test_nulls(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 2.0)], "label double, prediction double")
    assert evaluate.error_metrics(df).first().n == 1
    with pytest.raises(Exception):
        evaluate.error_metrics(df, nulls="raise").collect()


def test_classification_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (1.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    m = evaluate.classification_metrics(df).first()
    assert (m.accuracy, m.precision, m.recall) == (0.5, 0.5, 0.5)


def test_champion_challenger(spark):
    runs = spark.createDataFrame(
        [("m", "r1", 1, 0.30), ("m", "r2", 2, 0.20), ("m", "r3", 3, 0.20),   # equal -> keep incumbent
         ("k", "k1", 1, 0.5), ("k", "k2", 2, 0.4),                           # better -> promote
         ("n", "n1", 1, 0.9)],                                              # first model -> promote
        "model string, run_id string, run_order int, mae double")
    registry = spark.createDataFrame([("m", 1, "r1"), ("m", 2, "r2"), ("k", 1, "k1")],
                                     "model string, version int, run_id string")
    got = {r.model: (r.current_run, r.new_run, r.promote)
           for r in evaluate.champion_challenger(runs, registry).collect()}
    assert got == {"m": ("r2", "r3", False), "k": ("k1", "k2", True), "n": (None, "n1", True)}


def test_run_log_and_promotion_flow(spark):
    from tabflow.config import ModelParams
    from tabflow.plans.flows import evaluate_and_promote, log_run
    from tabflow.session import scratch_path

    root = scratch_path(spark, "t_registry")
    runs, reg = f"{root}/runs", f"{root}/versions"
    p = ModelParams()

    ids = []

    def step(mae):
        ids.append(log_run(spark, runs, "m", {"mse": mae, "mae": mae, "r2": 0.5}, p))
        return evaluate_and_promote(spark, runs, reg, "m").first()

    assert step(0.30).promote is True            # first model is always registered
    assert step(0.30).promote is False           # equal MAE keeps the incumbent
    d = step(0.25)
    assert d.promote is True and d.current_run == ids[0] and d.new_run == ids[2]
    versions = sorted((r.version, r.run_id) for r in spark.read.parquet(reg).collect())
    assert versions == [(1, ids[0]), (2, ids[2])]
    assert len(set(ids)) == 3


def test_champion_challenger_with_run_ids_shared_by_models(spark):
    from tabflow.operators.evaluate import champion_challenger

    runs = spark.createDataFrame([("m", "r1", 1, 0.5), ("m", "r2", 2, 0.4), ("n", "r1", 1, 0.1), ("n", "r2", 2, 0.3)],
                                 "model string, run_id string, run_order int, mae double")
    registry = spark.createDataFrame([("m", 1, "r1"), ("n", 1, "r1")], "model string, version int, run_id string")
    got = {r.model: (r.current_mae, r.new_mae, r.promote) for r in champion_challenger(runs, registry).collect()}
    assert got == {"m": (0.5, 0.4, True), "n": (0.1, 0.3, False)}
    assert champion_challenger(runs, registry).count() == 2
