import pytest
from pyspark.sql import functions as F

from tabflow.config import CatFeature, ModelParams, NumFeature, TableSpec
from tabflow.operators import model, split
from tabflow.operators.evaluate import classification_metrics
from tabflow.session import scratch_path
from tests.conftest import rows

SPEC = TableSpec(catalog="c", db_schema="s", use_case="u", primary_key="id", target="cls",
                 num_features=(NumFeature("x"), NumFeature("noise")),
                 cat_features=(CatFeature("flag"),), features_to_serve=("id", "x"),
                 params=ModelParams(learning_rate=0.3, n_estimators=5, max_depth=3))


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(0, 2000).select(
        "id", (F.col("id") % 100).cast("double").alias("x"), (F.col("id") * 37 % 11).cast("int").alias("noise"),
        F.when(F.col("id") % 2 == 0, True).otherwise(False).alias("flag"))
    return df.withColumn("cls", F.when(F.col("x") > 60, "yes").otherwise("no"))


@pytest.fixture(scope="module")
def fitted(data):
    train, test = split.hash_split(data, "id", "cls", 0.25, 1)
    return (*model.train_and_score(train, test, SPEC), train, test)


def test_beats_majority(fitted):
    _, scored, _, test = fitted
    acc = classification_metrics(scored).first().accuracy
    majority = max(test.groupBy("cls").count().toPandas()["count"]) / test.count()
    assert acc > majority


def test_deterministic(data, fitted):
    _, scored, train, test = fitted
    _, again = model.train_and_score(train, test, SPEC)
    assert rows(scored, "id", "prediction") == rows(again, "id", "prediction")


def test_fit_tasks_hold_bounded_rows(spark, data, monkeypatch):
    """Tree training caches what its tasks read, so no task of a fit reads more than FIT_ROWS, whatever the input's size."""
    from pyspark.ml.classification import GBTClassifier

    per_task = {}

    class Watched(GBTClassifier):
        def _fit(self, dataset):
            per_task[len(per_task)] = dataset.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
            return super()._fit(dataset)

    monkeypatch.setattr(model, "FIT_ROWS", 300)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    gbt = Watched(featuresCol="features", labelCol="label", maxDepth=2, maxIter=2, seed=1)
    _, scored = model.train_and_score(data, data, SPEC, classifier=gbt)
    assert sum(per_task[0]) == 2000 and max(per_task[0]) <= 300
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    assert scored.sparkSession._jsparkSession.equals(spark._jsparkSession) and scored.count() == 2000


def test_save_load_roundtrip(fitted, spark):
    m, scored, _, test = fitted
    path = scratch_path(spark, "model")
    model.save_model(m, path)
    loaded = model.load_model(path)
    assert rows(model.score(loaded, test, SPEC)) == rows(model.score(m, test, SPEC))


def test_score_population_served_columns(fitted):
    m, _, train, test = fitted
    out = model.score_population(m, train, test, SPEC)
    assert out.columns == ["prediction", "id", "x"]
    assert out.count() == train.count() + test.count()


def test_params_validated():
    with pytest.raises(ValueError):
        ModelParams(learning_rate=0)
    with pytest.raises(ValueError):
        ModelParams(max_depth=33)


def test_score_with_pandas_udf(spark):
    df = spark.range(0, 10).select("id", (F.col("id") * 2.0).alias("x"))
    out = model.score_with_udf(df, lambda pdf: pdf["x"] + 1.0, ["x"])
    assert [r.prediction for r in out.orderBy("id").collect()] == [i * 2.0 + 1.0 for i in range(10)]


def test_registered_model_queries(spark, sf_small):
    import __spark_entry__ as e

    from tabflow.plans import queries_model as q

    assert not {"o_totalprice", "worth"} & set(q.ORDERS_SPEC.feature_names)  # nothing the label is made of
    _, scored = q.fitted_model(spark, sf_small)
    acc = classification_metrics(scored).first().accuracy
    counts = [r["count"] for r in scored.groupBy("label").count().collect()]
    assert acc > max(counts) / sum(counts)
    rows_, _, _ = q.frames(spark, sf_small)
    changed = rows_.withColumn("sum_qty", F.when(F.col("o_orderkey") == rows_.first()["o_orderkey"], -1.0).otherwise(F.col("sum_qty")))
    assert q.fingerprint(rows_) == q.fingerprint(rows_.repartition(3)) != q.fingerprint(changed)
    served = e.queries()["score_and_serve"](spark, sf_small)
    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    assert served.columns == ["o_orderkey", "o_totalprice", "o_orderpriority", "scored"]
    assert served.count() == orders.count()
    assert served.select("o_orderkey").distinct().count() == orders.count()


def test_score_and_serve_fits_on_bounded_tasks(spark, sf_small, monkeypatch):
    """What score_and_serve fits on is the whole training side in tasks of at most FIT_ROWS; its result is of the caller's session."""
    import __spark_entry__ as e

    from tabflow.plans import queries_model as q

    registered, per_task = q.registered_model, []

    def watched(session, train):
        per_task.extend(train.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect())
        return registered(session, train)

    monkeypatch.setattr(q, "FIT_ROWS", 200, raising=False)
    monkeypatch.setattr(q, "registered_model", watched)
    served = e.queries()["score_and_serve"](spark, sf_small)
    population = q.training_rows(spark, sf_small)
    assert max(per_task) <= 200 and sum(per_task) == population.where(F.col("split") == split.TRAIN).count() > 200
    assert served.sparkSession._jsparkSession.equals(spark._jsparkSession)
    assert served.count() == population.count()


def test_refresh_scores_the_population_once(spark, sf_small, monkeypatch):
    """Both upserts and their key checks read stored predictions; neither runs the model again."""
    import __spark_entry__ as e

    from tabflow.plans import queries_model as q

    write, written = q.write_keyed, []

    def watched(root, new, pk):
        written.append((new._jdf.queryExecution().optimizedPlan().toString(), new.count()))
        return write(root, new, pk)

    monkeypatch.setattr(q, "write_keyed", watched)
    profile = e.queries()["predict_refresh"](spark, sf_small).collect()
    n = spark.read.parquet(f"{sf_small}/orders.parquet").count()
    assert [c for _, c in written] == [n, n] and sum(r.n for r in profile) == n and all(r.within for r in profile)
    assert not any("UDF(" in plan for plan, _ in written)


def test_fitted_queries_see_wrong_predictions(spark, sf_small):
    """Predictions of the fit that SQL repeats take both values and beat the majority; the run table follows them."""
    import __spark_entry__ as e

    scored = e.queries()["fit_and_score"](spark, sf_small).collect()
    labels = [r.label for r in scored]
    right = sum(r.label == r.prediction for r in scored)
    assert {r.prediction for r in scored} == {0.0, 1.0}
    assert right > max(labels.count(0.0), labels.count(1.0))
    assert all((r.log_odds > 0) == (r.prediction == 1.0) for r in scored if r.log_odds)
    runs = sorted(e.queries()["fit_evaluate_promote"](spark, sf_small).collect(), key=lambda r: r.run)
    assert [r.run for r in runs] == [1, 2] and runs[0].promoted and runs[1].promoted == (runs[1].mae < runs[0].mae)
