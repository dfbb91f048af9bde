import pytest
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabflow.config import CatFeature, NumFeature, TableSpec
from tabflow.operators import features
from tests.conftest import rows


@pytest.fixture()
def cats(spark):
    vals = ["b"] * 5 + ["a"] * 3 + ["c"] * 3 + ["d"] + [None]
    return spark.createDataFrame([(i, v, float(i) if i % 4 else None) for i, v in enumerate(vals)],
                                 "id long, c string, x double")


def test_category_index_matches_string_indexer(cats):
    ours = [r.value for r in features.category_index(cats, "c").orderBy("index").collect()]
    model = StringIndexer(inputCol="c", outputCol="ci", handleInvalid="skip").fit(cats)
    assert ours == list(model.labels)
    alpha = [r.value for r in features.category_index(cats, "c", order="alphabetAsc").orderBy("index").collect()]
    assert alpha == ["a", "b", "c", "d"]


def test_global_row_number_many_partitions(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(9)
    out = features.global_row_number(df, [F.col("v").asc()], "pos")
    assert rows(out, "v", "pos") == [(i, i) for i in range(1000)]


def test_impute_mean_matches_imputer(cats):
    ours = rows(features.impute_mean(cats, ["x"]), "id", "x_imputed")
    m = Imputer(inputCols=["x"], outputCols=["x_imputed"], strategy="mean").fit(cats)
    theirs = rows(m.transform(cats), "id", "x_imputed")
    assert [(a, round(b, 9)) for a, b in ours] == [(a, round(b, 9)) for a, b in theirs]


def test_impute_int_not_truncated(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "n int")
    vals = {r.n_imputed for r in features.impute_mean(df, ["n"]).collect()}
    assert any(abs(v - 5 / 3) < 1e-12 for v in vals)


def test_scale_matches_standard_scaler(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 4.0, 5.0)], "id long, a double, k double")
    ours = rows(features.scale_unit_std(df, ["a", "k"]), "id", "a_scaled", "k_scaled")
    va = VectorAssembler(inputCols=["a", "k"], outputCol="v").transform(df)
    sc = StandardScaler(inputCol="v", outputCol="s", withStd=True, withMean=False).fit(va).transform(va)
    theirs = rows(sc.select("id", vector_to_array("s").alias("s")).select(
        "id", F.col("s")[0], F.col("s")[1]))
    assert [tuple(round(v, 9) for v in r) for r in ours] == [tuple(round(v, 9) for v in r) for r in theirs]


def test_one_hot_matches_encoder(cats):
    levels = [r.value for r in features.category_index(cats, "c").orderBy("index").collect()]
    ours = features.one_hot(cats.where("c is not null"), "c", levels)
    idx = StringIndexer(inputCol="c", outputCol="ci", handleInvalid="skip").fit(cats).transform(cats)
    enc = OneHotEncoder(inputCols=["ci"], outputCols=["oh"], dropLast=True).fit(idx).transform(idx)
    theirs = rows(enc.select("id", vector_to_array("oh").alias("oh")).select(
        "id", *[F.col("oh")[i].cast("int") for i in range(len(levels) - 1)]))
    assert rows(ours.select("id", *[features.one_hot_name("c", lv) for lv in levels[:-1]])) == theirs
    with pytest.raises(ValueError):
        features.one_hot(cats, "c", ["only"])


def spec(**kw):
    base = dict(catalog="c", db_schema="s", use_case="u", primary_key="Booking_ID", target="booking_status",
                num_features=(NumFeature("no_of_adults"), NumFeature("avg_price_per_room")),
                cat_features=(CatFeature("type_of_meal_plan"), CatFeature("required_car_parking_space")))
    base.update(kw)
    return TableSpec(**base)


def test_stage_errors():
    with pytest.raises(ValueError, match="Target column not specified in config"):
        features.preprocessing_stages(spec(target=None))
    with pytest.raises(ValueError, match="No feature columns specified in config"):
        features.preprocessing_stages(spec(num_features=(), cat_features=()))


def test_stage_types():
    names = [type(s).__name__ for s in features.preprocessing_stages(spec())]
    assert names[0] == "StringIndexer" and "Imputer" in names and "StandardScaler" in names
    assert "OneHotEncoder" in names and names[-1] == "VectorAssembler"


def test_pipeline_fits_with_bool_and_long(spark):
    from pyspark.ml import Pipeline

    df = spark.createDataFrame(
        [(25, 50000, "Meal Plan 1", True, 1, "A"), (30, 60000, "Meal Plan 2", False, 0, "B"),
         (None, 70000, "Meal Plan 2", None, 1, "C")],
        "no_of_adults long, avg_price_per_room long, type_of_meal_plan string, "
        "required_car_parking_space boolean, booking_status long, Booking_ID string")
    s = spec()
    prepared = features.prepare_inputs(df, s)
    out = Pipeline(stages=features.preprocessing_stages(s)).fit(prepared).transform(prepared)
    assert out.select("features").count() == 3
    for c in ("label", "features_num", "scaled_features", "features_cat", "no_of_adults_imputed",
              "type_of_meal_plan_indexed", "type_of_meal_plan_encoded"):
        assert c in out.columns
