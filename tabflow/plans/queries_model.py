"""MLlib queries: preprocessing, boosted-tree training, scoring, and the
predict -> upsert -> profile chain.  Model results are not SQL-expressible,
so these queries return what SQL can check about them: which rows were
scored, their labels and served columns, counts, and whether decisions agree
with metrics recomputed from the predictions.  The SQL forms of each
preprocessing step are checked separately (category_index, impute_mean,
scale_unit_std, one_hot).

The training set is built the way the original intended but never
finished: order rows, features looked up by key from a feature table that
Spark aggregates from lineitem, a customer lookup, and a function feature.
The target is whether an order's lines are worth more than 150 000 together;
no price is among the features.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabflow.config import CatFeature, ModelParams, NumFeature, TableSpec
from tabflow.functions.dates import years_since
from tabflow.operators import keyed, split
from tabflow.operators.features import prepare_inputs, preprocessing_stages
from tabflow.operators.model import FIT_ROWS, score, train_and_score
from tabflow.operators.monitor import drift_series, profile_metrics, window_start
from tabflow.plans import standins as S
from tabflow.plans.catalog import register, sround, table
from tabflow.plans.flows import write_keyed
from tabflow.session import checkpoint_root, scratch_path
from tabflow.sources.tables import materialize, materialize_for_fit, read_newest

AS_OF = dt.date(2025, 1, 1)

ORDERS_SPEC = TableSpec(
    catalog="main", db_schema="default", use_case="orders", primary_key="o_orderkey", target="value_class",
    num_features=(NumFeature("n_lines", min=0), NumFeature("sum_qty", min=0),
                  NumFeature("avg_discount", min=0.0, max=1.0), NumFeature("years_since_order", min=0)),
    cat_features=(CatFeature("o_orderpriority"), CatFeature("c_mktsegment")),
    features_to_serve=("o_orderkey", "o_totalprice", "o_orderpriority"),
    params=ModelParams(learning_rate=0.1, n_estimators=10, max_depth=4, seed=42),
)


def order_features(spark, sf_dir):
    """Feature table keyed by order: aggregated from lineitem."""
    return (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("sum_qty"),
                 F.avg("l_discount").alias("avg_discount"), F.sum("l_extendedprice").alias("worth")))


def training_rows(spark, sf_dir):
    """The whole population once, each row with its split side."""
    orders = table(spark, sf_dir, "orders").withColumn("order_year", F.year("o_orderdate"))
    rows = keyed.training_set(orders, order_features(spark, sf_dir), ("o_orderkey", "l_orderkey"),
                              ["n_lines", "sum_qty", "avg_discount", "worth"], unique=True)
    rows = keyed.training_set(
        rows, table(spark, sf_dir, "customer"), ("o_custkey", "c_custkey"), ["c_mktsegment"],
        functions={"years_since_order": (lambda y: years_since(y, AS_OF), ["order_year"])})
    rows = rows.withColumn("value_class", F.when(F.col("worth") > 150_000, "high").otherwise("low"))
    return split.assign_split(rows.drop("order_year", "worth"), S.PK, ORDERS_SPEC.target, 0.2, 42)


def scans(spark, sf_dir):
    """The population as one written table: a scan for results, and one of a
    file a task for fits and for what is written (even tasks, bounded rows)."""
    return materialize_for_fit(training_rows(spark, sf_dir), "population", FIT_ROWS)


def frames(spark, sf_dir):
    """(population, train, test): one written table that all passes scan, the training rows in small tasks."""
    rows, small = scans(spark, sf_dir)
    return rows, small.where(F.col("split") == split.TRAIN), rows.where(F.col("split") == split.TEST)


def fingerprint(rows) -> str:
    """Changes with any value of any row: count and sum of row hashes."""
    marked = [x for c in rows.columns for x in (F.col(c), F.col(c).isNull())]
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*marked).cast("decimal(38,0)")).alias("h")).first()
    return f"{r['n']}|{r['h']}"


_MODELS: dict = {}
_LOADED: dict = {}
_LOCK = threading.RLock()  # one fit / save per model even if queries run from several threads
# Bump when the stages built by model_pipeline change, so a model saved by
# older code is never loaded by newer code.
MODEL_FORMAT = 4


def fitted_model(spark, sf_dir):
    """Fit once per session and training data, whatever folder it lies in (training queries)."""
    _, train, test = frames(spark, sf_dir)
    with _LOCK:
        key = (spark.sparkContext.applicationId, fingerprint(train), fingerprint(test))
        if key not in _MODELS:
            checkpoint_root(spark)  # tree training checkpoints to the shared folder
            _MODELS[key] = train_and_score(train, test, ORDERS_SPEC, materialize_input=False)
        return _MODELS[key]


def registered_model(spark, train):
    """The model the scoring queries use: loaded from the model folder under
    the shared checkpoint folder (as a scoring job loads a registered
    version); trained on ``train`` and saved there first if there is none for
    this data."""
    import hashlib

    from tabflow.operators.model import load_model, model_pipeline, save_model
    from tabflow.sources.tables import path_exists, publish

    tag = hashlib.md5(f"{MODEL_FORMAT}|{fingerprint(train)}|{ORDERS_SPEC!r}".encode()).hexdigest()[:12]
    path = scratch_path(spark, "models", f"orders_value-{tag}", unique=False)
    key = (spark.sparkContext.applicationId, path)
    with _LOCK:
        if key not in _LOADED:
            if not path_exists(spark, path):
                # written beside, then renamed into place: never a half-written model folder
                staged = f"{scratch_path(spark, 'models', 'staging')}/model"
                save_model(model_pipeline(ORDERS_SPEC).fit(prepare_inputs(train, ORDERS_SPEC)), staged)
                publish(spark, staged, path)
            _LOADED[key] = load_model(path)  # loaded once per session, like a scoring job
        return _LOADED[key]


_POPULATION_SQL = f"""
li AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS sum_qty, avg(l_discount) AS avg_discount,
         sum(l_extendedprice) AS worth
  FROM lineitem GROUP BY l_orderkey
), pop AS (
  SELECT o.o_orderkey, CASE WHEN li.worth > 150000 THEN 'high' ELSE 'low' END AS value_class, o.o_totalprice,
         o.o_orderdate, li.n_lines, li.sum_qty, li.avg_discount,
         CAST(2025 - year(o.o_orderdate) AS INTEGER) AS years_since_order,
         o.o_orderpriority, c.c_mktsegment, {S.split_sql('o.o_orderkey')} AS split
  FROM orders o LEFT JOIN li ON o.o_orderkey = li.l_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey
)"""


def feature_ctes(num=None, cat=None) -> tuple[str, list[str]]:
    """DuckDB twin of the fitted preprocessing pipeline on this training
    split: CTEs of which ``imp, sd`` has the inputs, and the expressions of
    the feature vector over them.

    Numeric block: value imputed with the training mean, divided by the
    training sample stddev of the imputed column.  Categorical blocks: one
    indicator per training level in StringIndexer order (count desc, value
    asc); unseen/NULL -> all zeros (the "keep" slot is the one OneHotEncoder
    drops).
    """
    num, cat = ORDERS_SPEC.num_names if num is None else num, ORDERS_SPEC.cat_names if cat is None else cat
    n_levels = {"o_orderpriority": 5, "c_mktsegment": 5}  # fixed values: level counts of the test data
    means = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}" for c in num)
    imputed = ", ".join(f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS x_{c}" for c in num)
    stds = ", ".join(f"stddev_samp(x_{c}) AS s_{c}" for c in num)
    levels = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS col, v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS INTEGER) AS i "
        f"FROM (SELECT {c} AS v, count(*) AS n FROM train WHERE {c} IS NOT NULL GROUP BY {c}) g" for c in cat)
    feats = [f"CASE WHEN s_{c} = 0 THEN 0.0 ELSE x_{c} / s_{c} END" for c in num]
    for c in cat:
        feats += [f"CASE WHEN {c} = (SELECT v FROM levels WHERE col = '{c}' AND i = {i}) THEN 1.0 ELSE 0.0 END"
                  for i in range(n_levels[c])]
    return f"""{_POPULATION_SQL}, train AS (SELECT * FROM pop WHERE split = 'train'),
m AS (SELECT {means} FROM train),
imp AS (SELECT pop.*, {imputed} FROM pop, m),
sd AS (SELECT {stds} FROM imp WHERE split = 'train'),
levels AS (
{levels}
)""", feats


LABEL_SQL = "CASE WHEN value_class = 'high' THEN 0.0 ELSE 1.0 END"  # alphabetical index of the class


def _preprocess_sql() -> str:
    ctes, feats = feature_ctes()
    width = len(ORDERS_SPEC.num_names)
    cols = ",\n       ".join(f"{sround(e, 6) if k < width else e} AS f_{k:02d}" for k, e in enumerate(feats))
    return f"WITH {ctes}\nSELECT o_orderkey, {LABEL_SQL} AS label,\n       {cols}\nFROM imp, sd"


@register("preprocess_features", sql=_preprocess_sql())
def q_preprocess_features(spark, sf_dir):
    """Fit the preprocessing stages on the training split, transform the
    whole population; the feature vector comes out as columns ``f_00...``."""
    from pyspark.ml import Pipeline

    population, train, _ = frames(spark, sf_dir)
    fit_input = prepare_inputs(train.select(ORDERS_SPEC.target, *ORDERS_SPEC.feature_names), ORDERS_SPEC)
    prep = Pipeline(stages=preprocessing_stages(ORDERS_SPEC)).fit(fit_input)
    out = prep.transform(prepare_inputs(population, ORDERS_SPEC)).select(
        S.PK, "label", vector_to_array("features").alias("_f"))
    width = len(ORDERS_SPEC.num_names)
    n = width + sum(len(lv) for lv in _levels(prep))
    return out.select(S.PK, "label", *[(F.round(F.col("_f")[k], 6) if k < width else F.col("_f")[k])
                                       .alias(f"f_{k:02d}") for k in range(n)])


def _levels(prep_model) -> list:
    """Label lists of the fitted categorical indexer (driver-side metadata)."""
    from pyspark.ml.feature import StringIndexerModel

    idx = [s for s in prep_model.stages if isinstance(s, StringIndexerModel) and s.isSet(s.inputCols)]
    return idx[0].labelsArray if idx else []


@register("train_and_score", sql=f"""
WITH {_POPULATION_SQL}
SELECT o_orderkey, CASE WHEN value_class = 'high' THEN 0.0 ELSE 1.0 END AS label, true AS scored FROM pop WHERE split = 'test'
""")
def q_train_and_score(spark, sf_dir):
    _, scored = fitted_model(spark, sf_dir)
    return scored.select(S.PK, "label", F.col("prediction").isin(0.0, 1.0).alias("scored"))


@register("score_and_serve", sql=f"""
WITH {_POPULATION_SQL} SELECT o_orderkey, o_totalprice, o_orderpriority, true AS scored FROM pop
""")
def q_score_and_serve(spark, sf_dir):
    population, train, _ = frames(spark, sf_dir)
    out = score(registered_model(spark, train), population, ORDERS_SPEC)
    return out.select(*ORDERS_SPEC.features_to_serve, F.col("prediction").isin(0.0, 1.0).alias("scored"))


@register("predict_refresh", sql=f"""
WITH {_POPULATION_SQL}
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS window_start, 'prediction' AS column_name, count(*) AS n,
       0 AS nulls, true AS within FROM pop GROUP BY 1
""")
def q_predict_refresh(spark, sf_dir):
    """Score the population, upsert the predictions twice (a refresh and its
    repetition) into the keyed predictions table, profile them per month.
    The population is scored once; the key checks and both upserts read the
    stored predictions."""
    _, population = scans(spark, sf_dir)  # what is scored is written
    train = population.where(F.col("split") == split.TRAIN)
    preds = score(registered_model(spark, train), population, ORDERS_SPEC, served=[S.PK, "o_orderdate", "o_totalprice"])
    preds = materialize(preds, "scored")
    root = scratch_path(spark, "preds")
    write_keyed(root, preds, S.PK)
    write_keyed(root, preds, S.PK)
    prof = profile_metrics(read_newest(spark, root, S.PK), window_start("o_orderdate", "month"), ["prediction"])
    series = drift_series(prof)
    return series.select("window_start", "column_name", "n", "nulls",
                         (F.col("avg").between(0, 1) & (F.col("flag") == (F.coalesce("pct", F.lit(0.0)) > 50).cast("int"))).alias("within"))


@register("train_evaluate_promote", sql=f"""
WITH {_POPULATION_SQL}
SELECT 'orders_value' AS model, CAST(2 AS BIGINT) AS runs, count(*) AS test_rows, true AS agrees FROM pop WHERE split = 'test'
""")
def q_train_evaluate_promote(spark, sf_dir):
    """Train an incumbent and a challenger, log both runs (error metrics on
    the test split), register the first, promote the challenger only if its
    MAE is strictly smaller.  ``agrees``: logged errors are those of the
    stored predictions, and the registry holds the runs that these errors
    call for."""
    import dataclasses

    from tabflow.operators.evaluate import error_metrics
    from tabflow.plans.flows import evaluate_and_promote, log_run

    root = scratch_path(spark, "registry")
    runs_t, reg_t, preds_t = f"{root}/runs", f"{root}/versions", f"{root}/preds"
    _, train, test = frames(spark, sf_dir)
    for depth in (2, ORDERS_SPEC.params.max_depth):
        params = dataclasses.replace(ORDERS_SPEC.params, max_depth=depth)
        _, scored = train_and_score(train, test, ORDERS_SPEC, params, materialize_input=False)
        stored = f"{preds_t}/max_depth={depth}"
        scored.select(S.PK, "label", "prediction").write.parquet(stored)
        log_run(spark, runs_t, "orders_value", error_metrics(spark.read.parquet(stored)).first(), params)
        evaluate_and_promote(spark, runs_t, reg_t, "orders_value")
    redone = (spark.read.parquet(preds_t).groupBy("max_depth")
                   .agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col("label") - F.col("prediction"))).alias("again")))
    runs = spark.read.parquet(runs_t).join(redone, "max_depth")
    best = runs.agg(F.min_by("again", "run_order").alias("first"), F.max_by("again", "run_order").alias("second"),
                    F.max(F.abs(F.col("again") - F.col("mae"))).alias("off"), F.count(F.lit(1)).alias("runs"), F.max("n").alias("test_rows"),
                    F.max("model").alias("model"))
    versions = spark.read.parquet(reg_t).agg(F.count(F.lit(1))).scalar()
    return best.select("model", "runs", "test_rows",
                       ((F.col("off") < 1e-9) & (versions == F.when(F.col("second") < F.col("first"), 2).otherwise(1))).alias("agrees"))
