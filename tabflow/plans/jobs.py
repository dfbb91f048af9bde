"""The scheduled jobs of the original application, as functions over a
table layout: each takes the session, a :class:`TableSpec` and a
:class:`Layout`, reads and writes whole tables, and returns its outcome
(flags, ids, decision rows) instead of passing it through a side channel.

Order of a weekly run: ``preprocess`` -> ``featurise`` -> ``train`` ->
``evaluate`` -> ``deploy`` (when promoted) -> ``predict_and_monitor``
(whenever there are new rows, for normal and for shifted data) -> ``alert``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.config import DRIFT_SUFFIX, CatFeature, ModelParams, NumFeature, TableSpec
from tabflow.functions.dates import years_since
from tabflow.operators import keyed
from tabflow.operators.evaluate import error_metrics
from tabflow.operators.model import load_model, save_model, score_population, train_and_score
from tabflow.operators.monitor import drift_alert, drift_series, snapshot_profile
from tabflow.plans.flows import evaluate_and_promote, incremental_split, log_run, new_run_id, split_tables, write_keyed
from tabflow.session import scratch_path
from tabflow.sources.tables import append_batch, get_bool_property, overwrite, publish, read_newest, set_property


CHANGE_FEED = "enableChangeDataFeed"
SNAPSHOT_KEY = ("window", "column_name")
SHARED = ("profile", "models", "runs", "versions")


@dataclass(frozen=True)
class Layout:
    """Where the tables of one use case live (a folder in shared storage).
    Shifted data has tables of its own, but for the prediction profile and
    the model, which it shares with normal data."""

    root: str
    drift: bool = False

    def path(self, role: str) -> str:
        return f"{self.root.rstrip('/')}/{role}{DRIFT_SUFFIX if self.drift and role not in SHARED else ''}"


# The booking use case's declared features, constraints and key (original config).
BOOKING_SPEC = TableSpec(
    catalog="main", db_schema="default", use_case="bookings", primary_key="Booking_ID",
    target="booking_status",
    num_features=(
        NumFeature("no_of_adults", "integer", min=0),
        NumFeature("no_of_children", "integer", min=0),
        NumFeature("no_of_weekend_nights", "integer", min=0),
        NumFeature("no_of_week_nights", "integer", min=0),
        NumFeature("no_of_special_requests", "integer", min=0),
        NumFeature("avg_price_per_room", "float", min=0.0),
        NumFeature("no_of_previous_bookings_not_canceled", "integer", min=0),
        NumFeature("no_of_previous_cancellations", "integer", min=0),
        NumFeature("lead_time", "integer", min=0),
        NumFeature("years_since_booking", "integer"),  # function feature, added by training_frame
    ),
    cat_features=(
        CatFeature("type_of_meal_plan", "string", ("Meal Plan 1", "Meal Plan 2", "Meal Plan 3", "Not Selected")),
        CatFeature("required_car_parking_space", "bool", (True, False), (1, 0)),
        CatFeature("room_type_reserved", "string", ("Room_Type 1", "Room_Type 2", "Room_Type 3", "Room_Type 4",
                                                     "Room_Type 5", "Room_Type 6", "Room_Type 7")),
        CatFeature("repeated_guest", "bool", (True, False), (1, 0)),
        CatFeature("market_segment_type", "string", ("Online", "Offline", "Complementary", "Corporate", "Aviation")),
        CatFeature("arrival_date", "integer", tuple(range(1, 32))),
        CatFeature("arrival_month", "integer", tuple(range(1, 13))),
        CatFeature("arrival_year", "integer", (2017, 2018)),
    ),
    features_to_serve=("Booking_ID", "avg_price_per_room", "no_of_week_nights"),
    params=ModelParams(learning_rate=0.01, n_estimators=1000, max_depth=6),
)


def preprocess(spark: SparkSession, spec: TableSpec, layout: Layout, test_size: float = 0.2,
               seed: int = 42) -> bool:
    """Split the raw rows not yet split; returns ``refreshed``."""
    return incremental_split(spark.read.parquet(layout.path("raw")), layout.path("split"), spec.primary_key,
                             spec.target, test_size, seed)


def featurise(spark: SparkSession, spec: TableSpec, layout: Layout) -> str:
    """Upsert the raw table into the keyed input-features table."""
    return write_keyed(layout.path("input_features"), spark.read.parquet(layout.path("raw")), spec.primary_key)


def publish_table(spark: SparkSession, spec: TableSpec, layout: Layout, role: str, database: Optional[str] = None) -> str:
    """The state of a keyed table as a managed catalog table, its change feed
    property switched on once.  The name follows the spec; ``database``
    replaces its catalog and schema where the session has only one catalog."""
    name = spec.table_name(role, layout.drift)
    if database is not None:
        name = f"{database}.{name.rsplit('.', 1)[1]}"
    overwrite(read_newest(spark, layout.path(role), spec.primary_key), name)
    if not get_bool_property(spark, name, CHANGE_FEED):
        set_property(spark, name, CHANGE_FEED, "true")
    return name


def training_frame(spark: SparkSession, spec: TableSpec, layout: Layout, as_of: dt.date) -> tuple[DataFrame, DataFrame]:
    """Train/test splits with ``avg_price_per_room`` looked up from the
    feature table and ``years_since_booking`` as a function feature."""
    train, test = split_tables(spark, layout.path("split"))
    feats = read_newest(spark, layout.path("input_features"), spec.primary_key)

    def enrich(df: DataFrame) -> DataFrame:
        df = df.withColumn("arrival_year", F.col("arrival_year").cast("int"))
        return keyed.training_set(
            df, feats, spec.primary_key, ["avg_price_per_room"], label=spec.target, unique=True,
            functions={"years_since_booking": (lambda y: years_since(y, as_of), ["arrival_year"])})

    return enrich(train), enrich(test)


def train(spark: SparkSession, spec: TableSpec, layout: Layout, model_name: str,
          params: Optional[ModelParams] = None, as_of: dt.date = dt.date(2025, 1, 1)) -> str:
    """Fit on the train split, log MSE/MAE/R2 on the test split as a run,
    save the model under the run id.  Returns the run id."""
    p = params or spec.params
    tr, te = training_frame(spark, spec, layout, as_of)
    model, scored = train_and_score(tr, te, spec, p)
    metrics = error_metrics(scored).first()
    run_id = new_run_id(model_name)
    # the model is in place before its run is logged: a logged run always has a complete model
    staged = scratch_path(spark, "models", "staging")
    save_model(model, staged)
    if not publish(spark, staged, f"{layout.path('models')}/{run_id}"):
        raise RuntimeError(f"Model folder for {run_id} already exists")
    return log_run(spark, layout.path("runs"), model_name, metrics, p, run_id=run_id)


def evaluate(spark: SparkSession, layout: Layout, model_name: str) -> DataFrame:
    """Champion/challenger decision (registers the newest run when better)."""
    return evaluate_and_promote(spark, layout.path("runs"), layout.path("versions"), model_name)


def current_model(spark: SparkSession, layout: Layout, model_name: str):
    versions = spark.read.parquet(layout.path("versions")).where(F.col("model") == model_name)
    run_id = versions.agg(F.max_by("run_id", "version")).first()[0]
    return load_model(f"{layout.path('models')}/{run_id}")


def predict(spark: SparkSession, spec: TableSpec, layout: Layout, model_name: str,
            as_of: dt.date = dt.date(2025, 1, 1)) -> str:
    """Score train + test with the current version; upsert predictions and
    served columns into the keyed predictions table."""
    model = current_model(spark, layout, model_name)
    tr, te = training_frame(spark, spec, layout, as_of)
    preds = score_population(model, tr, te, spec, served=list(spec.features_to_serve) + ["arrival_month"])
    return write_keyed(layout.path("preds"), preds, spec.primary_key)


deploy = predict  # a better model scores everything again


def predict_and_monitor(spark: SparkSession, spec: TableSpec, layout: Layout, model_name: str, refreshed_at: dt.datetime,
                        as_of: dt.date = dt.date(2025, 1, 1)) -> DataFrame:
    """A refresh: score the population, upsert the predictions, and append one
    profile snapshot of the predictions table whose window is ``refreshed_at``
    (a time without zone).  Repeating a refresh replaces its snapshot.
    Returns all snapshots."""
    predict(spark, spec, layout, model_name, as_of)
    preds = read_newest(spark, layout.path("preds"), spec.primary_key)
    profile = snapshot_profile(preds, refreshed_at.isoformat(sep=" "), ["prediction"])
    batch = int((refreshed_at - dt.datetime(1970, 1, 1)).total_seconds())
    append_batch(profile, layout.path("profile"), SNAPSHOT_KEY, batch)
    return read_newest(spark, layout.path("profile"), SNAPSHOT_KEY)


def alert(spark: SparkSession, layout: Layout, threshold: float = 50.0) -> DataFrame:
    """Drift flag of the newest refresh against the one before."""
    prof = read_newest(spark, layout.path("profile"), SNAPSHOT_KEY).where(F.col("column_name") == "prediction")
    return drift_alert(drift_series(prof, window_col="window", threshold=threshold), window_col="window")
