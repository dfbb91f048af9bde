"""End-to-end run of the jobs on a small booking table."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabflow.config import ModelParams
from tabflow.operators import generate
from tabflow.operators.quality import check_constraints
from tabflow.plans import jobs
from tabflow.session import scratch_path
from tabflow.sources.tables import append, get_bool_property, read_newest

SPEC = dataclasses.replace(jobs.BOOKING_SPEC, params=ModelParams(learning_rate=0.3, n_estimators=3, max_depth=3))


def bookings(spark, first, last):
    """Bookings whose status depends on the lead time; meal plans and years are not the declared ones."""
    i = F.col("id")
    num = {"no_of_adults": i % 4 + 1, "no_of_children": i % 3, "no_of_weekend_nights": i % 4, "no_of_week_nights": i % 8,
           "required_car_parking_space": i % 2, "lead_time": i * 37 % 366, "arrival_year": F.lit(2024), "arrival_month": i % 12 + 1,
           "arrival_date": i % 28 + 1, "repeated_guest": i % 5 % 2, "no_of_previous_cancellations": i % 3,
           "no_of_previous_bookings_not_canceled": i % 6, "no_of_special_requests": i % 4}
    return spark.range(first, last).select(
        F.concat(F.lit("INN"), i.cast("string")).alias("Booking_ID"), *[c.cast("int").alias(n) for n, c in num.items()],
        F.concat(F.lit("Meal_Plan_"), (i % 3 + 1).cast("string")).alias("type_of_meal_plan"),
        F.concat(F.lit("Room_Type "), (i % 4 + 1).cast("string")).alias("room_type_reserved"),
        F.element_at(F.array(F.lit("Online"), F.lit("Corporate"), F.lit("Offline")), (i % 3 + 1).cast("int")).alias("market_segment_type"),
        (F.lit(50.0) + i * 13 % 250).alias("avg_price_per_room"),
        F.when(i * 37 % 366 > 180, "Canceled").otherwise("Not_Canceled").alias("booking_status"))


def test_weekly_run(spark):
    layout = jobs.Layout(scratch_path(spark, "jobs"))
    raw = layout.path("raw")
    append(bookings(spark, 0, 400), raw)
    assert jobs.preprocess(spark, SPEC, layout) is True
    assert jobs.preprocess(spark, SPEC, layout) is False          # nothing new
    append(bookings(spark, 400, 500), raw)
    assert jobs.preprocess(spark, SPEC, layout) is True           # only the 100 new rows
    assert spark.read.parquet(layout.path("split")).count() == 500

    assert "created" in jobs.featurise(spark, SPEC, layout)
    assert "upserted" in jobs.featurise(spark, SPEC, layout)
    name = jobs.publish_table(spark, SPEC, layout, "input_features", database="default")
    assert name == "default.bookings_input_features" and spark.table(name).count() == 500
    assert get_bool_property(spark, name, jobs.CHANGE_FEED)

    first = jobs.train(spark, SPEC, layout, "bookings_model")
    d1 = jobs.evaluate(spark, layout, "bookings_model").first()
    assert d1.promote and d1.new_run == first                      # first model always registered
    jobs.train(spark, SPEC, layout, "bookings_model", params=dataclasses.replace(SPEC.params, max_depth=2))
    d2 = jobs.evaluate(spark, layout, "bookings_model").first()
    assert d2.current_run == first and d2.promote == (d2.new_mae < d2.current_mae)

    # a refresh scores new rows without a new model
    at = dt.datetime(2025, 1, 6)
    prof = jobs.predict_and_monitor(spark, SPEC, layout, "bookings_model", at).collect()
    preds = read_newest(spark, layout.path("preds"), "Booking_ID")
    assert preds.count() == 500 and preds.select("Booking_ID").distinct().count() == 500
    assert set(preds.columns) >= {"prediction", "Booking_ID", "avg_price_per_room", "no_of_week_nights"}
    again = jobs.predict_and_monitor(spark, SPEC, layout, "bookings_model", at)        # a repeated refresh
    assert again.count() == len(prof) == 1 and again.first().window == at and again.first().n == 500
    append(bookings(spark, 500, 560), raw)
    assert jobs.preprocess(spark, SPEC, layout) is True
    jobs.featurise(spark, SPEC, layout)
    later = jobs.predict_and_monitor(spark, SPEC, layout, "bookings_model", dt.datetime(2025, 1, 13))
    assert sorted((r.window.day, r.n) for r in later.collect()) == [(6, 500), (13, 560)]
    assert jobs.alert(spark, layout).first().prediction_drift == 0

    # shifted data: its own tables, the shared model and profile
    shifted = jobs.Layout(layout.root, drift=True)
    drifted = generate.shift_columns(bookings(spark, 0, 300), {"avg_price_per_room": 1.5, "no_of_week_nights": 2})
    append(drifted.withColumn("lead_time", F.lit(300)), shifted.path("raw"))
    assert jobs.preprocess(spark, SPEC, shifted) is True
    jobs.featurise(spark, SPEC, shifted)
    shown = jobs.predict_and_monitor(spark, SPEC, shifted, "bookings_model", dt.datetime(2025, 1, 20))
    assert shown.count() == 3 and shifted.path("preds").endswith("preds_skewed")
    assert jobs.alert(spark, layout).first().latest_window == dt.datetime(2025, 1, 20)

    report = {(r.column_name, r.rule): r.violations
              for r in check_constraints(spark.read.parquet(raw), SPEC.num_features[:-1], SPEC.cat_features).collect()}
    assert report[("type_of_meal_plan", "allowed_values")] == 560
    assert report[("arrival_year", "allowed_values")] == 560
    assert report[("lead_time", "min")] == 0


def test_function_feature_reaches_the_model(spark):
    assert "years_since_booking" in SPEC.feature_names


@pytest.mark.parametrize("before, after, flag", [(0.2, 1.0, 1), (1.0, 0.2, 0), (0.2, 0.25, 0)])
def test_alert_between_refreshes(spark, before, after, flag):
    """The newest refresh is compared with the one before."""
    from tabflow.operators.monitor import snapshot_profile
    from tabflow.sources.tables import append_batch

    layout = jobs.Layout(scratch_path(spark, "jobs_alert"))
    for k, mean in enumerate((before, after)):
        preds = spark.range(100).select(F.lit(mean).alias("prediction"))
        append_batch(snapshot_profile(preds, f"2025-01-{6 + k:02d} 00:00:00", ["prediction"]), layout.path("profile"), jobs.SNAPSHOT_KEY, k)
    got = jobs.alert(spark, layout).first()
    assert got.prediction_drift == flag and got.latest_window == dt.datetime(2025, 1, 7)
