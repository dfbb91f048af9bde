import datetime as dt

import pytest

from tabflow.operators import monitor


def profile(spark, avgs):
    return spark.createDataFrame([(dt.date(2024, 1, i + 1), "prediction", float(a)) for i, a in enumerate(avgs)],
                                 "window_start date, column_name string, avg double")


def test_drift_series_cases(spark):
    # FIXTURES F9: avg 10, 16, 4, 0, 7
    s = monitor.drift_series(profile(spark, [10, 16, 4, 0, 7]))
    got = [r.pct for r in s.orderBy("window_start").collect()]
    assert got == [None, 60.0, -75.0, -100.0, None]
    assert monitor.drift_alert(s).first().prediction_drift == 0
    two = monitor.drift_series(profile(spark, [10, 16]))
    assert monitor.drift_alert(two).first().prediction_drift == 1


def test_threshold_strict_after_rounding(spark):
    s = monitor.drift_series(profile(spark, [100.0, 150.04]))
    assert monitor.drift_alert(s).first().prediction_drift == 0
    s = monitor.drift_series(profile(spark, [100.0, 150.06]))
    assert monitor.drift_alert(s).first().prediction_drift == 1


def test_two_sided_and_threshold(spark):
    fall = profile(spark, [100.0, 10.0])
    assert monitor.drift_alert(monitor.drift_series(fall)).first().prediction_drift == 0
    assert monitor.drift_alert(monitor.drift_series(fall, two_sided=True)).first().prediction_drift == 1
    assert monitor.drift_alert(monitor.drift_series(profile(spark, [100.0, 120.0]), threshold=10.0)) \
        .first().prediction_drift == 1


def test_profile_metrics_with_nulls(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0, None), (dt.date(2024, 1, 1), 3.0, 2.0),
                                (dt.date(2024, 1, 2), 5.0, 4.0)], "d date, a double, b double")
    out = monitor.profile_metrics(df, "d", ["a", "b"])
    got = {(r.window_start, r.column_name): (r.n, r.nulls, r.avg, r.min, r.max) for r in out.collect()}
    assert got[(dt.date(2024, 1, 1), "a")] == (2, 0, 2.0, 1.0, 3.0)
    assert got[(dt.date(2024, 1, 1), "b")] == (2, 1, 2.0, 2.0, 2.0)
    assert got[(dt.date(2024, 1, 2), "b")] == (1, 0, 4.0, 4.0, 4.0)
    with pytest.raises(ValueError):
        monitor.profile_metrics(df, "d", ["nope"])
