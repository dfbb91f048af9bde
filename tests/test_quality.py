import pytest

from tabflow.config import CatFeature, NumFeature
from tabflow.operators import quality
from tests.conftest import rows


def test_require_columns(spark):
    df = spark.createDataFrame([(1,)], "booking_id long")
    quality.require_columns(df, ["Booking_ID"])  # case-insensitive, like Spark
    with pytest.raises(ValueError, match="'label'"):
        quality.require_columns(df, ["label"], "label")


def test_key_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3)], "a long, b long")
    assert rows(quality.key_violations(df, ["a", "b"])) == [(1, 1, 2), (None, 3, 1)]


def test_check_constraints(spark):
    df = spark.createDataFrame([(-1, "x"), (5, "a"), (None, None), (20, "b")], "n long, c string")
    out = quality.check_constraints(df, [NumFeature("n", min=0, max=10)], [CatFeature("c", allowed_values=("a", "b"))])
    assert rows(out) == [("c", "allowed_values", 1, 3), ("n", "max", 1, 3), ("n", "min", 1, 3)]


def test_encode_values(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "p boolean")
    f = CatFeature("p", dtype="bool", allowed_values=(True, False), encoding=(1, 0))
    out = quality.encode_values(df, [f])
    assert rows(out) == [(False, 0), (True, 1), (None, None)]


def test_encoding_length_checked():
    with pytest.raises(ValueError):
        CatFeature("p", allowed_values=(1, 2), encoding=(1,))
