import pytest

from tabflow.operators import generate
from tests.conftest import rows


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "Booking_ID string")


# FIXTURES F6
@pytest.mark.parametrize("existing,n,prefix,expected", [
    (["INN1205", "INN1207"], 3, "INN", ["INN1208", "INN1209", "INN1210"]),
    (["BOOK1001", "BOOK1002"], 2, "BOOK", ["BOOK1003", "BOOK1004"]),
    (["INN99998", "INN99999"], 3, "INN", ["INN100000", "INN100001", "INN100002"]),
    (["INN01205", "INN01207"], 0, "INN", []),
    (["INN001", "INN099", "INN100"], 3, "INN", ["INN101", "INN102", "INN103"]),
    (["BOOK1", "BOOK12", "BOOK99"], 3, "BOOK", ["BOOK100", "BOOK101", "BOOK102"]),
])
def test_next_ids(spark, existing, n, prefix, expected):
    out = generate.next_ids(ids(spark, existing), "Booking_ID", n, prefix)
    assert [r.new_id for r in out.orderBy("_num").collect()] == expected


def test_next_ids_no_existing(spark):
    with pytest.raises(ValueError):
        generate.next_ids(spark.createDataFrame([], "Booking_ID string"), "Booking_ID", 3, "INN")


def test_next_ids_width_options(spark):
    df = ids(spark, ["INN01205", "INN01207", "XYZ9999999"])
    assert generate.next_ids(df, "Booking_ID", 1, "INN").first().new_id == "INN1208"
    assert generate.next_ids(df, "Booking_ID", 1, "INN", keep_width=True).first().new_id == "INN01208"
    assert generate.next_ids(df, "Booking_ID", 1, "INN", width=8).first().new_id == "INN00001208"


def test_prefix_is_literal(spark):
    df = ids(spark, ["A.B7", "AxB9"])
    assert generate.next_ids(df, "Booking_ID", 1, "A.B").first().new_id == "A.B8"


def test_shift_columns_keeps_types(spark):
    df = spark.createDataFrame([(100.0, 3, "a"), (None, None, "b")], "price double, nights int, s string")
    out = generate.shift_columns(df, {"price": 1.5, "nights": 2})
    assert out.dtypes == df.dtypes
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(150.0, 6, "a"), (None, None, "b")], key=str)


def test_shift_columns_missing(spark):
    with pytest.raises(ValueError):
        generate.shift_columns(ids(spark, ["a"]), {"nope": 2.0})
