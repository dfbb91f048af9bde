import pytest
from pyspark.sql import functions as F

from tabflow.operators import split
from tabflow.plans.flows import incremental_split, split_tables
from tabflow.session import scratch_path
from tests.conftest import rows


@pytest.fixture()
def small(spark):
    # FIXTURES F2: 3 rows, booking_status long
    return spark.createDataFrame(
        [(25, 50000, "Meal Plan 1", True, 1, "A"), (30, 60000, "Meal Plan 2", False, 0, "B"),
         (None, 70000, "Meal Plan 2", None, 1, "C")],
        "no_of_adults long, avg_price_per_room long, type_of_meal_plan string, "
        "required_car_parking_space boolean, booking_status long, Booking_ID string")


def test_split_totals(small):
    train, test = split.hash_split(small, "Booking_ID", "booking_status", test_size=0.5)
    assert train.count() + test.count() == 3
    assert not set(rows(train, "Booking_ID")) & set(rows(test, "Booking_ID"))


@pytest.mark.parametrize("bad", [0, 1, 1.5, -0.1])
def test_split_bounds(small, bad):
    with pytest.raises(ValueError, match="test_size must be between 0 and 1"):
        split.hash_split(small, "Booking_ID", "booking_status", test_size=bad)


def test_missing_target_null_dropped_empty_kept(spark):
    # FIXTURES F3: NULL dropped, "" kept
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "Canceled"), ("d", "Not_Canceled")],
                               "Booking_ID string, booking_status string")
    train, test = split.hash_split(df, "Booking_ID", "booking_status", test_size=0.2)
    got = sorted(rows(train, "Booking_ID") + rows(test, "Booking_ID"))
    assert got == [("b",), ("c",), ("d",)]


def test_empty_after_drop_raises(spark):
    df = spark.createDataFrame([("a", None)], "Booking_ID string, booking_status string")
    with pytest.raises(ValueError, match="Cannot split an empty DataFrame"):
        split.hash_split(df, "Booking_ID", "booking_status")


def test_split_independent_of_partitioning(spark):
    df = spark.range(0, 5000).withColumn("y", F.lit(1))
    a = rows(split.assign_split(df.repartition(1), "id", "y"), "id", "split")
    b = rows(split.assign_split(df.repartition(7, "id"), "id", "y"), "id", "split")
    assert a == b
    n_test = sum(1 for _, s in a if s == "test")
    assert 800 < n_test < 1200  # ~20 %


def test_split_stable_under_append(spark):
    old = spark.range(0, 1000).withColumn("y", F.lit(1))
    grown = spark.range(0, 3000).withColumn("y", F.lit(1))
    a = dict(rows(split.assign_split(old, "id", "y"), "id", "split"))
    b = dict(rows(split.assign_split(grown, "id", "y"), "id", "split"))
    assert all(b[k] == v for k, v in a.items())


def test_new_keys_and_rows_keep_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b2"), (3, "c"), (None, "n")], "k long, v string")
    seen = spark.createDataFrame([(1,), (1,), (None,)], "k long")
    assert rows(split.new_keys(df, seen, "k")) == [(2,), (3,)]
    # two rows of key 2 stay two (an inner join back would square them)
    assert rows(split.new_rows(df, seen, "k")) == [(2, "b"), (2, "b2"), (3, "c")]


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k long, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k long")
    assert rows(split.union_by_name(a, b)) == [(1, "x"), (2, "y")]


def test_sample_keys_topk_deterministic(spark):
    df = spark.range(0, 2000).union(spark.range(0, 2000))
    a = rows(split.sample_keys(df.repartition(3), "id", 10, seed=7))
    b = rows(split.sample_keys(df.repartition(5), "id", 10, seed=7))
    assert a == b and len(a) == 10


def test_incremental_split_cases(spark):
    path = scratch_path(spark, "test_incremental")
    first = spark.range(0, 100).withColumn("y", F.lit("x"))
    assert incremental_split(first, path, "id", "y") is True  # first load
    assert incremental_split(first, path, "id", "y") is False  # nothing new
    grown = spark.range(0, 150).withColumn("y", F.lit("x"))
    assert incremental_split(grown, path, "id", "y") is True  # 50 new keys
    train, test = split_tables(spark, path)
    assert train.count() + test.count() == 150
    assert spark.read.parquet(path).select("id").distinct().count() == 150
    # only NULL-target rows are new: skipped, not an error (and not "new" forever)
    nulls = spark.range(150, 160).withColumn("y", F.lit(None).cast("string"))
    assert incremental_split(grown.unionByName(nulls), path, "id", "y") is False
    # the split side of each key equals the one-shot split
    once = dict(rows(split.assign_split(grown, "id", "y"), "id", "split"))
    stored = dict(rows(spark.read.parquet(path), "id", "split"))
    assert once == stored


def test_incremental_split_retry_is_idempotent(spark):
    path = scratch_path(spark, "test_incremental_retry")
    base = spark.range(0, 50).withColumn("y", F.lit("x"))
    grown = spark.range(0, 80).withColumn("y", F.lit("x"))
    assert incremental_split(base, path, "id", "y") is True
    assert incremental_split(grown, path, "id", "y", ingest_id=1) is True
    assert incremental_split(grown, path, "id", "y", ingest_id=1) is True  # replay of the same run
    stored = spark.read.parquet(path)
    assert stored.count() == 80 and stored.select("id").distinct().count() == 80


def test_sample_keys_equals_brute_force_with_hot_key_and_retries(spark):
    from tabflow.functions.hashing import hash_int

    df = spark.range(0, 3000).select(F.when(F.col("id") < 1000, F.lit(5)).otherwise(F.col("id")).alias("k"))
    brute = rows(df.select("k").distinct().withColumn("_h", hash_int("k", 3)).orderBy("_h", "k").limit(15)
                 .select("k"))
    # a tiny oversample forces the threshold-doubling path
    assert rows(split.sample_keys(df, "k", 15, seed=3, oversample=0.05)) == brute
    assert rows(split.sample_keys(df, "k", 15, seed=3)) == brute
    assert split.sample_keys(df, "k", 0).count() == 0


def test_incremental_split_after_empty_ingest(spark):
    path = scratch_path(spark, "test_incremental_empty")
    empty = spark.createDataFrame([], "id long, y string")
    assert incremental_split(empty, path, "id", "y") is False
    some = spark.range(0, 10).withColumn("y", F.lit("x"))
    assert incremental_split(some, path, "id", "y") is True
    assert incremental_split(some, path, "id", "y") is False
    assert spark.read.parquet(path).count() == 10


def test_incremental_split_from_another_session(spark):
    """A second session with other settings extends the table; no key twice."""
    path = scratch_path(spark, "test_incremental_session")
    assert incremental_split(spark.range(0, 300).withColumn("y", F.lit("x")), path, "id", "y") is True
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", "16")
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    grown = other.range(0, 500).withColumn("y", F.lit("x"))
    assert incremental_split(grown, path, "id", "y") is True
    assert incremental_split(grown, path, "id", "y") is False
    stored = spark.read.parquet(path)
    assert stored.count() == 500 and stored.select("id").distinct().count() == 500
    assert dict(rows(stored, "id", "split")) == dict(rows(split.assign_split(grown, "id", "y"), "id", "split"))
