import pytest
from pyspark.sql import functions as F

from tabflow.operators import keyed
from tabflow.plans.flows import write_keyed
from tabflow.session import scratch_path
from tabflow.sources.tables import append_batch, batch_ids, read_newest
from tests.conftest import rows


@pytest.fixture()
def old(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0)], "id long, s string, x double")


@pytest.fixture()
def new(spark):
    return spark.createDataFrame([(2, "B", 2.0), (4, "d", 4.0)], "id long, s string, x double")


def test_upsert(old, new):
    assert rows(keyed.upsert(old, new, "id")) == [(1, "a", 1.0), (2, "B", 2.0), (3, "c", 3.0), (4, "d", 4.0)]


def test_upsert_idempotent(old, new):
    once = keyed.upsert(old, new, "id")
    assert rows(keyed.upsert(once, new, "id")) == rows(once)


def test_upsert_missing_key(old, spark):
    # FIXTURES F5 error text
    bad = spark.createDataFrame([("x",)], "feature string")
    with pytest.raises(ValueError, match="Primary key column 'id' not found in feature_data"):
        keyed.upsert(old, bad, "id")


def test_upsert_order_by_resolves_duplicates(old, spark):
    dup = spark.createDataFrame([(2, "old", 0.0, 1), (2, "new", 9.0, 2)], "id long, s string, x double, v int")
    out = keyed.upsert(old.withColumn("v", F.lit(0)), dup, "id", order_by=["v"])
    assert ("new", 9.0) in [(r.s, r.x) for r in out.where("id = 2").collect()]
    assert out.where("id = 2").count() == 1


def test_row_changes(old, spark):
    new = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (4, "d", None)], "id long, s string, x double")
    got = rows(keyed.row_changes(old, new, "id"))
    assert got == [(2, "update", "b", 2.0), (3, "delete", "c", 3.0), (4, "insert", "d", None)]


def test_row_changes_null_safe(spark):
    a = spark.createDataFrame([(1, None)], "id long, x double")
    assert keyed.row_changes(a, a, "id").count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_apply_changes_roundtrip(spark, parts):
    old = spark.range(0, 300).select("id", (F.col("id") % 7).alias("v")).repartition(parts)
    new = (spark.range(100, 400).select("id", F.when(F.col("id") % 3 == 0, F.lit(None))
                                        .otherwise(F.col("id") % 7).alias("v")).repartition(parts))
    synced = keyed.apply_changes(old, keyed.row_changes(old, new, "id"), "id")
    assert rows(synced) == rows(new)


def test_training_set_unmatched_is_null(spark):
    df = spark.createDataFrame([(1, 10.0, "y1"), (5, 11.0, "y5")], "id long, price double, label string")
    feats = spark.createDataFrame([(1, 99.0)], "id long, price double")
    out = keyed.training_set(df, feats, "id", ["price"], label="label",
                             functions={"double_id": (lambda c: c * 2, ["id"])})
    assert rows(out, "id", "label", "price", "double_id") == [(1, "y1", 99.0, 2), (5, "y5", None, 10)]


def test_lookup_batch(spark):
    keys = spark.createDataFrame([(1,), (7,)], "k long")
    tbl = spark.createDataFrame([(1, 0.5)], "id long, prediction double")
    assert rows(keyed.lookup_batch(keys, tbl, ("k", "id"), ["prediction"])) == [(1, True, 0.5), (7, False, None)]


def test_latest_per_key_hot_key(spark):
    # one key holds most rows; result is one deterministic row per key
    df = spark.range(0, 5000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("k"),
                                     (F.col("id") % 10).alias("t"), F.col("id").alias("payload"))
    out = keyed.latest_per_key(df.repartition(6), "k", ["t"])
    assert out.count() == 1001
    assert out.where("k = 0").first()["payload"] == 3999


def test_write_keyed_batches(spark):
    t = scratch_path(spark, "keyed")
    a = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    assert "created" in write_keyed(t, a, "id")
    b = spark.createDataFrame([(2, "B"), (3, "c")], "id long, v string")
    assert "upserted" in write_keyed(t, b, "id")
    assert batch_ids(spark, t) == [0, 1]
    assert rows(read_newest(spark, t, "id")) == [(1, "a"), (2, "B"), (3, "c")]
    assert rows(read_newest(spark, t, "id", upto=0)) == [(1, "a"), (2, "b")]
    write_keyed(t, b, "id", batch_id=1)  # a retry replaces its batch
    assert rows(read_newest(spark, t, "id")) == [(1, "a"), (2, "B"), (3, "c")]
    for bad in ([(5, "x"), (5, "y")], [(None, "x")]):
        with pytest.raises(Exception, match="NULL or duplicate key in feature_data: (5|NULL)"):
            write_keyed(t, spark.createDataFrame(bad, "id long, v string"), "id")
    assert batch_ids(spark, t) == [0, 1]  # the failed writes committed nothing
    assert write_keyed(t, spark.createDataFrame([(5, "x"), (5, "y")], "id long, v string"), "id", order_by=["v"])
    assert rows(read_newest(spark, t, "id").where("id = 5")) == [(5, "y")]


def test_keyed_table_with_two_keys_and_nothing(spark):
    t = scratch_path(spark, "keyed2")
    with pytest.raises(ValueError):
        read_newest(spark, t, ["a", "b"])
    append_batch(spark.createDataFrame([(1, "x", 1), (1, "y", 1)], "a int, b string, v int"), t, ["a", "b"])
    append_batch(spark.createDataFrame([(1, "y", 2)], "a int, b string, v int"), t, ["a", "b"])
    append_batch(spark.createDataFrame([], "a int, b string, v int"), t, ["a", "b"])
    assert rows(read_newest(spark, t, ["a", "b"]), "a", "b", "v") == [(1, "x", 1), (1, "y", 2)]


def test_duplicate_lookup_key_fails_not_multiplies(spark):
    df = spark.createDataFrame([(1, "y")], "id long, label string")
    feats = spark.createDataFrame([(1, 1.0), (1, 2.0)], "id long, price double")
    with pytest.raises(Exception, match="Duplicate key in feature table: 1"):
        keyed.training_set(df, feats, "id", ["price"]).collect()


def test_row_changes_duplicate_key_fails(spark):
    a = spark.createDataFrame([(1, "a"), (1, "b")], "id long, s string")
    b = spark.createDataFrame([(1, "a")], "id long, s string")
    with pytest.raises(Exception, match="Duplicate key in snapshot: 1"):
        keyed.row_changes(a, b, "id").collect()


def test_upsert_duplicate_batch_key_fails(old, spark):
    dup = spark.createDataFrame([(2, "x", 1.0), (2, "y", 2.0)], "id long, s string, x double")
    with pytest.raises(Exception, match="NULL or duplicate key in upsert batch: 2"):
        keyed.upsert(old, dup, "id").collect()


def test_batch_changes(spark):
    from tabflow.plans.flows import batch_changes

    t = scratch_path(spark, "keyed_changes")
    write_keyed(t, spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"), "id")
    write_keyed(t, spark.createDataFrame([(2, "B"), (3, "c")], "id long, v string"), "id")
    assert rows(batch_changes(spark, t, "id", 0)) == [(2, "update", "B"), (3, "insert", "c")]
    assert batch_changes(spark, t, "id", 1).count() == 0


def test_row_changes_tells_nulls_apart(spark):
    a = spark.createDataFrame([(1, None, "a"), (2, "b", None), (3, None, None), (None, "n", "n")], "id long, s string, t string")
    b = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, None, None), (None, "n", "m")], "id long, s string, t string")
    got = {(r.id, r.change_type, r.s, r.t) for r in keyed.row_changes(a, b, "id").collect()}
    assert got == {(1, "update", "a", None), (None, "update", "n", "m")}


def test_lookup_follows_the_request(spark):
    keys = spark.createDataFrame([(1,), (1,), (3,)], "k long")
    table = spark.createDataFrame([(1, 0.5), (2, 0.1), (2, 0.2), (3, None)], "id long, p double")
    # key 2 is repeated but not asked for
    assert rows(keyed.lookup_batch(keys, table, ("k", "id"), ["p"])) == [(1, True, 0.5), (1, True, 0.5), (3, True, None)]
    with pytest.raises(Exception, match="Duplicate key in served table: 2"):
        keyed.lookup_batch(spark.createDataFrame([(2,)], "k long"), table, ("k", "id"), ["p"]).collect()
