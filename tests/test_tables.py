from tabflow.config import TableSpec
from tabflow.session import scratch_path
from tabflow.sources import tables


def test_table_name_rule():
    spec = TableSpec(catalog="my_catalog", db_schema="my_schema", use_case="bookings",
                     primary_key="Booking_ID", target="booking_status")
    assert spec.table_name("test_features") == "my_catalog.my_schema.bookings_test_features"
    assert spec.table_name("train_data", drift=True) == "my_catalog.my_schema.bookings_train_data_skewed"
    assert spec.table_name() == "my_catalog.my_schema.bookings"


def test_properties_roundtrip(spark):
    df = spark.createDataFrame([(1, "a")], "id long, feature string")
    tables.overwrite(df, "tf_props")
    assert tables.table_exists(spark, "tf_props")
    assert tables.table_exists(spark, "spark_catalog.default.tf_props")  # three-part name
    assert not tables.table_exists(spark, "spark_catalog.default.tf_nope")
    assert tables.get_bool_property(spark, "tf_props", "delta.enableChangeDataFeed") is False
    tables.set_property(spark, "tf_props", "delta.enableChangeDataFeed", "TRUE")
    assert tables.get_bool_property(spark, "tf_props", "delta.enableChangeDataFeed") is True
    tables.set_property(spark, "tf_props", "delta.enableChangeDataFeed", "false")
    assert tables.get_bool_property(spark, "tf_props", "delta.enableChangeDataFeed") is False


def test_append_and_path_exists(spark):
    p = scratch_path(spark, "t_append")
    assert not tables.table_exists(spark, p)
    df = spark.createDataFrame([(1,)], "id long")
    tables.append(df, p)
    tables.append(df, p)
    assert tables.table_exists(spark, p)
    assert tables.read_table(spark, p).count() == 2


def test_uncommitted_batch_is_not_read(spark):
    root = scratch_path(spark, "t_batches")
    assert tables.batch_ids(spark, root) == []
    tables.append_batch(spark.range(3), root, "id", 1)
    # a half-written batch (no _SUCCESS marker)
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        spark.range(5).write.mode("overwrite").parquet(f"{root}/batch_id=2")
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert tables.batch_ids(spark, root) == [1]
    assert tables.read_newest(spark, root, "id").count() == 3


def test_publish_moves_once(spark):
    root = scratch_path(spark, "t_publish")
    spark.range(3).write.parquet(f"{root}/staged_a")
    spark.range(5).write.parquet(f"{root}/staged_b")
    assert tables.publish(spark, f"{root}/staged_a", f"{root}/final/model") is True
    assert tables.publish(spark, f"{root}/staged_b", f"{root}/final/model") is False  # first writer wins
    assert spark.read.parquet(f"{root}/final/model").count() == 3
    assert not tables.path_exists(spark, f"{root}/staged_a")
