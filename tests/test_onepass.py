from math import isclose

import pytest
from pyspark.sql import functions as F

from tabflow.operators import features, onepass
from tabflow.session import scratch_path
from tests.conftest import rows


def frame(spark, n=500):
    return spark.range(n).select(
        "id", F.when(F.col("id") % 5 > 0, (F.col("id") * 37 % 101).cast("int")).alias("a"), F.lit(4.0).alias("same"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("L"), (F.col("id") * F.col("id") % 11).cast("string"))).alias("c"), (F.col("id") % 3).alias("d"))


def test_one_pass_equals_the_separate_forms(spark):
    df = frame(spark)
    got = onepass.transform(df, onepass.fit(df, ["a", "same"], ["c", "d"]), ["a", "same"], ["c", "d"])
    want = features.scale_unit_std(features.impute_mean(df, ["a", "same"]), ["a_imputed", "same_imputed"])
    left = {r.id: r for r in got.collect()}
    assert len(left) == 500 and got.columns == [*df.columns, "a_imputed", "a_scaled", "same_imputed", "same_scaled", "c_indexed", "d_indexed"]
    for r in want.collect():
        assert isclose(left[r.id].a_imputed, r.a_imputed) and isclose(left[r.id].a_scaled, r.a_imputed_scaled) and left[r.id].same_scaled == 0.0
    for c in "cd":
        index = {str(r.value): r["index"] for r in features.category_index(df.withColumn(c, F.col(c).cast("string")), c).collect()}
        assert {(str(r[c]), r[f"{c}_indexed"]) for r in left.values()} == {(str(r[c]), index.get(str(r[c]), len(index))) for r in left.values()}


def test_unseen_levels_and_empty_columns(spark):
    df = frame(spark, 50)
    fitted = onepass.fit(df.withColumn("none", F.lit(None).cast("int")), ["a", "none"], ["c"])
    out = onepass.transform(df.limit(3).withColumns({"c": F.lit("new"), "none": F.lit(None).cast("int")}), fitted, ["a", "none"], ["c"])
    levels = fitted.levels.count()
    assert {(r.none_imputed, r.none_scaled, r.c_indexed) for r in out.collect()} == {(None, None, levels)}
    empty = onepass.fit(df.limit(0), ["a"], ["c"])
    assert empty.levels.count() == 0 and empty.numbers.count() == 0
    assert {(r.a_imputed, r.a_scaled, r.c_indexed) for r in onepass.transform(df.where("id = 0"), empty, ["a"], ["c"]).collect()} == {(None, None, 0)}
    assert rows(onepass.fit(df, [], ["c"]).numbers) == [] and onepass.fit(df, ["a"], []).levels.count() == 0
    with pytest.raises(ValueError):
        onepass.fit(df, [], [])


def test_one_scan_and_many_levels(spark, capsys):
    path = f"{scratch_path(spark, 't_onepass')}/in"
    spark.range(300_000).select((F.col("id") % 200_000).alias("key"), (F.col("id") % 9).alias("k9"), F.col("id").cast("double").alias("x")).write.parquet(path)
    df = spark.read.parquet(path)
    onepass.one_scan(df, ["x"], ["key", "k9"]).explain("simple")
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    levels = onepass.fit(df, ["x"], ["key", "k9"]).levels
    seen = levels.groupBy("column_name").agg(F.count("*").alias("n"), F.count_distinct("index").alias("d"), F.min("index").alias("lo"), F.max("index").alias("hi"))
    assert rows(seen, "column_name", "n", "d", "lo", "hi") == [("k9", 9, 9, 0, 8), ("key", 200_000, 200_000, 0, 199_999)]
