"""Plan-shape tests for the scale properties the operators claim."""

import contextlib

import pytest
from pyspark.sql import functions as F

from tabflow.operators import keyed, split
from tabflow.operators.monitor import profile_metrics
from tabflow.operators.quality import key_violations


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def final_plan(df) -> str:
    """Execute and return the final adaptive plan."""
    qe = df._jdf.queryExecution()
    qe.executedPlan().execute().count()
    return qe.executedPlan().toString()


def initial_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(scope="module")
def hot(spark):
    # one key holds a third of the rows
    return spark.range(0, 600_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), (F.col("id") * 2).alias("p"))


def test_lookup_join_splits_hot_probe_key(spark, hot):
    feats = spark.range(0, 600_000).select(F.col("id").alias("k"), (F.col("id") * 0.5).alias("f"))
    with conf(spark, **SKEW):
        plan = final_plan(keyed.training_set(hot, feats, "k", ["f"]))
    assert "SortMergeJoin(skew=true)" in plan


def test_lookups_do_not_aggregate_or_shuffle_the_table(spark):
    table = spark.range(0, 100_000).select("id", F.col("id").cast("string").alias("v"))
    keys = spark.range(5, 15)
    plan = final_plan(keyed.lookup_batch(keys, table, "id", ["v"]))
    assert "LeftSemi" in plan and "SortAggregate" not in plan
    assert "BroadcastHashJoin [id" in plan and plan.index("Window") < plan.index("LeftSemi")  # only what was asked for is counted
    plan = initial_plan(keyed.training_set(keys, table, "id", ["v"], unique=True))
    assert "Aggregate" not in plan


def test_change_feed_needs_no_sort_aggregate(spark):
    a, b = (spark.range(k, k + 1000).select("id", F.col("id").cast("string").alias("v")) for k in (0, 10))
    plan = initial_plan(keyed.row_changes(a, b, "id"))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_anti_join_diff_splits_hot_probe_key(spark, hot):
    seen = spark.range(0, 300_000, 2).select(F.col("id").alias("k"))
    with conf(spark, **SKEW):
        plan = final_plan(split.new_rows(hot, seen, "k"))
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_key_aggregates_combine_map_side(spark, hot):
    for df in (keyed.latest_per_key(hot, "k", ["p"]), key_violations(hot, "k")):
        plan = initial_plan(df)
        assert "partial_" in plan          # map-side combine before the shuffle
        assert "Window" not in plan         # no per-key sort of all rows


def test_profile_aggregates_before_unpivot(spark):
    df = spark.range(0, 1000).select((F.col("id") % 5).alias("w"), F.col("id").cast("double").alias("a"),
                                     (F.col("id") * 2.0).alias("b"))
    plan = initial_plan(profile_metrics(df, "w", ["a", "b"]))
    assert "Expand" not in plan             # rows are not multiplied by the number of columns
    assert plan.index("Generate") < plan.index("HashAggregate")  # explode sits above the aggregate


def test_sample_keys_filters_before_distinct(spark, hot):
    out = split.sample_keys(hot, "k", 5, seed=1)
    plan = initial_plan(out)
    # the hash-threshold filter is applied below the aggregate that deduplicates keys
    agg = plan.rfind("HashAggregate")
    assert "Filter" in plan[agg:]


def test_no_python_in_registered_query_plans(spark, sf_small):
    import __spark_entry__ as e

    for name in ("new_keys", "upsert", "row_changes", "training_set", "profile_metrics", "error_metrics"):
        plan = initial_plan(e.queries()[name](spark, sf_small))
        assert "Python" not in plan and "ArrowEval" not in plan, name
