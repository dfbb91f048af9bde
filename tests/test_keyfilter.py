"""Key filters: newest rows and ingest diffs without shuffling the large side."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tabflow.operators import keyfilter, split
from tabflow.sources.tables import append_batch, read_newest


def shuffled(df) -> int:
    """Rows written to shuffles while ``df`` runs."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    total = 0

    def walk(node):
        nonlocal total
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))

    walk(plan)
    return total


@pytest.mark.parametrize("most", [None, 1])  # 1: no filter fits, the plain way
def test_read_newest_equals_plain(spark, tmp_path, monkeypatch, most):
    if most:
        monkeypatch.setattr(keyfilter, "MAX_BLOCKS", most)
    r, state, root = random.Random(5), {}, str(tmp_path / "t")
    for b in range(5):
        batch = {(r.randrange(300), r.choice("xyz")): f"v{b}" for _ in range(r.choice([0, 5, 200]) if b else 400)}
        append_batch(spark.createDataFrame([(*k, v) for k, v in batch.items()], "a int, b string, v string"), root, ["a", "b"], b)
        state |= batch
        assert rows(read_newest(spark, root, ["a", "b"]), "a", "b", "v") == sorted((*k, v) for k, v in state.items())


def test_small_batch_does_not_shuffle_the_table(spark, tmp_path):
    root = str(tmp_path / "t")
    append_batch(spark.range(200_000).select("id", F.lit("old").alias("v"), F.lit(1).alias("_w9")), root, "id", 0)
    append_batch(spark.range(150_000, 150_500).select("id", F.lit("new").alias("v"), F.lit(2).alias("_w9")), root, "id", 1)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only the filter, whose size is bounded, is broadcast
    try:
        df = read_newest(spark, root, "id")
        assert shuffled(df) < 10_000
        assert df.groupBy("v").count().orderBy("v").collect() == [("new", 500), ("old", 199_500)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_seen_shuffle_follows_the_ingest(spark):
    seen = spark.range(300_000).select("id", F.lit("x").alias("_block"))
    ingest = spark.range(299_900, 300_050).union(spark.range(299_990, 300_010)).withColumn("v", F.col("id") * 2)
    got = split.new_rows_of_batch(ingest, seen, "id")
    assert rows(got) == rows(split.new_rows(ingest, seen, "id")) and got.count() == 60
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffled(split.new_rows_of_batch(ingest, seen, "id")) < 10_000 < shuffled(split.new_rows(ingest, seen, "id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_new_rows_of_batch_edges(spark, monkeypatch):
    seen = spark.createDataFrame([(1,), (1,), (None,), (5,)], "k long")
    ingest = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "n"), (5, "e")], "k long, v string")
    assert rows(split.new_rows_of_batch(ingest, seen, "k")) == [(2, "b"), (2, "b")]
    assert rows(split.new_rows_of_batch(ingest, seen.withColumn("k", F.col("k").cast("int")), "k")) == [(2, "b"), (2, "b")]
    assert rows(split.new_rows_of_batch(ingest, seen.limit(0), "k")) == [(1, "a"), (2, "b"), (2, "b"), (5, "e")]
    assert rows(split.new_rows_of_batch(ingest.limit(0), seen, "k")) == []
    assert rows(split.new_rows_of_batch(ingest.withColumnRenamed("k", "id"), seen, "id", "k"), "v") == [("b",), ("b",)]
    monkeypatch.setattr(keyfilter, "MAX_BLOCKS", 1)
    assert rows(split.new_rows_of_batch(ingest, seen, "k")) == [(2, "b"), (2, "b")]


def test_filter_has_no_false_negatives_and_few_candidates(spark):
    n = 20_000
    blocks = keyfilter.blocks_for(n)
    keys = spark.range(n).select((F.col("id") * 7).alias("k"))
    built = keyfilter.build_filter(keys, ["k"], blocks)
    assert built.count() <= blocks
    marked = keyfilter.mark_candidates(spark.range(7 * n).withColumnRenamed("id", "k"), ["k"], blocks, built)
    hit = {r["in"]: r.share for r in marked.groupBy((F.col("k") % 7 == 0).alias("in")).agg(F.avg(F.col("_candidate").cast("int")).alias("share")).collect()}
    assert hit[True] == 1.0 and hit[False] < 0.03
    assert keyfilter.blocks_for(10**9) is None
