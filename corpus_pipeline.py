"""The corpus pipeline: toxicity, near duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabflow.llm import decontaminate, jaccard, mixing, sharding, toxicity
from tabflow.llm.scratch import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents scored 0.7 or more go; the model learns from the
    labels of documents that are not held out."""
    weights = toxicity.fit_on_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.remove_toxic(docs, weights)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: one document of each group of near duplicates stays."""
    return jaccard.keep_one_each(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: benchmark passages are cut out; mostly contaminated documents go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents the mix takes, once for each time it takes them."""
    return mixing.take(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: shard and place of every row, beside the columns of documents."""
    return sharding.place(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", cut_benchmark),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: A fitted model and word hashes are not expressible in SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage has read is deleted when the next has written."""
    tmp = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = tmp.save(stage(spark, docs, sf_dir), str(k))
        if k:
            tmp.drop(str(k - 1))
    return docs
