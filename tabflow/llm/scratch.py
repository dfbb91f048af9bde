"""Tables written between the steps of an operator.

They live in the shared folder of ``spark.checkpoint.dir`` (see
``tabflow.session.checkpoint_root``), so a lost executor costs a re-read, not
a recomputation, and both sides of a later join are fresh scans that AQE can
split.  A folder is deleted as soon as its operator drops it, or else when
the driver's JVM ends (the returned DataFrame still reads it until then).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabflow.session import scratch_path


class Scratch:
    """A fresh shared folder holding one operator call's tables."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, "llm", name)
        path, fs = self._hadoop(self.root)
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def _hadoop(self, path: str):
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(sc._jsc.hadoopConfiguration())

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Writes ``df`` and returns a scan of what was written (empty tables too)."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Deletes tables that no DataFrame reads any more."""
        for name in names:
            path, fs = self._hadoop(f"{self.root}/{name}")
            fs.delete(path, True)
