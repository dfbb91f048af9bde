"""Session construction and the shared scratch folder.

All state that must survive a lost executor (stream checkpoints, staged
table versions, cut lineage) lives under ``spark.checkpoint.dir`` – on a
cluster this names a shared folder.  It is read from the session; a folder
of our own is set only when the setting is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, app_name: str = "tabflow",
                  shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Session with AQE (coalesce + skew join), UTC time zone and no UI.

    ``master`` is only set when given: on a cluster it comes from the
    launcher.  ``shuffle_partitions`` should be sized so one partition fits
    an executor core's memory (e.g. input bytes / 200 MB); AQE then
    coalesces small ones at runtime.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = (b.master(master).config("spark.driver.bindAddress", "127.0.0.1")
               .config("spark.driver.host", "127.0.0.1"))
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  When the setting is absent the context's
    checkpoint folder is used if one was set.  Else, with a local master
    only, a folder of our own is registered with ``setCheckpointDir`` – the
    setting itself cannot change at run time – so later calls agree; on a
    cluster executors would not share it, so the call fails.
    """
    sc = spark.sparkContext
    root = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError(f"Set {_CHECKPOINT_KEY} to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tabflow-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path below the shared checkpoint folder.  A unique one is fresh and
    is deleted when the driver's JVM ends (DataFrames read it until then)."""
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    path = os.path.join(checkpoint_root(spark), "tabflow", *leaf)
    if unique:
        sc = spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(p)  # only an existing path can be marked
        fs.deleteOnExit(p)
    return path
