"""Reading, appending and keyed (batch by batch) writing of tables.

A table is addressed either by catalog name (``catalog.schema.table``) or
by a storage path (anything containing ``/`` or ``:``).  Parquet is the
storage format (no transactional table format is assumed).

Keyed tables are appended batch by batch and read as each key's newest row
(:func:`append_batch`, :func:`read_newest`): a reader sees only committed
batches, and a failed or retried writer rewrites only its own.
"""

from __future__ import annotations

import re
from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def is_path(name: str) -> bool:
    return "/" in name or ":" in name


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def publish(spark: SparkSession, staged: str, final: str) -> bool:
    """Move a fully written folder into place (one directory rename).

    Returns False, leaving ``final`` untouched, when ``final`` already exists
    (another writer published first)."""
    fs, src = _fs(spark, staged)
    dst = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(final)
    if fs.exists(dst):
        return False
    parent = dst.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    return bool(fs.rename(src, dst))


def has_data(spark: SparkSession, path: str) -> bool:
    """Committed output exists at ``path`` (a ``_SUCCESS`` marker, or data files)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    jvm = spark.sparkContext._jvm
    if fs.exists(jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")):
        return True
    return any(not _hidden(s.getPath().getName()) for s in fs.listStatus(p))


def _hidden(name: str) -> bool:
    """Spark's rule: ``.x`` and ``_x`` are hidden, except ``_col=value`` partition folders."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def has_data_files(spark: SparkSession, path: str) -> bool:
    """A data file (not a ``_``/``.`` marker) exists at or below ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    root = fs.makeQualified(p).toString().rstrip("/")
    it = fs.listFiles(p, True)
    while it.hasNext():
        st = it.next()
        parts = st.getPath().toString()[len(root):].split("/")
        if not any(_hidden(x) for x in parts if x):
            return True
    return False


def child_ids(spark: SparkSession, path: str, column: str) -> list[int]:
    """Values N of ``column=N`` sub-directories of ``path`` (a top-level listing)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    pat = re.compile(rf"^{re.escape(column)}=(\d+)$")
    return sorted(int(m.group(1)) for st in fs.listStatus(p)
                  if st.isDirectory() and (m := pat.match(st.getPath().getName())))


def table_exists(spark: SparkSession, name: str) -> bool:
    """Catalog table (three-part names work) or committed path."""
    return has_data(spark, name) if is_path(name) else spark.catalog.tableExists(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.parquet(name) if is_path(name) else spark.read.table(name)


def append(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows (parquet); creates the table when absent."""
    w = df.write.mode("append").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if is_path(name):
        w.save(name)
    else:
        w.saveAsTable(name)


def overwrite(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Create or replace.  Never point this at a table the plan reads from."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if is_path(name):
        w.save(name)
    else:
        w.saveAsTable(name)


BATCH_COL = "batch_id"


def batch_ids(spark: SparkSession, root: str) -> list[int]:
    """Committed batches of a keyed table, ascending (a batch is there once its ``_SUCCESS`` is)."""
    fs, _ = _fs(spark, root)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return [n for n in child_ids(spark, root, BATCH_COL)
            if fs.exists(path(f"{root.rstrip('/')}/{BATCH_COL}={n}/_SUCCESS"))]


def append_batch(df: DataFrame, root: str, pk: str | Sequence[str], batch_id: Optional[int] = None) -> int:
    """Write ``df`` as one batch of a keyed table; returns its id.

    A keyed table is a folder of batches; a key's newest batch holds its row.
    Writing touches only the batch, so its cost follows the new rows, and
    writing a batch again (a retried job, a replayed micro-batch) replaces
    it.  A NULL or repeated key fails the write; such a batch is never read.
    """
    from tabflow.operators.quality import assert_unique

    spark = df.sparkSession
    if batch_id is None:
        done = batch_ids(spark, root)
        batch_id = done[-1] + 1 if done else 0
    assert_unique(df, pk, "feature_data").write.mode("overwrite").parquet(f"{root.rstrip('/')}/{BATCH_COL}={batch_id}")
    return batch_id


def read_batches(spark: SparkSession, root: str, since: Optional[int] = None, upto: Optional[int] = None) -> DataFrame:
    """All rows of the committed batches after ``since`` up to ``upto``, with their ``batch_id``."""
    base = root.rstrip("/")
    ids = [n for n in batch_ids(spark, root) if (since is None or n > since) and (upto is None or n <= upto)]
    if not ids:
        raise ValueError(f"No batch under {root}")
    return spark.read.option("basePath", base).parquet(*[f"{base}/{BATCH_COL}={n}" for n in ids])


def read_newest(spark: SparkSession, root: str, pk: str | Sequence[str], upto: Optional[int] = None,
                since: Optional[int] = None) -> DataFrame:
    """A keyed table's state: for each key its row of the newest batch (up to
    ``upto``; with ``since``, the keys of later batches only).

    With one batch this is a plain scan.  With more, the keys of the later
    batches become Bloom filters, and every row is tested where it is against
    the batches after its own: rows that miss are their keys' newest; only the
    others are joined, on the key, with the later batches' keys.  So a small
    batch on a large one shuffles what it replaces, not the table.  Beyond
    what filters hold (some million keys times batches) the newest batch of
    every key is aggregated and joined.  A table of many batches is compacted
    by writing this state as the first batch of another folder.
    """
    keys = [pk] if isinstance(pk, str) else list(pk)
    rows = read_batches(spark, root, since, upto)
    ids = [n for n in batch_ids(spark, root) if (since is None or n > since) and (upto is None or n <= upto)]
    if len(ids) > 1:
        rows = _newest_rows(rows, keys, ids)
    return rows.drop(BATCH_COL)


def _newest_rows(rows: DataFrame, keys: list[str], ids: list[int]) -> DataFrame:
    """Rows of several batches that are their key's newest."""
    from tabflow.operators.keyfilter import WORDS, blocks_for, build_filter, mark_candidates

    later = rows.where(F.col(BATCH_COL) > ids[0]).select(BATCH_COL, *keys)
    blocks = blocks_for(later.count(), len(ids) - 1)  # row counts of the files' footers
    if blocks is None:
        newest = rows.groupBy(*keys).agg(F.max(BATCH_COL).alias(BATCH_COL))
        return rows.join(newest, [*keys, BATCH_COL], "left_semi")
    # the filter of a batch holds the keys of all batches after it
    own = build_filter(later, keys, blocks, [BATCH_COL])
    before = F.filter(F.array(*[F.lit(i) for i in ids[:-1]]), lambda i: i < F.col(BATCH_COL))
    after = (own.withColumn(BATCH_COL, F.explode(before)).groupBy(BATCH_COL, "_block")
                .agg(*[F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(WORDS)]))
    marked = mark_candidates(rows, keys, blocks, after, [BATCH_COL])
    last = later.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max(BATCH_COL).alias("_last"))
    maybe = marked.where("_candidate")
    replaced = F.col("_last") > F.col(BATCH_COL)
    for i, k in enumerate(keys):
        replaced = replaced & (F.col(k) == F.col(f"_k{i}"))
    return marked.where("not _candidate").drop("_candidate").unionByName(maybe.join(last, replaced, "left_anti").drop("_candidate"))


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read
    it back: cuts the lineage (a lost executor re-reads files instead of
    recomputing joins) and lets iterative consumers scan columns only."""
    return df.sparkSession.read.parquet(_write_scratch(df, name))


def materialize_for_fit(df: DataFrame, name: str, rows_per_task: int) -> tuple[DataFrame, DataFrame]:
    """``materialize`` with a second scan of the same files for consumers that
    cache what a task reads, as tree training does: ``(scan, scan a file a task)``.

    Parquet holds a row in far fewer bytes than a cache, so tasks cut by file
    bytes hold rows without bound; a task of the second scan reads one file,
    ``rows_per_task`` rows at most.  How files are packed into tasks is a
    setting of the session, so that scan has a session of its own with the
    caller's other settings: fit on it or write from it, don't return it.
    """
    spark = df.sparkSession
    path = _write_scratch(df, name, rows_per_task)
    scan = spark.read.parquet(path)
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    # a file counts as a full task, so none shares a task with another
    own.conf.set("spark.sql.files.openCostInBytes", own.conf.get("spark.sql.files.maxPartitionBytes"))
    own.conf.unset("spark.sql.files.maxPartitionNum")
    return scan, own.read.schema(scan.schema).parquet(path)


def _write_scratch(df: DataFrame, name: str, rows_per_file: Optional[int] = None) -> str:
    from tabflow.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file or 0).parquet(path)
    return path


def set_property(spark: SparkSession, table: str, key: str, value: str) -> str:
    """``ALTER TABLE ... SET TBLPROPERTIES`` on a catalog table."""
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{key}' = '{value}')")
    return f"Property {key} set to {value} on {table}."


def get_bool_property(spark: SparkSession, table: str, key: str) -> bool:
    """Property read as boolean: lower-cased value equals ``'true'``; missing -> False."""
    rows = (spark.sql(f"SHOW TBLPROPERTIES {table}")
            .where(F.col("key") == key).select(F.lower(F.col("value")).alias("v")).collect())
    return bool(rows) and rows[0]["v"] == "true"
