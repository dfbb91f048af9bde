"""Incremental ingest, triggered keyed upsert and windowed profile as streams.

All three read a parquet directory with the file stream source and write
through ``foreachBatch``; progress lives in ``checkpointLocation`` (under
the shared ``spark.checkpoint.dir``).  Every batch write is idempotent by
``batch_id``, so a batch replayed after a failure rewrites its own output
instead of appending twice:

* split: each batch is the batch :func:`tabflow.plans.flows.incremental_split`
  with ``ingest_id = batch_id``: rows go to ``split_table/ingest_id=N/...``
  (overwritten on replay) and the diff reads only ``ingest_id < N``.
* split by state: seen keys are the state of a streaming deduplication, so a
  micro-batch costs its own rows and the state it touches, not a read of the
  table; rows go to ``split_table/ingest_id=batch_id`` alike.
* upsert / profile: micro-batch N writes batch N+1 of a keyed table
  (:func:`tabflow.sources.tables.append_batch`); readers take each key's
  newest row, so a micro-batch costs what it holds, not the table.

``trigger(availableNow=True)`` processes what has arrived and stops, the
streaming equivalent of a scheduled job run.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabflow.functions.dates import ntz_as_utc
from tabflow.operators import keyed, split
from tabflow.operators.moments import column_moments, merge_moments, moments_profile
from tabflow.operators.monitor import profile_metrics
from tabflow.operators.quality import require_columns
from tabflow.sources.tables import append_batch, materialize, read_batches


def _source(spark: SparkSession, path: str, schema: StructType,
            max_files_per_trigger: Optional[int] = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


def _run(df: DataFrame, fn, checkpoint: str, output_mode: str = "append", name: Optional[str] = None):
    w = (df.writeStream.foreachBatch(fn).outputMode(output_mode)
           .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if name:
        w = w.queryName(name)
    q = w.start()
    q.awaitTermination()
    return q


def split_batch_writer(spark: SparkSession, split_table: str, pk: str, target: Optional[str],
                       test_size: float = 0.2, seed: int = 42):
    """``foreachBatch`` function: the batch's new keys go to ``ingest_id=batch_id``.

    It is the batch :func:`tabflow.plans.flows.incremental_split` run with
    ``ingest_id = batch_id``: it reads only earlier ingests and overwrites its
    own, so a replayed batch rewrites the same rows.
    """
    from tabflow.plans.flows import incremental_split

    split._check_test_size(test_size)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        incremental_split(batch, split_table, pk, target, test_size, seed, ingest_id=batch_id)

    return per_batch


def stream_incremental_split(spark: SparkSession, source: str, schema: StructType, split_table: str,
                             checkpoint: str, pk: str, target: Optional[str], test_size: float = 0.2,
                             seed: int = 42, max_files_per_trigger: Optional[int] = None) -> None:
    """Run once over newly arrived files: new keys are split and appended."""
    writer = split_batch_writer(spark, split_table, pk, target, test_size, seed)
    _run(_source(spark, source, schema, max_files_per_trigger), writer, checkpoint)


def stream_split_by_state(spark: SparkSession, source: str, schema: StructType, split_table: str,
                          checkpoint: str, pk: str, target: Optional[str], test_size: float = 0.2,
                          seed: int = 42, split_col: str = "split", ts_col: Optional[str] = None,
                          keep: Optional[str] = None, max_files_per_trigger: Optional[int] = None) -> None:
    """Run once over newly arrived files: the first row of every key not seen
    before is split and appended; the split table is never read.

    Seen keys live in Spark's state store, sharded by key beside the
    checkpoint, one entry a key (set the session's state store provider to
    RocksDB where they outgrow the heap).  NULL keys and targets are dropped
    before, so a key whose target was missing is still new when it has one.
    Of several rows of a new key in one micro-batch one is kept;
    :func:`stream_incremental_split` keeps all.

    With ``ts_col`` and ``keep`` (``"90 days"``) a key is remembered for that
    much event time and then dropped from state, which bounds it; rows later
    than the watermark are dropped too, and a key sent again after that is new.

    A micro-batch that failed is run again from the state before it and
    rewrites its own ``ingest_id``.
    """
    from tabflow.plans.flows import INGEST_COL

    split._check_test_size(test_size)
    require_columns(spark.createDataFrame([], schema), [pk, *([target] if target else []), *([ts_col] if keep else [])], "split")
    rows = _source(spark, source, schema, max_files_per_trigger)
    if keep and dict(rows.dtypes)[ts_col] == "timestamp_ntz":  # watermarks need instants
        rows = rows.withColumn("_event_time", ntz_as_utc(ts_col))
    elif keep:
        rows = rows.withColumn("_event_time", F.col(ts_col))
    rows = split.assign_split(rows, pk, target, test_size, seed, split_col)
    if keep:
        fresh = rows.withWatermark("_event_time", keep).dropDuplicatesWithinWatermark([pk]).drop("_event_time")
    else:
        fresh = rows.dropDuplicates([pk])

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(split_col).parquet(f"{split_table.rstrip('/')}/{INGEST_COL}={batch_id}")

    _run(fresh, per_batch, checkpoint)


def upsert_batch_writer(pk: str | Sequence[str], table_root: str, order_by: Optional[Sequence[str]] = None):
    """``foreachBatch`` function: micro-batch N becomes batch N+1 of the keyed
    table (batch 0 is the initial load).  A NULL or repeated key fails it."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        append_batch(keyed.dedupe_by_key(batch, pk, order_by), table_root, pk, batch_id + 1)

    return per_batch


def stream_upsert(spark: SparkSession, source: str, schema: StructType, table_root: str, checkpoint: str,
                  pk: str | Sequence[str], order_by: Optional[Sequence[str]] = None,
                  max_files_per_trigger: Optional[int] = None) -> None:
    """Upsert each micro-batch into a keyed table, to be read by ``read_newest``."""
    _run(_source(spark, source, schema, max_files_per_trigger), upsert_batch_writer(pk, table_root, order_by), checkpoint)


def stream_profile(spark: SparkSession, source: str, schema: StructType, table_root: str, checkpoint: str,
                   ts_col: str, columns: Sequence[str], window: str = "1 day",
                   watermark: str = "1 day", slices: Sequence[str] = (),
                   max_files_per_trigger: Optional[int] = None) -> int:
    """Windowed profile maintained incrementally (update mode).

    State holds one partial aggregate per open (window, slice); windows older
    than the watermark are finalised and dropped from state.  Each batch's
    updated rows become a batch of the profile table, keyed by
    ``(window_start, *slices, column_name)``; ``window_start`` is the start
    of the window as a UTC wall-clock timestamp, so windows of any length
    have their own rows.

    Returns the number of rows of this run that came later than the
    watermark; those are not in the profile, so a caller who gets more than
    0 runs the batch profile over the affected windows.
    """
    events = _source(spark, source, schema, max_files_per_trigger)
    if dict(events.dtypes)[ts_col] == "timestamp_ntz":
        events = events.withColumn(ts_col, ntz_as_utc(ts_col))
    events = events.withWatermark(ts_col, watermark)
    prof = profile_metrics(events, F.window(ts_col, window), list(columns), window_name="w", slices=slices)
    start = F.to_timestamp_ntz(F.convert_timezone(None, F.lit("UTC"), F.col("w.start").cast("timestamp_ntz")).cast("string"))
    prof = prof.select(start.alias("window_start"), *slices, *[c for c in prof.columns if c not in ("w", *slices)])
    keys = ["window_start", *slices, "column_name"]

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # the key check and the write read it; state is updated once
        append_batch(batch, table_root, keys, batch_id + 1)
        batch.unpersist()

    query = _run(prof, per_batch, checkpoint, output_mode="update")
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in _operators(p))


def stream_moments(spark: SparkSession, source: str, schema: StructType, table_root: str, checkpoint: str,
                   ts_col: str, columns: Sequence[str], window: str = "1 day", slices: Sequence[str] = (),
                   max_files_per_trigger: Optional[int] = None) -> None:
    """Windowed profile that takes late rows in: no watermark, no state, nothing dropped.

    Each micro-batch appends the moments of its own rows, one row per window
    (and slice and column) that it touches, however old the window is; a
    replayed micro-batch rewrites its own.  :func:`streamed_profile` merges them.
    """
    events = _source(spark, source, schema, max_files_per_trigger)
    if dict(events.dtypes)[ts_col] == "timestamp_ntz":
        events = events.withColumn(ts_col, ntz_as_utc(ts_col))
    start = F.to_timestamp_ntz(F.convert_timezone(None, F.lit("UTC"), F.window(ts_col, window)["start"].cast("timestamp_ntz")).cast("string"))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        own = batch.withColumn("window_start", start)
        moments = materialize(column_moments(own, "window_start", list(columns), slices=slices), "moments")  # the key check and the write read it
        append_batch(moments, table_root, ["window_start", *slices, "column_name"], batch_id + 1)

    _run(events, per_batch, checkpoint)


def streamed_profile(spark: SparkSession, table_root: str, slices: Sequence[str] = ()) -> DataFrame:
    """``(window_start, *slices, column_name, n, nulls, avg, min, max, stddev)`` over all micro-batches so far."""
    keys = ["window_start", *slices, "column_name"]
    return moments_profile(merge_moments(read_batches(spark, table_root), keys), keys)


def _operators(progress) -> list[dict]:
    import json

    return json.loads(progress.json)["stateOperators"]
