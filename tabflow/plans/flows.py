"""Multi-step flows.  Each returns its outcome (flag / message / DataFrame);
nothing is passed through side channels."""

from __future__ import annotations

import uuid
from typing import Optional, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.operators import keyed, split
from tabflow.sources.tables import append_batch, batch_ids, child_ids, has_data_files, read_newest, read_table


INGEST_COL = "ingest_id"


def incremental_split(input_df: DataFrame, split_table: str, pk: str, target: Optional[str],
                      test_size: float = 0.2, seed: int = 42, split_col: str = "split",
                      ingest_id: Optional[int] = None, small_ingest: bool = False) -> bool:
    """Split only rows whose key is not yet in the split table; append them.

    The split table is ONE parquet table laid out as
    ``ingest_id=N/split=train|test`` (train and test are partition-pruned
    reads of it).  Each run writes its own ``ingest_id`` partition, in one
    pass: the diff is not evaluated twice to decide whether to write.
    Returns ``refreshed``:

    * table absent  -> split everything, ``True``;
    * no new keys   -> nothing written, ``False``;
    * new keys      -> the new rows only are split and added, ``True``.

    A failed run can be retried with the same ``ingest_id``: it reads only
    earlier ingests and overwrites its own partition.  NULL targets and NULL
    keys are dropped before the diff, so rows that can never be split are
    not "new" on every run.

    The diff reads only the key column of earlier ingests and is an ordinary
    anti-join of two scans, so AQE can split a hot incoming key and any
    session, with whatever settings, extends the same table.  With
    ``small_ingest`` a filter of the incoming keys keeps the other seen keys
    out of the shuffle (see ``split.new_rows_of_batch``); the result is the same.
    """
    spark = input_df.sparkSession
    split._check_test_size(test_size)
    done = child_ids(spark, split_table, INGEST_COL)
    run = ingest_id if ingest_id is not None else (done[-1] + 1 if done else 0)
    rows = input_df.where(F.col(pk).isNotNull())
    if target is not None:
        rows = split.drop_missing_target(rows, target)
    if any(i < run for i in done) and has_data_files(spark, split_table):
        seen = spark.read.parquet(split_table).where(F.col(INGEST_COL) < run)
        rows = (split.new_rows_of_batch if small_ingest else split.new_rows)(rows, seen.select(pk), pk)
    out = f"{split_table.rstrip('/')}/{INGEST_COL}={run}"
    rows.withColumn(split_col, split.split_side(pk, test_size, seed)).write.mode("overwrite").partitionBy(split_col).parquet(out)
    return has_data_files(spark, out)


def split_tables(spark, split_table: str, split_col: str = "split") -> tuple[DataFrame, DataFrame]:
    """(train, test) views of a split table (partition pruning on ``split``)."""
    df = read_table(spark, split_table).drop(INGEST_COL)
    return (df.where(F.col(split_col) == split.TRAIN).drop(split_col),
            df.where(F.col(split_col) == split.TEST).drop(split_col))


def write_keyed(root: str, new: DataFrame, pk: str, order_by: Optional[Sequence[str]] = None,
                batch_id: Optional[int] = None) -> str:
    """Create the keyed table under ``root`` or upsert into it: one batch.

    ``batch_id`` makes the call idempotent (a retry replaces its batch).
    With ``order_by`` duplicate keys in ``new`` are resolved first; a NULL or
    repeated key that is left fails the write, and the batch is never read.
    """
    if pk not in new.columns:
        raise ValueError(f"Primary key column '{pk}' not found in feature_data")
    created = not [n for n in batch_ids(new.sparkSession, root) if batch_id is None or n < batch_id]
    append_batch(keyed.dedupe_by_key(new, pk, order_by), root, pk, batch_id)
    if created:
        return f"Table {root} has been created with key {pk}."
    return f"The feature data has been successfully upserted into {root}."


RUNS_SCHEMA = ("model string, run_id string, run_order long, mse double, mae double, r2 double, "
               "max_depth int, n_estimators int, learning_rate double")
REGISTRY_SCHEMA = "model string, version long, run_id string"


def _largest(spark, path: str, model: str, column: str) -> int:
    if not has_data_files(spark, path):
        return 0
    return spark.read.parquet(path).where(F.col("model") == model).agg(F.max(column)).first()[0] or 0


def new_run_id(model: str) -> str:
    """Unique, so a run that failed half-way never blocks the next one."""
    return f"{model}-run-{uuid.uuid4().hex[:12]}"


def log_run(spark, runs_table: str, model: str, metrics_row, params, run_id: Optional[str] = None) -> str:
    """Append one run record (metrics + parameters); returns the run id."""
    run_id = run_id or new_run_id(model)
    order = _largest(spark, runs_table, model, "run_order") + 1
    rec = spark.createDataFrame(
        [(model, run_id, order, metrics_row["mse"], metrics_row["mae"], metrics_row["r2"],
          params.max_depth, params.n_estimators, float(params.learning_rate))], RUNS_SCHEMA)
    rec.write.mode("append").parquet(runs_table)
    return run_id


def register_version(spark, registry_table: str, model: str, run_id: str) -> int:
    version = _largest(spark, registry_table, model, "version") + 1
    spark.createDataFrame([(model, version, run_id)], REGISTRY_SCHEMA).write.mode("append").parquet(registry_table)
    return version


def evaluate_and_promote(spark, runs_table: str, registry_table: str, model: str) -> DataFrame:
    """Compare the newest run with the current version; register it when it
    is strictly better (or nothing is registered).  Returns the decision row
    ``(model, current_run, new_run, current_mae, new_mae, promote)``."""
    from tabflow.operators.evaluate import champion_challenger

    runs = spark.read.parquet(runs_table).where(F.col("model") == model)
    registry = (spark.read.parquet(registry_table) if has_data_files(spark, registry_table)
                else spark.createDataFrame([], REGISTRY_SCHEMA)).where(F.col("model") == model)
    decision = champion_challenger(runs, registry).first()
    if decision["promote"]:
        register_version(spark, registry_table, model, decision["new_run"])
    return spark.createDataFrame([decision.asDict()],
                                 "model string, current_run string, new_run string, current_mae double, "
                                 "new_mae double, promote boolean")


def batch_changes(spark, root: str, pk: str, since: int, upto: Optional[int] = None) -> DataFrame:
    """Row-level change feed of a keyed table between two batches (default: up
    to the newest): ``(pk, change_type, *columns)``.
    """
    old = read_newest(spark, root, pk, since)
    new = read_newest(spark, root, pk, upto)
    return keyed.row_changes(old, new, pk)


def sync_newer(spark, root: str, copy_root: str, pk: str, columns: Optional[Sequence[str]] = None) -> int:
    """Bring a copy of a keyed table up to date; returns how many batches it took over (0: nothing to do).

    The copy is a keyed table whose newest batch has the number of the last
    source batch it holds: the offset is committed together with the rows, so
    a sync that fails is simply run again.  Only batches beyond the offset are
    read, and of a key found in several of them the newest row is written
    (with ``columns`` only those besides the key).  Read the copy by
    ``read_newest``.  Source batches must be committed in the order of their numbers.
    """
    done = batch_ids(spark, copy_root)
    since = done[-1] if done else None
    later = [n for n in batch_ids(spark, root) if since is None or n > since]
    if not later:
        return 0
    rows = read_newest(spark, root, pk, upto=later[-1], since=since)
    append_batch(rows if columns is None else rows.select(pk, *columns), copy_root, pk, later[-1])
    return len(later)
