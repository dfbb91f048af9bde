"""Streaming queries.  Each stages arrivals derived from a test table in
the shared scratch folder, runs the stream once per arrival (a triggered
job) and returns the table the stream maintained."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabflow.plans import standins as S
from tabflow.plans.catalog import exact, exact_avg_sql, register, sround, table
from tabflow.plans.flows import sync_newer
from tabflow.plans.queries_tables import ORDER_COLS
from tabflow.session import scratch_path
from tabflow.sources.tables import append_batch, read_newest
from tabflow.streaming import stream_incremental_split, stream_moments, stream_profile, stream_split_by_state, stream_upsert, streamed_profile


_STREAM_SPLIT_SQL = f"""
SELECT o_orderkey, o_totalprice, status, {S.split_sql('o_orderkey')} AS split
FROM ({S.BOOKINGS_SQL}) b WHERE status IS NOT NULL
"""


def _streamed_split(spark, sf_dir, run):
    root = scratch_path(spark, "stream_split")
    incoming, out, ckpt = f"{root}/incoming", f"{root}/table", f"{root}/checkpoint"
    bookings = S.bookings(spark, sf_dir)
    arrivals = [bookings.where(F.col("o_orderdate") < S.ts(S.OLD_CUTOFF)), bookings]  # 2nd re-sends old rows
    for arrival in arrivals + [None]:  # last run: nothing new arrived
        if arrival is not None:
            arrival.write.mode("append").parquet(incoming)
        run(spark, incoming, bookings.schema, out, ckpt, S.PK, "status")
    return spark.read.parquet(out).select(S.PK, "o_totalprice", "status", "split")


@register("stream_incremental_split", sql=_STREAM_SPLIT_SQL)
def q_stream_incremental_split(spark, sf_dir):
    return _streamed_split(spark, sf_dir, stream_incremental_split)


@register("stream_split_by_state", sql=_STREAM_SPLIT_SQL)
def q_stream_split_by_state(spark, sf_dir):
    return _streamed_split(spark, sf_dir, stream_split_by_state)


_U2_FROM = "2000-01-01"
_U2_SQL = ("SELECT o_orderkey, o_custkey, o_orderstatus, "
           "CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 2.0 ELSE o_totalprice END AS o_totalprice, "
           f"o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '{_U2_FROM}'")


@register("stream_upsert", sql=f"""
WITH t1 AS (
  SELECT {ORDER_COLS} FROM ({S.OLD_SQL}) o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({S.UPDATE_SQL}) u)
  UNION ALL SELECT {ORDER_COLS} FROM ({S.UPDATE_SQL}) u
)
SELECT {ORDER_COLS} FROM t1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({_U2_SQL}) v)
UNION ALL SELECT {ORDER_COLS} FROM ({_U2_SQL}) v
""")
def q_stream_upsert(spark, sf_dir):
    root = scratch_path(spark, "stream_upsert")
    incoming, out, ckpt = f"{root}/incoming", f"{root}/table", f"{root}/checkpoint"
    append_batch(S.old_snapshot(spark, sf_dir), out, S.PK, 0)  # initial load
    orders = table(spark, sf_dir, "orders")
    u2 = (orders.where(F.col("o_orderdate") >= S.ts(_U2_FROM))
                .withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 2.0)
                            .otherwise(F.col("o_totalprice"))))
    for arrival in (S.update_batch(spark, sf_dir), u2):
        arrival.write.mode("append").parquet(incoming)
        stream_upsert(spark, incoming, orders.schema, out, ckpt, S.PK)
    return read_newest(spark, out, S.PK)


def _profile_sql(unit: str) -> str:
    return f"""
SELECT date_trunc('{unit}', ts) AS window_start, event_type, 'value' AS column_name,
       count(*) AS n, count(*) FILTER (WHERE value IS NULL) AS nulls,
       {sround(exact_avg_sql("value"), 4)} AS avg, {sround("min(value)", 4)} AS min,
       {sround("max(value)", 4)} AS max, {sround("stddev_samp(value)", 4)} AS stddev
FROM events GROUP BY 1, 2
"""


def _stream_profile(spark, sf_dir, window):
    root = scratch_path(spark, "stream_profile")
    incoming, out, ckpt = f"{root}/incoming", f"{root}/table", f"{root}/checkpoint"
    events = table(spark, sf_dir, "events").withColumn("value", exact("value"))
    half = S.ts("2024-01-16")
    for arrival in (events.where(F.col("ts") < half), events.where(F.col("ts") >= half)):
        arrival.write.mode("append").parquet(incoming)
        stream_profile(spark, incoming, events.schema, out, ckpt, "ts", ["value"], window=window, slices=["event_type"])
    prof = read_newest(spark, out, ["window_start", "event_type", "column_name"])
    return prof.select("window_start", "event_type", "column_name", "n", "nulls",
                       *[F.round(c, 4).alias(c) for c in ("avg", "min", "max", "stddev")])


@register("stream_profile", sql=_profile_sql("day"))
def q_stream_profile(spark, sf_dir):
    return _stream_profile(spark, sf_dir, "1 day")


@register("stream_profile_hourly", sql=_profile_sql("hour"))
def q_stream_profile_hourly(spark, sf_dir):
    return _stream_profile(spark, sf_dir, "1 hour")


@register("stream_profile_late", sql=_profile_sql("day"))
def q_stream_profile_late(spark, sf_dir):
    """The newer half arrives first, so every row of the older half comes weeks late; none is lost."""
    root = scratch_path(spark, "stream_moments")
    incoming, out, ckpt = f"{root}/incoming", f"{root}/table", f"{root}/checkpoint"
    events = table(spark, sf_dir, "events").withColumn("value", exact("value"))
    half = S.ts("2024-01-16")
    for arrival in (events.where(F.col("ts") >= half), events.where(F.col("ts") < half)):
        arrival.write.mode("append").parquet(incoming)
        stream_moments(spark, incoming, events.schema, out, ckpt, "ts", ["value"], slices=["event_type"])
    prof = streamed_profile(spark, out, ["event_type"])
    return prof.select("window_start", "event_type", "column_name", "n", "nulls",
                       *[F.round(c, 4).alias(c) for c in ("avg", "min", "max", "stddev")])


@register("sync_newer", sql=f"""
WITH t1 AS (
  SELECT {ORDER_COLS} FROM ({S.OLD_SQL}) o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({S.UPDATE_SQL}) u)
  UNION ALL SELECT {ORDER_COLS} FROM ({S.UPDATE_SQL}) u
), t2 AS (
  SELECT {ORDER_COLS} FROM t1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({_U2_SQL}) v)
  UNION ALL SELECT {ORDER_COLS} FROM ({_U2_SQL}) v
)
SELECT o_orderkey, o_orderstatus, o_totalprice FROM t2
""")
def q_sync_newer(spark, sf_dir):
    """A serving copy synced three times: the first load, two batches at once, nothing."""
    root = scratch_path(spark, "sync_newer")
    orders = table(spark, sf_dir, "orders")
    u2 = (orders.where(F.col("o_orderdate") >= S.ts(_U2_FROM))
                .withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 2.0).otherwise(F.col("o_totalprice"))))
    taken = []
    for batches in ((S.old_snapshot(spark, sf_dir),), (S.update_batch(spark, sf_dir), u2), ()):
        for batch in batches:
            append_batch(batch, f"{root}/table", S.PK)
        taken.append(sync_newer(spark, f"{root}/table", f"{root}/copy", S.PK, ["o_orderstatus", "o_totalprice"]))
    if taken != [1, 2, 0]:
        raise RuntimeError(f"syncs took over {taken} batches")
    return read_newest(spark, f"{root}/copy", S.PK)
