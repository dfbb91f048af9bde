import pytest
from pyspark.sql import functions as F

from tabflow.operators import keyed, split
from tabflow.operators.monitor import profile_metrics, window_start
from tabflow.session import scratch_path
from tabflow.sources.tables import append_batch, batch_ids, read_newest
from tabflow.streaming import stream_incremental_split, stream_profile, stream_split_by_state, stream_upsert
from tests.conftest import rows


PROFILE_KEY = ["window_start", "column_name"]


def test_stream_split_equals_batch(spark):
    root = scratch_path(spark, "t_stream_split")
    df = spark.range(0, 300).select("id", (F.col("id") % 3).cast("string").alias("y"))
    for part in (df.where("id < 200"), df.where("id >= 100")):  # overlap re-sent
        part.write.mode("append").parquet(f"{root}/in")
        stream_incremental_split(spark, f"{root}/in", df.schema, f"{root}/out", f"{root}/ck", "id", "y")
    stream_incremental_split(spark, f"{root}/in", df.schema, f"{root}/out", f"{root}/ck", "id", "y")
    got = rows(spark.read.parquet(f"{root}/out"), "id", "y", "split")
    assert got == rows(split.assign_split(df, "id", "y"), "id", "y", "split")


def test_split_by_state_equals_batch(spark):
    """Overlapping arrivals over restarts, null keys and targets; a key is new until it has a target."""
    root = scratch_path(spark, "t_state_split")
    df = spark.range(0, 300).select("id", (F.col("id") % 3).cast("string").alias("y"))
    untargeted = df.select("id", F.when(F.col("id") >= 250, F.col("y")).alias("y"))
    keyless = spark.sql("select cast(null as bigint) id, 'a' y")
    for part in (df.where("id < 200"), df.where("id >= 100 and id < 260").union(keyless), untargeted, df, None):
        if part is not None:
            part.write.mode("append").parquet(f"{root}/in")
        stream_split_by_state(spark, f"{root}/in", df.schema, f"{root}/out", f"{root}/ck", "id", "y")
    got = rows(spark.read.parquet(f"{root}/out"), "id", "y", "split")
    assert got == rows(split.assign_split(df, "id", "y"), "id", "y", "split")


def test_split_by_state_reads_no_table(spark):
    """The state decides: with another, empty table old keys are still old."""
    root = scratch_path(spark, "t_state_only")
    df = spark.range(0, 100).select("id", F.lit("a").alias("y"))
    for k, part in enumerate((df.where("id < 60"), df)):
        part.write.mode("append").parquet(f"{root}/in")
        stream_split_by_state(spark, f"{root}/in", df.schema, f"{root}/out{k}", f"{root}/ck", "id", "y")
    assert sorted(r.id for r in spark.read.parquet(f"{root}/out1").collect()) == list(range(60, 100))


def test_split_by_state_replays_a_failed_batch(spark, monkeypatch):
    from tabflow.streaming import streams

    root = scratch_path(spark, "t_state_replay")
    df = spark.range(0, 80).select("id", F.lit("a").alias("y"))
    args = (spark, f"{root}/in", df.schema, f"{root}/out", f"{root}/ck", "id", "y")
    df.where("id < 30").write.mode("append").parquet(f"{root}/in")
    stream_split_by_state(*args)
    df.write.mode("append").parquet(f"{root}/in")
    run = streams._run

    def failing(stream, fn, *more, **named):
        def per_batch(batch, batch_id):
            fn(batch, batch_id)
            raise RuntimeError("lost after the write, before the commit")

        return run(stream, per_batch, *more, **named)

    monkeypatch.setattr(streams, "_run", failing)
    with pytest.raises(Exception, match="lost after the write"):
        stream_split_by_state(*args)
    monkeypatch.setattr(streams, "_run", run)
    stream_split_by_state(*args)
    got = spark.read.parquet(f"{root}/out")
    assert sorted(r.id for r in got.collect()) == list(range(80))
    assert {r.ingest_id for r in got.where("id >= 30").select("ingest_id").distinct().collect()} == {1}


def test_split_by_state_forgets_after_keep(spark):
    root = scratch_path(spark, "t_state_keep")
    day = lambda d: f"2024-01-{d:02d} 00:00:00"
    arrivals = [[(1, day(1)), (1, day(1)), (2, day(1))], [(1, day(2)), (3, day(9))], [(9, day(20))], [(2, day(21)), (9, day(21))]]
    for part in arrivals:
        df = spark.createDataFrame([(i, "a", t) for i, t in part], "id long, y string, at string").withColumn("at", F.to_timestamp_ntz("at"))
        df.write.mode("append").parquet(f"{root}/in")
        stream_split_by_state(spark, f"{root}/in", df.schema, f"{root}/out", f"{root}/ck", "id", "y", ts_col="at", keep="5 days")
    out = spark.read.parquet(f"{root}/out")
    assert sorted((r.id, r["at"].day) for r in out.collect()) == [(1, 1), (2, 1), (2, 21), (3, 9), (9, 20)]
    assert set(out.columns) == {"id", "y", "at", "split", "ingest_id"}


def test_stream_upsert_equals_batch(spark):
    root = scratch_path(spark, "t_stream_upsert")
    base = spark.range(0, 100).select("id", F.lit("v0").alias("v"))
    u1 = spark.range(50, 150).select("id", F.lit("v1").alias("v"))
    u2 = spark.range(140, 160).select("id", F.lit("v2").alias("v"))
    append_batch(base, f"{root}/t", "id", 0)
    for u in (u1, u2):
        u.write.mode("append").parquet(f"{root}/in")
        stream_upsert(spark, f"{root}/in", base.schema, f"{root}/t", f"{root}/ck", "id")
    expect = keyed.upsert(keyed.upsert(base, u1, "id"), u2, "id")
    assert rows(read_newest(spark, f"{root}/t", "id")) == rows(expect)


def test_stream_profile_equals_batch(spark):
    root = scratch_path(spark, "t_stream_profile")
    ev = spark.range(0, 480).select(
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id as int), 0, 0)").alias("ts"),
        (F.col("id") % 7).cast("double").alias("value"))
    for part in (ev.where("id < 200"), ev.where("id >= 200")):
        part.write.mode("append").parquet(f"{root}/in")
        stream_profile(spark, f"{root}/in", ev.schema, f"{root}/t", f"{root}/ck", "ts", ["value"])
    got = read_newest(spark, f"{root}/t", PROFILE_KEY)
    got = got.withColumn("window_start", F.to_date("window_start"))
    expect = profile_metrics(ev, window_start("ts", "day"), ["value"])
    cols = ["window_start", "column_name", "n", "nulls", "avg", "min", "max"]
    assert rows(got, *cols) == rows(expect, *cols)


def test_stream_profile_watermark_drops_late_rows(spark):
    root = scratch_path(spark, "t_stream_late")
    day = lambda d, h=0: f"2024-01-{d:02d} {h:02d}:00:00"
    batches = [
        [(day(1), 1.0), (day(2), 2.0)],
        [(day(5), 5.0), (day(2, 12), 4.0)],  # day 2 is still open (watermark = max ts - 1 day = Jan 1)
        [(day(1, 6), 100.0), (day(5, 6), 7.0)],  # day 1 now behind the watermark (Jan 4): dropped
    ]
    late = []
    for rows_ in batches:
        df = spark.createDataFrame([(r[0], r[1]) for r in rows_], "ts string, value double").select(
            F.to_timestamp_ntz("ts").alias("ts"), "value")
        df.write.mode("append").parquet(f"{root}/in")
        late.append(stream_profile(spark, f"{root}/in", df.schema, f"{root}/t", f"{root}/ck", "ts", ["value"],
                                   watermark="1 day"))
    assert late == [0, 0, 1]
    got = {str(r.window_start)[:10]: (r.n, r.avg) for r in read_newest(spark, f"{root}/t", PROFILE_KEY).collect()}
    assert got == {"2024-01-01": (1, 1.0), "2024-01-02": (2, 3.0), "2024-01-05": (2, 6.0)}


def test_batch_writers_replay_idempotent(spark):
    from tabflow.streaming.streams import split_batch_writer, upsert_batch_writer

    root = scratch_path(spark, "t_replay")
    b0 = spark.range(0, 60).select("id", F.lit("x").alias("y"))
    b1 = spark.range(40, 100).select("id", F.lit("x").alias("y"))
    w = split_batch_writer(spark, f"{root}/split", "id", "y")
    w(b0, 0)
    w(b1, 1)
    w(b1, 1)  # the same batch delivered again after a failure
    out = spark.read.parquet(f"{root}/split")
    assert out.count() == 100 and out.select("id").distinct().count() == 100

    append_batch(spark.range(0, 10).select("id", F.lit("v0").alias("v")), f"{root}/keyed", "id", 0)
    u = upsert_batch_writer("id", f"{root}/keyed")
    u(spark.range(5, 15).select("id", F.lit("v1").alias("v")), 0)
    u(spark.range(5, 15).select("id", F.lit("v1").alias("v")), 0)  # replay
    assert batch_ids(spark, f"{root}/keyed") == [0, 1]
    assert rows(read_newest(spark, f"{root}/keyed", "id")) == [(i, "v0") for i in range(5)] + [(i, "v1") for i in range(5, 15)]


def test_stream_upsert_one_file_per_batch_keeps_arrival_order(spark):
    root = scratch_path(spark, "t_stream_upsert_order")
    base = spark.range(0, 50).select("id", F.lit("v0").alias("v"))
    u1 = spark.range(20, 60).select("id", F.lit("v1").alias("v")).repartition(3)
    u2 = spark.range(40, 70).select("id", F.lit("v2").alias("v")).repartition(2)
    append_batch(base, f"{root}/t", "id", 0)
    u1.write.mode("append").parquet(f"{root}/in")
    u2.write.mode("append").parquet(f"{root}/in")  # both waiting before the run starts
    stream_upsert(spark, f"{root}/in", base.schema, f"{root}/t", f"{root}/ck", "id", max_files_per_trigger=1)
    expect = keyed.upsert(keyed.upsert(base, u1, "id"), u2, "id")
    assert rows(read_newest(spark, f"{root}/t", "id")) == rows(expect)
    assert len(batch_ids(spark, f"{root}/t")) > 2  # several micro-batches


def test_stream_profile_of_an_hour_keeps_each_window(spark):
    root = scratch_path(spark, "t_stream_hours")
    ev = spark.range(0, 480).select(
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id * 20 as int), 0)").alias("ts"),
        (F.col("id") % 7).cast("double").alias("value"))
    for part in (ev.where("id < 200"), ev.where("id >= 200")):
        part.write.mode("append").parquet(f"{root}/in")
        stream_profile(spark, f"{root}/in", ev.schema, f"{root}/t", f"{root}/ck", "ts", ["value"], window="1 hour")
    got = read_newest(spark, f"{root}/t", PROFILE_KEY)
    expect = profile_metrics(ev, F.date_trunc("hour", "ts"), ["value"])
    assert got.count() == got.select("window_start").distinct().count() == 160
    assert sorted(r.n for r in got.collect()) == sorted(r.n for r in expect.collect())
