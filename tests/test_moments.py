import random
from math import isclose

import pytest
from pyspark.sql import functions as F

from tabflow.operators.moments import column_moments, merge_moments, moments_profile, refresh_moments, retract_moments
from tabflow.operators.monitor import profile_metrics
from tabflow.plans.flows import sync_newer
from tabflow.session import scratch_path
from tabflow.sources.tables import append_batch, batch_ids, read_newest
from tabflow.streaming import stream_moments, streamed_profile

KEYS = ["w", "column_name"]


def table_of(spark, data):
    return spark.createDataFrame(data, "id long, w long, a double, b double")


def data_of(seed, n):
    r = random.Random(seed)
    # values far from 0 and close together: differences of squares would cancel
    return [(i, r.choice([None, 1, 2, 3]), r.choice([None, 1e7 + r.random(), 1e7 + 5.0]), r.uniform(-3, 3) if i % 3 else None) for i in range(n)]


def same(got, want):
    got, want = (sorted((tuple(r) for r in d.collect()), key=str) for d in (got, want))
    assert len(got) == len(want) > 0
    for g, w in zip(sorted(got, key=lambda t: str(t[:2])), sorted(want, key=lambda t: str(t[:2]))):
        assert g[:4] == w[:4]
        for x, y in zip(g[4:], w[4:]):
            assert (x is None) == (y is None) and (x is None or isclose(x, y, rel_tol=1e-6, abs_tol=1e-6)), (g, w)


def profile(df):
    return profile_metrics(df, "w", ["a", "b"], "w").select(*KEYS, "n", "nulls", "avg", "min", "max", "stddev")


def test_merged_moments_equal_the_profile_of_all_rows(spark):
    data = data_of(1, 400) + [(900, 7, None, None), (901, 8, 2.0, None)]
    parts = [table_of(spark, data[k::5]) for k in range(5)]
    moments = [column_moments(p, "w", ["a", "b"], "w") for p in parts]
    every = moments[0]
    for m in moments[1:]:
        every = every.union(m)
    same(moments_profile(merge_moments(every, KEYS), KEYS), profile(table_of(spark, data)))
    assert merge_moments(moments[0].limit(0), KEYS).count() == 0
    with pytest.raises(ValueError):
        column_moments(parts[0], "w", [], "w")


def test_refresh_from_changes_equals_the_profile(spark):
    data = data_of(2, 300) + [(900, 7, 1.0, None), (901, 9, 5.0, 5.0)]
    r = random.Random(3)
    changed = {i for i, *_ in data if r.random() < 0.2} | {901}
    # extremes of window 1 are among the removed; 900 is deleted and empties window 7; 950 opens window 10
    ones = [x for x in data if x[1] == 1 and x[3] is not None]
    changed |= {max(ones, key=lambda x: x[3])[0], min(ones, key=lambda x: x[3])[0]}
    after = [(i, w, None if a is None else a - 0.5, r.choice([None, 0.25])) for i, w, a, b in data if i in changed] + [(950, 10, 4.0, None)]
    before = [x for x in data if x[0] in changed | {900}]
    now = [x for x in data if x[0] not in changed | {900}] + after
    state = column_moments(table_of(spark, data), "w", ["a", "b"], "w")
    taken = retract_moments(state, column_moments(table_of(spark, before), "w", ["a", "b"], "w"), KEYS)
    assert {(x.w, x.stale) for x in taken.where("column_name = 'b' and w = 1").collect()} == {(1, True)}
    assert taken.where("w = 7").count() == 0
    got = refresh_moments(state, table_of(spark, before), table_of(spark, after), table_of(spark, now), "w", ["a", "b"], "w")
    same(moments_profile(got, KEYS), profile(table_of(spark, now)))
    none = table_of(spark, data).limit(0)
    same(moments_profile(refresh_moments(state, none, none, table_of(spark, data), "w", ["a", "b"], "w"), KEYS), profile(table_of(spark, data)))


def test_late_rows_reach_closed_windows(spark):
    root = scratch_path(spark, "t_moments")
    events = spark.range(0, 600).select(
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 3600).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 7 > 0, (F.col("id") * 37 % 101).cast("double")).alias("v"), (F.col("id") % 2).alias("s"))
    parts = [events.where("s = 0 and day(ts) > 10"), events.where("day(ts) <= 10"), events.where("s = 1 and day(ts) > 10")]
    for p in parts:  # the second is older than all of the first by days, the third falls into closed windows
        p.write.mode("append").parquet(f"{root}/in")
        stream_moments(spark, f"{root}/in", events.schema, f"{root}/t", f"{root}/ck", "ts", ["v"], slices=["s"])
    stream_moments(spark, f"{root}/in", events.schema, f"{root}/t", f"{root}/ck", "ts", ["v"], slices=["s"])  # nothing new
    want = profile_metrics(events, F.date_trunc("day", "ts"), ["v"], slices=["s"])
    keys = ["window_start", "s", "column_name"]
    rows = [sorted((tuple(x) for x in d.select(*keys, "n", "nulls", *[F.round(c, 6) for c in ("avg", "min", "max", "stddev")]).collect()), key=str)
            for d in (streamed_profile(spark, f"{root}/t", ["s"]), want)]
    assert rows[0] == rows[1] and len(rows[0]) == 50


def test_sync_reads_batches_beyond_the_copys_offset(spark):
    root = scratch_path(spark, "t_sync")
    src, copy = f"{root}/src", f"{root}/copy"
    batch = lambda lo, hi, v: spark.range(lo, hi).select("id", F.lit(v).alias("v"), F.lit(1).alias("unused"))
    state = lambda: {x.id: x.v for x in read_newest(spark, copy, "id").collect()}
    assert sync_newer(spark, src, copy, "id") == 0
    append_batch(batch(0, 100, "a"), src, "id")
    assert sync_newer(spark, src, copy, "id", ["v"]) == 1 and read_newest(spark, copy, "id").columns == ["id", "v"]
    for lo, v in ((50, "b"), (90, "c"), (95, "d")):
        append_batch(batch(lo, lo + 50, v), src, "id")
    assert sync_newer(spark, src, copy, "id", ["v"]) == 3 and batch_ids(spark, copy) == [0, 3]
    assert state() == {x.id: x.v for x in read_newest(spark, src, "id").collect()}
    assert sync_newer(spark, src, copy, "id", ["v"]) == 0 and batch_ids(spark, copy) == [0, 3]
    assert {x.v for x in read_newest(spark, src, "id", since=2).collect()} == {"d"}
    assert len(read_newest(spark, src, "id", since=2).inputFiles()) < len(read_newest(spark, src, "id").inputFiles())
