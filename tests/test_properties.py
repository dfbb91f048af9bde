"""Property tests: operator invariants over generated inputs."""

import re

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabflow.operators import evaluate, generate, keyed, split
from tests.conftest import rows

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

snapshot = st.dictionaries(st.integers(0, 40), st.one_of(st.none(), st.integers(-3, 3)), max_size=25)


def frame(spark, d):
    return spark.createDataFrame([(k, v) for k, v in d.items()], "k long, v int")


@SETTINGS
@given(old=snapshot, new=snapshot, parts=st.integers(1, 5))
def test_change_feed_roundtrip(spark, old, new, parts):
    o, n = frame(spark, old).repartition(parts), frame(spark, new)
    changes = keyed.row_changes(o, n, "k")
    assert rows(keyed.apply_changes(o, changes, "k")) == rows(n)
    kinds = {r.k: r.change_type for r in changes.collect()}
    for k in set(old) | set(new):
        if k not in old:
            assert kinds[k] == "insert"
        elif k not in new:
            assert kinds[k] == "delete"
        elif old[k] != new[k]:
            assert kinds[k] == "update"
        else:
            assert k not in kinds


@SETTINGS
@given(old=snapshot, new=snapshot)
def test_upsert_semantics(spark, old, new):
    o, n = frame(spark, old), frame(spark, new)
    once = keyed.upsert(o, n, "k")
    expect = {**old, **new}
    assert rows(once) == rows(frame(spark, expect))
    assert rows(keyed.upsert(once, n, "k")) == rows(once)


@SETTINGS
@given(keys=st.sets(st.integers(0, 10 ** 9), min_size=1, max_size=60), parts=st.integers(2, 6),
       test_size=st.sampled_from([0.1, 0.2, 0.5]), seed=st.integers(0, 99))
def test_split_partition_invariant(spark, keys, parts, test_size, seed):
    df = spark.createDataFrame([(k, 1) for k in keys], "k long, y int")
    a = rows(split.assign_split(df.repartition(1), "k", "y", test_size, seed), "k", "split")
    b = rows(split.assign_split(df.repartition(parts), "k", "y", test_size, seed), "k", "split")
    assert a == b and len(a) == len(keys)


@SETTINGS
@given(pairs=st.lists(st.tuples(st.floats(-100, 100), st.floats(-100, 100)), min_size=2, max_size=40))
def test_error_metrics_vs_numpy(spark, pairs):
    df = spark.createDataFrame(pairs, "label double, prediction double")
    m = evaluate.error_metrics(df).first()
    y, p = np.array([a for a, _ in pairs]), np.array([b for _, b in pairs])
    assert np.isclose(m.mse, np.mean((y - p) ** 2), rtol=1e-9, atol=1e-9)
    assert np.isclose(m.mae, np.mean(np.abs(y - p)), rtol=1e-9, atol=1e-9)
    sst = np.sum((y - y.mean()) ** 2)
    if sst > 1e-6:
        assert np.isclose(m.r2, 1 - np.sum((y - p) ** 2) / sst, rtol=1e-6, atol=1e-6)


def continue_ids(existing, n, prefix):
    """The id rule stated plainly: max number after the prefix, padded to its digits."""
    nums = [int(m.group(1)) for i in existing if (m := re.search(re.escape(prefix) + r"(\d+)", i))]
    mx = max(nums)
    return [f"{prefix}{str(i).zfill(len(str(mx)))}" for i in range(mx + 1, mx + 1 + n)]


@SETTINGS
@given(nums=st.lists(st.integers(0, 10 ** 7), min_size=1, max_size=10), pad=st.integers(0, 3),
       n=st.integers(0, 5), prefix=st.sampled_from(["INN", "BK-", "A.B"]))
def test_next_ids_rule(spark, nums, pad, n, prefix):
    existing = [f"{prefix}{str(x).zfill(pad)}" for x in nums] + ["OTHER17"]
    df = spark.createDataFrame([(i,) for i in existing], "Booking_ID string")
    got = [r.new_id for r in generate.next_ids(df, "Booking_ID", n, prefix).orderBy("_num").collect()]
    assert got == continue_ids(existing, n, prefix)
