"""Profile, drift series and drift alert queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabflow.operators.moments import column_moments, moments_profile, refresh_moments
from tabflow.operators.monitor import drift_alert, drift_series, profile_metrics, snapshot_profile, window_start
from tabflow.plans import standins as S
from tabflow.plans.catalog import exact, exact_avg_sql, register, sround, table
from tabflow.session import scratch_path
from tabflow.sources.tables import append_batch, materialize, read_newest

# Profiled lineitem columns; l_tax is blanked on returned lines so the
# profile has NULLs to count.
_PROFILE_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax_kept")


def _lineitem_profile(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn(
        "l_tax_kept", F.when(F.col("l_returnflag") != "R", F.col("l_tax")))
    li = li.withColumns({c: exact(c) for c in _PROFILE_COLS})
    return profile_metrics(li, window_start("l_shipdate", "month"), list(_PROFILE_COLS))


def _rounded_profile(df):
    return df.select(
        "window_start", "column_name", "n", "nulls",
        *[F.round(c, 4).alias(c) for c in ("avg", "min", "max", "stddev")],
    )


def _profile_sql_part(c: str, e: str) -> str:
    return f"""
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS window_start, '{c}' AS column_name,
       count(*) AS n, count(*) FILTER (WHERE {e} IS NULL) AS nulls,
       {sround(exact_avg_sql(e), 4)} AS avg, {sround(f"min({e})", 4)} AS min, {sround(f"max({e})", 4)} AS max,
       {sround(f"stddev_samp({e})", 4)} AS stddev
FROM lineitem GROUP BY 1
"""

_PROFILE_EXPR = {
    "l_quantity": "l_quantity",
    "l_extendedprice": "l_extendedprice",
    "l_discount": "l_discount",
    "l_tax_kept": "CASE WHEN l_returnflag <> 'R' THEN l_tax END",
}


@register("profile_metrics", sql="\nUNION ALL\n".join(
    _profile_sql_part(c, e) for c, e in _PROFILE_EXPR.items()))
def q_profile_metrics(spark, sf_dir):
    return _rounded_profile(_lineitem_profile(spark, sf_dir))


def _event_series(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("value", exact("value"))
    prof = profile_metrics(ev, window_start("ts", "day"), ["value"], slices=["event_type"])
    prof = prof.where(F.col("column_name") == "value")
    return drift_series(prof, keys=("event_type", "column_name"))


_SERIES_SQL = """
WITH p AS (
  SELECT event_type, 'value' AS column_name, CAST(date_trunc('day', ts) AS DATE) AS window_start,
         """ + exact_avg_sql("value") + """ AS avg
  FROM events GROUP BY 1, 2, 3
), s AS (
  SELECT *, lead(avg, 1) OVER (PARTITION BY event_type, column_name ORDER BY window_start DESC) AS prev_avg
  FROM p
), d AS (
  SELECT *, """ + sround("(avg - prev_avg) * 100.0 / nullif(prev_avg, 0)", 1) + """ AS pct FROM s
)
"""


@register("drift_series", sql=_SERIES_SQL + """
SELECT event_type, column_name, window_start, """ + sround("avg", 6) + """ AS avg,
       """ + sround("prev_avg", 6) + """ AS prev_avg,
       pct, CASE WHEN pct > 50.0 THEN 1 ELSE 0 END AS flag
FROM d
""")
def q_drift_series(spark, sf_dir):
    return _event_series(spark, sf_dir).select(
        "event_type", "column_name", "window_start",
        F.round("avg", 6).alias("avg"), F.round("prev_avg", 6).alias("prev_avg"), "pct", "flag")


@register("drift_alert", sql=_SERIES_SQL + """
, r AS (
  SELECT *, row_number() OVER (PARTITION BY event_type, column_name ORDER BY window_start DESC) AS rn FROM d
)
SELECT event_type, column_name, window_start AS latest_window, pct,
       CASE WHEN pct > 50.0 THEN 1 ELSE 0 END AS prediction_drift
FROM r WHERE rn = 1
""")
def q_drift_alert(spark, sf_dir):
    return drift_alert(_event_series(spark, sf_dir), keys=("event_type", "column_name"))


# two refreshes of a keyed price table: all orders, then open orders at 2.5 times their price
_REFRESHES = ("2025-01-06 00:00:00", "2025-01-13 00:00:00")


@register("refresh_alert", sql=f"""
WITH p AS (
  SELECT TIMESTAMP '{_REFRESHES[0]}' AS win, {exact_avg_sql("o_totalprice")} AS avg FROM orders
  UNION ALL
  SELECT TIMESTAMP '{_REFRESHES[1]}', {exact_avg_sql("CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice * 2.5 END")} FROM orders
), d AS (SELECT *, lag(avg) OVER (ORDER BY win) AS prev FROM p),
r AS (SELECT win, {sround("(avg - prev) * 100.0 / prev", 1)} AS pct FROM d)
SELECT 'o_totalprice' AS column_name, win AS latest_window, pct, CASE WHEN pct > 50.0 THEN 1 ELSE 0 END AS prediction_drift
FROM r ORDER BY win DESC LIMIT 1
""")
def q_refresh_alert(spark, sf_dir):
    """Upsert, profile the whole table at each refresh, alert on the newest two refreshes."""
    root = scratch_path(spark, "refresh")
    orders = table(spark, sf_dir, "orders").select(S.PK, "o_orderstatus", "o_totalprice")
    dearer = orders.where("o_orderstatus <> 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2.5)
    for k, batch in enumerate((orders, dearer)):
        append_batch(batch, f"{root}/prices", S.PK, k)
        state = read_newest(spark, f"{root}/prices", S.PK).withColumn("o_totalprice", exact("o_totalprice"))
        append_batch(snapshot_profile(state, _REFRESHES[k], ["o_totalprice"]), f"{root}/profile", ["window", "column_name"], k)
    profile = read_newest(spark, f"{root}/profile", ["window", "column_name"])
    return drift_alert(drift_series(profile, window_col="window"), window_col="window")


@register("refresh_from_changes", sql=f"""
WITH t1 AS (
  SELECT o_orderkey, o_orderdate, o_totalprice FROM ({S.OLD_SQL}) o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({S.UPDATE_SQL}) u)
  UNION ALL SELECT o_orderkey, o_orderdate, o_totalprice FROM ({S.UPDATE_SQL}) u
)
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS window_start, 'o_totalprice' AS column_name, count(*) AS n,
       count(*) FILTER (WHERE o_totalprice IS NULL) AS nulls, {sround(exact_avg_sql("o_totalprice"), 4)} AS avg,
       {sround("min(o_totalprice)", 4)} AS min, {sround("max(o_totalprice)", 4)} AS max, {sround("stddev_samp(o_totalprice)", 4)} AS stddev
FROM t1 GROUP BY 1
""")
def q_refresh_from_changes(spark, sf_dir):
    """A monthly profile brought up to date by one batch of a keyed table: changed rows out, their new ones in."""
    root = scratch_path(spark, "moments")
    for k, batch in enumerate((S.old_snapshot(spark, sf_dir), S.update_batch(spark, sf_dir))):
        append_batch(batch.select(S.PK, "o_orderdate", exact("o_totalprice").alias("o_totalprice")), f"{root}/orders", S.PK, k)
    month, columns = window_start("o_orderdate", "month"), ["o_totalprice"]
    old, new = read_newest(spark, f"{root}/orders", S.PK, upto=0), read_newest(spark, f"{root}/orders", S.PK)
    state = materialize(column_moments(old, month, columns), "moments")
    after = read_newest(spark, f"{root}/orders", S.PK, since=0)
    before = old.join(after.select(S.PK), S.PK, "left_semi")
    keys = ["window_start", "column_name"]
    profile = moments_profile(refresh_moments(state, before, after, new, month, columns), keys)
    return profile.select(*keys, "n", "nulls", *[F.round(c, 4).alias(c) for c in ("avg", "min", "max", "stddev")])
