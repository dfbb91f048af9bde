"""Feature, metric, generation and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabflow.config import CatFeature, NumFeature
from tabflow.functions.dates import register_sql_functions
from tabflow.operators import evaluate, features, generate, quality
from tabflow.operators.keyed import latest_per_key
from tabflow.plans import standins as S
from tabflow.plans.catalog import exact_avg_sql, register, sround, table

# The order-priority levels in alphabetical order.
PRIORITY_LEVELS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@register("category_index", sql="""
SELECT o_orderpriority AS value, CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS INTEGER)
       AS index, count(*) AS n
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority
""")
def q_category_index(spark, sf_dir):
    return features.category_index(table(spark, sf_dir, "orders"), "o_orderpriority")


_NULLABLE_PRICE = "CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END"


_IMPUTED = f"coalesce({_NULLABLE_PRICE}, (SELECT avg({_NULLABLE_PRICE}) FROM orders))"


@register("impute_mean", sql=f"""
SELECT o_orderkey, {sround(_IMPUTED, 4)} AS o_totalprice_imputed
FROM orders
""")
def q_impute_mean(spark, sf_dir):
    df = table(spark, sf_dir, "orders").withColumn(
        "o_totalprice", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")))
    out = features.impute_mean(df, ["o_totalprice"])
    return out.select("o_orderkey", F.round("o_totalprice_imputed", 4).alias("o_totalprice_imputed"))


_SCALED = {c: f"{c} / (SELECT stddev_samp({c}) FROM orders)" for c in ("o_totalprice", "o_custkey")}


@register("scale_unit_std", sql=f"""
SELECT o_orderkey, {sround(_SCALED['o_totalprice'], 6)} AS o_totalprice_scaled,
       {sround(_SCALED['o_custkey'], 6)} AS o_custkey_scaled
FROM orders
""")
def q_scale_unit_std(spark, sf_dir):
    out = features.scale_unit_std(table(spark, sf_dir, "orders"), ["o_totalprice", "o_custkey"])
    return out.select("o_orderkey", F.round("o_totalprice_scaled", 6).alias("o_totalprice_scaled"),
                      F.round("o_custkey_scaled", 6).alias("o_custkey_scaled"))


def _one_hot_sql() -> str:
    cols = ", ".join(
        f"CAST(coalesce(o_orderpriority = '{lv}', false) AS INTEGER) AS {features.one_hot_name('o_orderpriority', lv)}"
        for lv in PRIORITY_LEVELS[:-1])
    return f"SELECT o_orderkey, {cols} FROM orders"


@register("one_hot", sql=_one_hot_sql())
def q_one_hot(spark, sf_dir):
    out = features.one_hot(table(spark, sf_dir, "orders"), "o_orderpriority", PRIORITY_LEVELS)
    return out.select("o_orderkey", *[features.one_hot_name("o_orderpriority", lv) for lv in PRIORITY_LEVELS[:-1]])


@register("years_since", sql="""
SELECT o_orderkey, CAST(2025 - year(o_orderdate) AS INTEGER) AS years_since_order FROM orders
""")
def q_years_since(spark, sf_dir):
    register_sql_functions(spark)  # SQL function, inlined by Catalyst (no Python worker)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr("years_since(year(o_orderdate), DATE '2025-01-01')").alias("years_since_order"))


@register("error_metrics", sql=f"""
WITH s AS (
  SELECT l_extendedprice / 1000.0 AS y, l_quantity * p_retailprice / 1000.0 AS p
  FROM lineitem JOIN part ON l_partkey = p_partkey
)
SELECT count(*) AS n, {sround("avg((y - p) * (y - p))", 6)} AS mse, {sround("avg(abs(y - p))", 6)} AS mae,
       {sround("1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))", 6)} AS r2
FROM s
""")
def q_error_metrics(spark, sf_dir):
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    scored = li.join(part, li["l_partkey"] == part["p_partkey"]).select(
        (F.col("l_extendedprice") / 1000.0).alias("label"),
        (F.col("l_quantity") * F.col("p_retailprice") / 1000.0).alias("prediction"))
    m = evaluate.error_metrics(scored)
    return m.select("n", *[F.round(c, 6).alias(c) for c in ("mse", "mae", "r2")])


@register("latest_per_key", sql="""
SELECT user_id, ts, event_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, event_type DESC,
                               value DESC, props DESC) AS rn
  FROM events) e
WHERE rn = 1
""")
def q_latest_per_key(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return latest_per_key(ev, "user_id", ["ts", "event_id"]).select(
        "user_id", "ts", "event_id", "event_type", "value", "props")


_RUNS_SQL = """
WITH runs AS (
  SELECT event_type AS model, CAST(date_trunc('day', ts) AS DATE) AS run_order,
         'run-' || CAST(CAST(date_trunc('day', ts) AS DATE) AS VARCHAR) AS run_id,
         avg(abs(value - 50.0)) AS mae
  FROM events GROUP BY 1, 2, 3
), latest AS (SELECT model, max(run_order) AS new_order FROM runs GROUP BY model),
registry AS (
  SELECT r.model, r.run_id FROM runs r JOIN latest l ON r.model = l.model AND r.run_order < l.new_order
), cur AS (
  SELECT g.model, max(g.run_id) AS current_run FROM registry g GROUP BY g.model
)
SELECT l.model, c.current_run, n.run_id AS new_run, """ + sround("rc.mae", 6) + """ AS current_mae,
       """ + sround("n.mae", 6) + """ AS new_mae,
       coalesce(c.current_run IS NULL OR n.mae < rc.mae, false) AS promote
FROM latest l JOIN runs n ON n.model = l.model AND n.run_order = l.new_order
LEFT JOIN cur c ON c.model = l.model LEFT JOIN runs rc ON rc.model = c.model AND rc.run_id = c.current_run
"""


@register("champion_challenger", sql=_RUNS_SQL)
def q_champion_challenger(spark, sf_dir):
    """Each event type is a "model"; each day one training run whose MAE is
    the mean absolute deviation of ``value`` from 50.  Every run before a
    model's newest is registered (version = run day); the newest run
    challenges the highest registered version.  Run ids repeat across models."""
    ev = table(spark, sf_dir, "events").withColumn("run_order", F.to_date(F.date_trunc("day", "ts")))
    runs = (ev.groupBy(F.col("event_type").alias("model"), "run_order")
              .agg(F.avg(F.abs(F.col("value") - 50.0)).alias("mae"))
              .withColumn("run_id", F.concat(F.lit("run-"), F.col("run_order").cast("string"))))
    newest = runs.groupBy("model").agg(F.max("run_order").alias("_newest"))
    registry = (runs.join(newest, "model").where(F.col("run_order") < F.col("_newest"))
                    .select("model", F.col("run_order").alias("version"), "run_id"))
    out = evaluate.champion_challenger(runs, registry)
    return out.select("model", "current_run", "new_run", F.round("current_mae", 6).alias("current_mae"),
                      F.round("new_mae", 6).alias("new_mae"), "promote")


@register("next_ids", sql="""
WITH m AS (
  SELECT max(CAST(regexp_extract(c_name, 'Customer#(\\d+)', 1) AS BIGINT)) AS mx FROM customer
  WHERE regexp_extract(c_name, 'Customer#(\\d+)', 1) <> ''
)
SELECT 'Customer#' || lpad(CAST(mx + r.range AS VARCHAR), CAST(greatest(9, length(CAST(mx + r.range AS VARCHAR))) AS INTEGER), '0')
       AS new_id
FROM m, range(1, (SELECT count(*) FROM customer) + 1) r
""")
def q_next_ids(spark, sf_dir):
    """As many new ids as the table has rows (a doubling ingest), padded to
    the observed width."""
    cust = table(spark, sf_dir, "customer")
    n = cust.count()
    return generate.next_ids(cust, "c_name", n, "Customer#", keep_width=True).select("new_id")


@register("shift_columns", sql="""
SELECT l_orderkey, l_partkey, CAST(l_linenumber * 2 AS INTEGER) AS l_linenumber, l_extendedprice * 1.5 AS l_extendedprice
FROM lineitem
""")
def q_shift_columns(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    return generate.shift_columns(li, {"l_extendedprice": 1.5, "l_linenumber": 2})


# Declared constraints for lineitem (parameters of the check, not data).
LINEITEM_NUM = (
    NumFeature("l_quantity", min=1, max=45),
    NumFeature("l_discount", min=0.0, max=0.08),
    NumFeature("l_tax", min=0.01),
)
LINEITEM_CAT = (
    CatFeature("l_returnflag", allowed_values=("A", "N")),
    CatFeature("l_linestatus", allowed_values=("O", "F")),
)


def _constraints_sql() -> str:
    parts = []
    for f in LINEITEM_NUM:
        for rule, op, bound in (("min", "<", f.min), ("max", ">", f.max)):
            if bound is not None:
                parts.append(f"SELECT '{f.name}' AS column_name, '{rule}' AS rule, "
                             f"count(*) FILTER (WHERE {f.name} {op} {bound}) AS violations, "
                             f"count({f.name}) AS checked FROM lineitem")
    for f in LINEITEM_CAT:
        vals = ", ".join(f"'{v}'" for v in f.allowed_values)
        parts.append(f"SELECT '{f.name}' AS column_name, 'allowed_values' AS rule, "
                     f"count(*) FILTER (WHERE {f.name} NOT IN ({vals})) AS violations, "
                     f"count({f.name}) AS checked FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@register("check_constraints", sql=_constraints_sql())
def q_check_constraints(spark, sf_dir):
    return quality.check_constraints(table(spark, sf_dir, "lineitem"), LINEITEM_NUM, LINEITEM_CAT)


SEGMENT_CODES = CatFeature("c_mktsegment", allowed_values=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"),
                           encoding=(1, 2, 3, 4))


@register("encode_values", sql="""
SELECT c_custkey, c_mktsegment,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
                         WHEN 'HOUSEHOLD' THEN 4 END AS c_mktsegment_code
FROM customer
""")
def q_encode_values(spark, sf_dir):
    return quality.encode_values(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"),
                                 [SEGMENT_CODES])


@register("append_new_rows", sql="SELECT * FROM orders")
def q_append_new_rows(spark, sf_dir):
    """Orders arrive in two parts, by date; both are appended to one table
    (the first creates it)."""
    from tabflow.session import scratch_path
    from tabflow.sources.tables import append

    raw = f"{scratch_path(spark, 'orders')}/raw"
    orders = table(spark, sf_dir, "orders")
    append(orders.where(F.col("o_orderdate") < S.ts(S.OLD_CUTOFF)), raw)
    append(orders.where(F.col("o_orderdate") >= S.ts(S.OLD_CUTOFF)), raw)
    return spark.read.parquet(raw)


@register("one_pass_preprocess", sql=f"""
WITH o AS (SELECT o_orderkey, o_orderpriority, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders),
m AS (SELECT {exact_avg_sql("price")} AS mean FROM o),
i AS (SELECT o.*, coalesce(price, mean) AS imputed FROM o, m),
s AS (SELECT stddev_samp(imputed) AS sd FROM i),
p AS (SELECT o_orderpriority AS v, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS ix FROM o GROUP BY 1),
c AS (SELECT o_custkey AS v, row_number() OVER (ORDER BY count(*) DESC, CAST(o_custkey AS VARCHAR)) - 1 AS ix FROM o GROUP BY 1)
SELECT o_orderkey, {sround("imputed", 2)} AS price_imputed, {sround("imputed / sd", 6)} AS price_scaled,
       p.ix AS o_orderpriority_indexed, c.ix AS o_custkey_indexed
FROM i, s, p, c WHERE p.v = o_orderpriority AND c.v = o_custkey
""")
def q_one_pass_preprocess(spark, sf_dir):
    """Fit in one scan: a price with gaps, a small category and one with a level per customer."""
    from tabflow.operators import onepass

    orders = table(spark, sf_dir, "orders").withColumn("price", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")))
    num, cat = ["price"], ["o_orderpriority", "o_custkey"]
    out = onepass.transform(orders, onepass.fit(orders, num, cat), num, cat)
    return out.select("o_orderkey", F.round("price_imputed", 2).alias("price_imputed"), F.round("price_scaled", 6).alias("price_scaled"),
                      "o_orderpriority_indexed", "o_custkey_indexed")
