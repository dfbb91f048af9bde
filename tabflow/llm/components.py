"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.scratch import Scratch


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (smallest node reachable) for every node of ``edges``.

    Rounds of hooking and contraction: each node points to its smallest
    neighbour if that is smaller, pointers are doubled until all lead to
    roots, then edges are rewritten to roots and those inside one root
    vanish.  Every root with a remaining edge is merged in the next round or
    absorbs a neighbour, so the number of roots at least halves.

    Minima are combined before the shuffle and every join is between two
    freshly read tables, so a hub with a third of all edges is split by AQE.
    Only counts reach the driver.  Self-loops, repeated and null edges are
    harmless (nulls are ignored); an empty input gives an empty result.
    """
    spark = edges.sparkSession
    tmp = Scratch(spark, "components")
    own = (edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
                .where(F.col(a).isNotNull() & F.col(b).isNotNull()))
    left = tmp.save(own.distinct(), "edges0")
    labels = None
    k = 0
    while True:
        loops = left if k == 0 else left.where("u <> v")
        both = loops.select("u", "v").union(loops.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hook = tmp.save(both.groupBy(F.col("u").alias("node"))
                            .agg(F.min("v").alias("m"))
                            .select("node", F.least("node", "m").alias("up")), f"hook{k}_0")
        j = 0
        while True:  # pointer doubling
            up = hook.select(F.col("node").alias("up"), F.col("up").alias("top"))
            nxt = tmp.save(hook.join(up, "up", "left")
                               .select("node", F.coalesce("top", "up").alias("up"),
                                       (F.coalesce("top", "up") != F.col("up")).alias("moved")),
                           f"hook{k}_{j + 1}")
            moved = nxt.where("moved").limit(1).count()
            tmp.drop(f"hook{k}_{j}")
            hook, j = nxt.select("node", "up"), j + 1
            if not moved:
                break
        if labels is None:
            labels = hook.select("node", F.col("up").alias("component"))
            keep = f"hook{k}_{j}"
        else:
            top = hook.select(F.col("node").alias("component"), F.col("up").alias("top"))
            labels = tmp.save(labels.join(top, "component", "left")
                                    .select("node", F.coalesce("top", "component").alias("component")),
                              f"labels{k}")
            tmp.drop(keep)
            keep = f"labels{k}"
        ends = (left.join(hook.select(F.col("node").alias("u"), F.col("up").alias("pu")), "u")
                    .join(hook.select(F.col("node").alias("v"), F.col("up").alias("pv")), "v")
                    .where("pu <> pv")
                    .select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct())
        nxt = tmp.save(ends, f"edges{k + 1}")
        more = nxt.limit(1).count()
        tmp.drop(f"edges{k}")
        left, k = nxt, k + 1
        if not more:
            return labels
