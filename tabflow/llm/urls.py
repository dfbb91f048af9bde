"""URL filters by a temporal list join.

A list is a history: an entry (a host or a domain above it) is added or
removed at a time.  Each entry's history becomes validity intervals; a
capture is judged by the entries valid at its fetch time, looked up for its
host and every domain above it (as-of join).  Intervals are cut at the
borders of fixed time slices, and the join is on entry and slice, so a host
with a third of all captures spreads over its slices, and AQE splits what
remains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Length of a time slice in seconds (30 days).
SLICE = 30 * 86_400


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without user, port and trailing dot; null if there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.nullif(F.regexp_replace(F.lower(host), r"\.+$", ""), F.lit(""))


def domains(host: Column) -> Column:
    """The host and every domain above it, down to two labels, longest first; an IPv4 address alone; empty for null."""
    labels = F.split(host, r"\.")
    address = host.rlike(r"^[0-9]+(\.[0-9]+){3}$")
    steps = F.sequence(F.lit(1), F.when(address, 1).otherwise(F.greatest(F.size(labels) - 1, F.lit(1))))
    return F.when(host.isNull(), F.array().cast("array<string>")).otherwise(
        F.transform(steps, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))


def intervals(history: DataFrame) -> DataFrame:
    """``entry, since, until`` (seconds, end excluded, null: still valid) from
    ``entry, at, listed``.

    Of several changes at one time removal wins.  Repeated changes to the
    same state extend it.  Changes without an entry, time or state are left
    out.  A history holds one entry's changes, sorted by Spark with spilling.
    """
    clean = (history.where("entry is not null and at is not null and listed is not null")
                    .groupBy("entry", F.col("at").cast("long").alias("at")).agg(F.min(F.col("listed").cast("boolean")).alias("listed")))
    order = Window.partitionBy("entry").orderBy("at")
    turns = (clean.withColumn("was", F.lag("listed").over(order))
                  .where("was is null or was <> listed")
                  .withColumn("until", F.lead("at").over(order)))
    return turns.where("listed").select("entry", F.col("at").alias("since"), "until")


def judge(captures: DataFrame, history: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """``captures`` with ``host``, ``blocked``, and of the longest entry valid
    at ``fetched`` (seconds) ``entry`` and ``since``.

    A capture without a host or a fetch time is not blocked.  Repeated rows
    are judged each; a ``since <= fetched < until`` bound is exact to the
    second.  Existing columns stay (of the new names, they are replaced).
    """
    base = captures.drop("host", "blocked", "entry", "since").withColumn("host", host_of(F.col(url)))
    names = base.select("host", F.col(fetched).cast("long").alias("fetched")).where("host is not null and fetched is not null").distinct()
    asked = (names.select("host", "fetched", F.explode(domains(F.col("host"))).alias("entry"))
                  .withColumn("slice", F.floor(F.col("fetched") / SLICE)))
    horizon = names.agg(F.max("fetched")).first()[0]
    valid = intervals(history).where(F.col("since") <= (horizon or 0))
    last = F.least(F.coalesce(F.col("until") - 1, F.lit(horizon or 0)), F.lit(horizon or 0))
    sliced = valid.withColumn("slice", F.explode(F.sequence(F.floor(F.col("since") / SLICE), F.floor(last / SLICE))))
    hits = (asked.join(sliced, ["entry", "slice"]).where("since <= fetched and (until is null or fetched < until)")
                 .groupBy("host", "fetched").agg(F.max(F.struct(F.length("entry").alias("n"), "entry", "since")).alias("hit"))
                 .select(F.col("host").alias("_host"), F.col("fetched").alias("_fetched"), F.col("hit.entry").alias("entry"), F.col("hit.since").alias("since")))
    both = base.join(hits, (F.col("host") == F.col("_host")) & (F.col(fetched).cast("long") == F.col("_fetched")), "left")
    return both.select(*[base[c] for c in base.columns], F.col("entry").isNotNull().alias("blocked"), "entry", "since")
