"""Mixing sources to target weights by weighted fair queueing.

Documents of a source queue in a shuffled order (by a hash of their id).
A document's virtual finish time is the words of its source up to and
including it, divided by the source's target; a second copy finishes one
source size later.  All copies are ordered by finish time and the order is
cut where the total budget is used up, so every source has been served in
proportion to its target.

No task holds a source or an id: rows alike in id, source and size are one
row with a count until their running sums are known, these are taken in hash
ranges of a source and shifted by the sums of the ranges before, and the cut is found from a
histogram of finish times, of which one bucket is sorted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.llm.scratch import Scratch

#: Weights of the sources in code point order, repeating; words of the mix per 100 input words; most copies.
WEIGHTS, PERCENT, COPIES = (5, 2, 1), 150, 2
#: Rows that one hash range or histogram bucket holds, about.
RANGE_ROWS = 20_000
#: Rows with one count that are written out at a time.
STRETCH = 65_536


def words(text: Column) -> Column:
    """Number of runs other than ASCII white space; null has 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def shuffled(doc_id: Column) -> Column:
    """Hash that orders documents (hex; a null id counts as "")."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def targets(sizes: DataFrame) -> DataFrame:
    """``source, rank, source_size, target, total`` from ``source, source_size``.

    Sources share ``PERCENT`` of all words by weight; a target stops at
    ``COPIES`` times its source, and the excess goes to the others by weight.
    Sources are sorted by how soon they are full; the first that its share
    does not fill sets the share of all after it.  One row per source.
    """
    everything = Window.orderBy(F.lit(0))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    ranked = (sizes.withColumn("rank", F.row_number().over(by_name) - 1)
                   .withColumn("w", F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), F.col("rank") % len(WEIGHTS) + 1))
                   .withColumn("cap", COPIES * F.col("source_size")))
    full = Window.orderBy((exact("cap") * 10 / F.col("w")).cast("decimal(38,0)"), "rank")
    before, onward = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(0, Window.unboundedFollowing)
    shares = (ranked.withColumn("total", F.sum("source_size").over(everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
                    .withColumn("filled", F.coalesce(F.sum("cap").over(before), F.lit(0)))
                    .withColumn("wr", F.sum("w").over(onward))
                    .withColumn("left", exact("total") * PERCENT - exact("filled") * 100)
                    .withColumn("level", F.col("left").cast("double") / (100 * F.col("wr")).cast("double"))
                    .withColumn("open", exact("cap") * 100 * exact("wr") >= F.col("left") * F.col("w")))
    # later open sources would see the caps of earlier ones taken off, so the first open one has the highest level
    level = F.max(F.when(F.col("open"), F.col("level"))).over(
        everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (shares.withColumn("common", level)
                  .select("source", "rank", "source_size", "total",
                          F.when(F.col("open"), F.col("w") * F.col("common")).otherwise(F.col("cap").cast("double")).alias("target")))


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every row.

    ``taken`` is 0, 1 or 2 times ``size``.  Null and empty texts have size 0
    and are never taken; a null source is a source of its own, the last.
    Repeated rows are separate documents; rows with one id stand next to
    each other, smaller first.  Reruns agree.  Extra columns are ignored.
    """
    spark = docs.sparkSession
    tmp = Scratch(spark, "mixing")
    alike = docs.select("doc_id", "source", words(F.col("text")).alias("size")).groupBy("doc_id", "source", "size")
    rows = tmp.save(alike.agg(F.count(F.lit(1)).alias("same")).withColumn("h", shuffled(F.col("doc_id"))), "rows")
    count = rows.agg(F.sum("same")).first()[0] or 0
    bits = max(0, min(32, (count // RANGE_ROWS).bit_length()))
    rows = rows.withColumn("range", F.shiftright(F.conv(F.substring("h", 1, 8), 16, 10).cast("long"), 32 - bits))
    # one row per source and hash range
    ranges = tmp.save(rows.groupBy("source", "range").agg(F.sum(F.col("size") * F.col("same")).alias("words")), "ranges")
    goals = targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")))
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranges.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
                    .join(goals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
                    .select(F.col("source").alias("s"), F.col("range").alias("r"), "ahead", "rank", "source_size", "target", "total"))
    within = (Window.partitionBy("source", "range").orderBy("h", "doc_id", "size")
                    .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    queued = (rows.withColumn("sofar", F.sum(F.col("size") * F.col("same")).over(within))
                  .join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
                  .withColumn("stretch", F.explode(F.sequence(F.lit(0), F.floor((F.col("same") - 1) / STRETCH).cast("long"))))
                  .withColumn("later", F.explode(F.sequence(F.col("stretch") * STRETCH, F.least(F.col("same"), (F.col("stretch") + 1) * STRETCH) - 1)))
                  .withColumn("cum", F.col("ahead") + F.col("sofar") - F.col("later") * F.col("size")))
    queued = tmp.save(queued.select("doc_id", "source", "size", "rank", "source_size", "target", "total", "cum"), "queued")

    def finish(copy: int) -> Column:
        return (copy * F.col("source_size") + F.col("cum")).cast("double") / F.col("target")

    copies = None
    for e in range(COPIES):
        one = queued.where("size > 0").select("size", "total", "rank", "cum", F.lit(e).alias("copy"), finish(e).alias("v"))
        copies = one if copies is None else copies.union(one)
    copies = copies.withColumn("bucket", F.floor(F.col("v") * (1 << bits)))
    hist = copies.groupBy("bucket").agg(F.sum("size").alias("words"), F.max("total").alias("total"))
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (hist.withColumn("upto", F.sum("words").over(upto))  # one row per bucket
               .where(F.col("upto") * 100 > F.col("total") * PERCENT)
               .orderBy("bucket").select("bucket", (F.col("upto") - F.col("words")).alias("before")).first())
    last = None
    if cut is not None:
        order = Window.partitionBy("bucket").orderBy("v", "rank", "copy", "cum").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        last = (copies.where(F.col("bucket") == cut["bucket"])  # one bucket's rows
                      .withColumn("upto", F.lit(cut["before"]) + F.sum("size").over(order))
                      .where(F.col("upto") * 100 <= F.col("total") * PERCENT)
                      .agg(F.max(F.struct("v", "rank", "copy", "cum")).alias("at")).first()["at"])

    def taken(copy: int) -> Column:
        if cut is None:
            return F.lit(True)
        v = finish(copy)
        below = F.floor(v * (1 << bits)) < cut["bucket"]
        if last is None:
            return below
        at = F.struct(v.alias("v"), F.col("rank"), F.lit(copy).alias("copy"), F.col("cum"))
        return below | (at <= F.struct(F.lit(last["v"]).alias("v"), F.lit(last["rank"]).alias("rank"),
                                       F.lit(last["copy"]).alias("copy"), F.lit(last["cum"]).cast("long").alias("cum")))

    times = sum((F.when(taken(e), 1).otherwise(0) for e in range(COPIES)), F.lit(0))
    return queued.select("doc_id", "source", "size", "source_size", "target",
                         F.when(F.col("size") > 0, F.col("size") * times).otherwise(F.lit(0)).cast("long").alias("taken"))


def take(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that the mix takes, a row taken twice twice; columns unchanged.

    Rows are matched to the mix by id, source and size; equal rows are told
    apart by their number, so repeated rows are taken as often as decided.
    """
    key, found = ["doc_id", "source", "size"], ["_id", "_source", "_size"]
    decided = mix(docs).groupBy(*key).agg(F.sum("taken").alias("words"), F.count(F.lit(1)).alias("same"))
    tmp = Scratch(docs.sparkSession, "mixing_taken")
    decided = tmp.save(decided.where("words > 0").select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"),
        (F.col("words") / F.col("size")).cast("long").alias("_copies"), F.col("same").alias("_same")), "decided")
    sized = docs.select(*[docs[c] for c in docs.columns], words(docs["text"]).alias("_words"))

    def rows_of(some: DataFrame) -> DataFrame:
        return sized.join(some, sized["doc_id"].eqNullSafe(F.col("_id")) & sized["source"].eqNullSafe(F.col("_source"))
                          & (F.col("_words") == F.col("_size")))

    def copied(rows: DataFrame, times: Column) -> DataFrame:
        rows = rows.select(*docs.columns, times.alias("_n")).where("_n > 0")
        return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).select(*docs.columns)

    single = copied(rows_of(decided.where("_same = 1")), F.col("_copies"))
    repeated = decided.where("_same > 1")
    if not repeated.limit(1).count():
        return single
    # rows alike are numbered within tasks of sorted ranges, shifted by their count in the tasks before
    order = [*found, "_hash"]
    alike = tmp.save(rows_of(repeated).withColumn("_hash", F.xxhash64("text")).repartitionByRange(*order)
                           .sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id()), "alike")
    alike = alike.withColumn("_task", F.shiftright("_row", 33))
    ahead = Window.partitionBy(*found).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = alike.groupBy(*found, "_task").agg(F.min("_row").alias("first"), F.count(F.lit(1)).alias("n"))
    starts = starts.select(*[F.col(c).alias(f"{c}2") for c in [*found, "_task"]], (F.coalesce(F.sum("n").over(ahead), F.lit(0)) - F.col("first")).alias("_shift"))
    same = [F.col(c).eqNullSafe(F.col(f"{c}2")) for c in [*found, "_task"]]
    many = alike.join(starts, same).withColumn("_k", F.col("_row") + F.col("_shift"))
    more = F.when(F.col("_k") < F.col("_copies") % F.col("_same"), 1).otherwise(0)
    return single.unionByName(copied(many, F.floor(F.col("_copies") / F.col("_same")) + more))
