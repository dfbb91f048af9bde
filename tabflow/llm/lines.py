"""Line dedup: lines repeated across documents lose all but one copy.

Hashes of line keys are range-partitioned and sorted by document (largest
first) and position.  A pass over each sorted range streams first occurrences:
the first row of a key is in the document that keeps it, each new id is one
more document.  A hash bucket with many times the rows of others is cut into
blocks of documents, so one frequent line spreads over as many ranges as its
rows need; only such keys are merged across blocks afterwards.  The result is a
compressed bitmap per document (64 line flags a word, up to its last dropped
line), not text; texts are filtered by it last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.llm.columns import fresh, make_room
from tabflow.llm.scratch import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(" \t\n\x0b\f\r")), UPPER, LOWER)


def split_lines(text: Column) -> Column:
    """Lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


#: Buckets of line hashes whose rows are counted; rows of a bucket beyond which it is cut (and beyond four times the mean).
BUCKETS, BLOCK_ROWS = 1 << 20, 1 << 13


def drop_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``doc_id, h, drops``: for documents losing lines, their id, the hash of
    their text and their dropped lines' flags, 64 to a word, as an array that
    ends with the last word that has one.

    A key of ``min_chars`` code points or more found in ``min_docs`` documents
    or more stays only in the largest ``doc_id`` holding it.  Rows with one id
    count as one document; rows without an id are not counted and lose nothing.
    """
    tmp = Scratch(docs.sparkSession, "lines")
    own = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("h"), split_lines(F.col("text")).alias("lines"))
    lines = own.select("doc_id", "h", F.posexplode("lines").alias("pos", "line"))  # a select of its own: the text is hashed once, not for every line
    keyed = tmp.save(lines.withColumn("line", line_key(F.col("line"))).where(F.length("line") >= min_chars)
                          .select("doc_id", "h", "pos", F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2")), "keys")
    bucket = F.pmod(F.col("k1"), F.lit(BUCKETS))
    sizes = tmp.save(keyed.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")), "sizes")
    bound = F.greatest(F.lit(float(block_rows)), sizes.select(4 * F.avg("n")).scalar())
    hot = sizes.where(F.col("n") > bound).select("bucket", F.ceil(F.col("n") / bound).alias("blocks"))  # at most a quarter of the buckets
    dealt = (keyed.withColumn("bucket", bucket).join(F.broadcast(hot), "bucket", "left")
                  .withColumn("block", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("blocks")), F.lit(-1))).drop("bucket", "blocks"))
    order = ["k1", "k2", "block", F.desc("doc_id"), "pos"]
    ranges = dealt.repartitionByRange("k1", "k2", "block").sortWithinPartitions(*order)
    group = Window.partitionBy("k1", "k2", "block")
    stream = group.orderBy(F.desc("doc_id"), "pos")
    first = F.coalesce(F.lag("doc_id").over(stream) != F.col("doc_id"), F.lit(True))  # first row of a document
    seen = (ranges.select("*", F.first("doc_id").over(stream).alias("keeper"), first.cast("int").alias("new"))
                  .withColumn("n", F.sum("new").over(group)).drop("new"))
    loses = (F.col("n") >= min_docs) & (F.col("doc_id") != F.col("keeper"))
    seen = tmp.save(seen.where((F.col("block") >= 0) | loses), "seen")
    tmp.drop("keys", "sizes")
    # keys cut into blocks: one row a block, merged over the borders
    blocks = seen.where("block >= 0").groupBy("k1", "k2", "block").agg(F.max("n").alias("n"), F.max("keeper").alias("keeper"))
    merged = blocks.groupBy("k1", "k2").agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper")).where(F.col("n") >= min_docs)
    cut = seen.where("block >= 0").drop("n", "keeper").join(merged, ["k1", "k2"]).where(loses)
    own = ["doc_id", "h", F.floor(F.col("pos") / 64).cast("int").alias("word"),
           F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos") % 64).alias("flag")]
    lost = seen.where("block < 0").select(*own).union(cut.select(*own))
    words = lost.groupBy("doc_id", "h", "word").agg(F.bit_or("flag").alias("flags"))
    sparse = words.groupBy("doc_id", "h").agg(F.sort_array(F.collect_list(F.struct("word", "flags"))).alias("words"))

    def filled(entry: Column, i: Column) -> Column:  # the word and the empty words before it
        before = F.when(i > 0, F.get(F.col("words"), i - 1)["word"]).otherwise(F.lit(-1))
        return F.concat(F.array_repeat(F.lit(0).cast("long"), entry["word"] - before - 1), F.array(entry["flags"]))

    return sparse.select("doc_id", "h", F.flatten(F.transform("words", filled)).alias("drops"))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped``, ``drops`` (the bitmap, null
    without drops) and ``kept``, the lines that stay joined by line breaks.

    Null and empty texts are one empty line and stay "".  Repeated rows lose
    the same lines; of rows with one id each loses its own.  Other columns
    are unchanged; one named like an added one has ``input_`` before its name.
    """
    docs = make_room(docs, "n_lines", "n_dropped", "drops", "kept")
    _d, _h, _drops, _key, _lines = fresh([*docs.columns, "n_lines", "n_dropped", "drops", "kept"], "_d", "_h", "_drops", "_key", "_lines")
    bitmaps = drop_bitmaps(docs, min_chars, min_docs).select(F.col("doc_id").alias(_d), F.col("h").alias(_h), F.col("drops").alias(_drops))
    own = docs.select(*[docs[c] for c in docs.columns], F.xxhash64(docs["text"]).alias(_key))
    both = own.join(bitmaps, (own["doc_id"] == F.col(_d)) & (F.col(_key) == F.col(_h)), "left").withColumn(_lines, split_lines(F.col("text")))

    def stays(line: Column, i: Column) -> Column:
        flags = F.coalesce(F.get(F.col(_drops), F.floor(i / 64).cast("int")), F.lit(0).cast("long"))
        return F.getbit(flags, (i % 64).cast("int")) == 0

    lost = F.aggregate(_drops, F.lit(0), lambda n, w: n + F.bit_count(w))
    kept = F.when(F.col(_drops).isNull(), F.coalesce(F.col("text"), F.lit(""))).otherwise(F.array_join(F.filter(_lines, stays), "\n"))
    return both.select(*[f"`{c}`" for c in docs.columns], F.size(_lines).cast("long").alias("n_lines"),
                       F.coalesce(lost, F.lit(0)).cast("long").alias("n_dropped"), F.col(_drops).alias("drops"), kept.alias("kept"))
