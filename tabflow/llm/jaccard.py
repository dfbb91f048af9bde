"""N-gram Jaccard join: size-aware heavy-light join of shingle sets.

Two documents link when their sets of ``k``-word shingles overlap by at
least ``percent`` / 100 of their union.  The join is exact:

* Sets are reduced to classes of equal sets first, so thousands of copies
  cost as much as one text.
* All shingles have one global order, rarest first.  The order comes from a
  count sketch of fixed size, so frequent shingles (shared passages) come
  last without any list of them.  If two sets link, their leading parts
  ("prefixes") of ``n - ceil(t n) + c`` shingles share at least c members.
* Light sets (at most ``boundary`` shingles) post the pairs (subsets of
  fixed size c = 2) of their prefix, heavy sets the single members (inverted
  lists, c = 1); sets just below the boundary post both, because they can
  link with sets above it.  The boundary minimises the estimated cost
  of rows posted and lists scanned.
* Lists are not expanded into pairs.  Every list names up to four pivots
  (the ends of two orders of its classes), and members are compared with
  those; the member nearest to a pivot then takes the pivot's place, a few
  times.  Links found join classes into components.  Only then, and only in
  lists that still span several components, members outside the first
  pivot's component meet those that they share a member of the pair's own
  prefixes with, as every linking pair does.

Shingles are 64-bit hashes; sketch and bit tables have a fixed size.
"""

from __future__ import annotations

import ctypes
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.llm.components import connected_components
from tabflow.llm.scratch import Scratch
from tabflow.llm.text import PHI, blank_words, mix, shingle_set

#: log2 of the counters of the sketch (8 MB sent to tasks) and of the bits of a bit table (1 MB).
SKETCH_BITS, TABLE_BITS = 21, 23
#: Turns the order of class names into another one (fixed value).
FLIP = 0x5A3C96E1B47D280F
#: How often pivots are replaced by better ones.
HUBS = 3
#: Largest size that is considered for the light side.
MOST_LIGHT = 64


def class_of(shingles: np.ndarray) -> int:
    """Signed 64-bit name of a set; equal sets have equal names."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def _give_back() -> None:
    """Returns a worker's freed memory to the system: workers are kept for later stages, and what they hold counts."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def _texts(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[int, np.ndarray]]:
    for batch in batches:
        for i, t in enumerate(batch.column("t")):
            yield i, shingle_set(blank_words(t.as_py()), k)
        del batch
        _give_back()


def _tree_sum(rows: DataFrame, column: str, kind: type, parts: int, combine=np.add) -> np.ndarray | None:
    """Elementwise combination of one compressed array a row, sixteen to one until few are left."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for v in batch.column(column):
                x = np.frombuffer(zlib.decompress(v.as_py()), kind)
                total = x.copy() if total is None else combine(total, x, out=total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], [column])

    rows = rows.select(column)
    while parts > 8:
        parts = -(-parts // 16)
        rows = rows.repartition(parts).mapInArrow(merge, f"{column} binary")
    out = None
    for r in rows.toLocalIterator():
        x = np.frombuffer(zlib.decompress(r[0]), kind)
        out = x.copy() if out is None else combine(out, x, out=out)
    return out


def summarise(docs: DataFrame, k: int) -> DataFrame:
    """One row per document (``doc_id, n, cls``) and one sketch row per task:
    compressed counters of shingles by their low bits."""
    mask = np.uint64((1 << SKETCH_BITS) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, waiting = np.zeros(1 << SKETCH_BITS, np.uint32), [], 0
        names = ["doc_id", "n", "cls", "sketch"]
        for batch in batches:
            n, cls = [], []
            for _, s in _texts(iter([batch]), k):
                n.append(len(s))
                cls.append(class_of(s))
                held.append((s & mask).astype(np.int32))
                waiting += len(s)
                if waiting > 1 << 20:
                    counts += np.bincount(np.concatenate(held), minlength=1 << SKETCH_BITS).astype(np.uint32)
                    held, waiting = [], 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int32()), pa.array(cls, pa.int64()),
                 pa.nulls(len(n), pa.binary())], names)
        if held:
            counts += np.bincount(np.concatenate(held), minlength=1 << SKETCH_BITS).astype(np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()),
             pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary())], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("t")).mapInArrow(
        run, "doc_id long, n int, cls long, sketch binary")


def prefix_length(n: int, percent: int, c: int) -> int:
    """Leading shingles of a set of ``n`` of which any linking set shares ``c``."""
    return min(n, n - (percent * n + 99) // 100 + c)


def least_met(na: Column, nb: Column, percent: int, boundary: int) -> Column:
    """Shared prefix members that a linking pair must have at least.

    Shared shingles up to the earlier prefix end are in both prefixes; all
    others lie behind one set's prefix.  So a pair that needs an overlap of o
    shares at least o minus the longer rest.  Light pairs meet in subsets,
    whose number is not compared: one is enough.
    """
    need = F.ceil(percent * (na + nb) / (100 + percent)) - F.ceil(percent * F.greatest(na, nb) / 100) + 1
    return F.when(F.greatest(na, nb) > boundary, F.greatest(need, F.lit(1))).otherwise(1)


def choose_boundary(sizes: dict[int, int], sketch: np.ndarray, percent: int) -> int:
    """Largest light size: least estimated cost over all boundaries.

    A posted row costs 1.  A heavy set also scans the lists of its prefix; a
    list's expected length is the load that a shingle meets in the sketch
    beyond the mean load.  ``sizes`` counts classes by size up to
    ``MOST_LIGHT``.  Only the cost depends on this, never the result.
    """
    load = sketch.astype(float)
    total = load.sum()
    scan = max(1.0, (load * load).sum() / total - total / len(load)) if total else 1.0
    best, least = 0, math.inf
    for x in range(0, MOST_LIGHT + 1):
        cost = 0.0
        for n, many in sizes.items():
            if 1 < n <= x:
                p = prefix_length(n, percent, 2)
                cost += many * p * (p - 1) / 2
            if n > x or 100 * n >= percent * (x + 1):
                cost += many * prefix_length(n, percent, 1) * (scan if n > x else 1.0)
        if cost < least:
            best, least = x, cost
    return best


def postings(docs: DataFrame, sketch: np.ndarray, k: int, percent: int, boundary: int, table: np.ndarray | None) -> DataFrame:
    """``sig, cls, n, pos``: what each class posts and where in its order (of
    a subset: its last member, less one); with ``table`` only signatures
    whose bit is set."""
    loads = sketch.astype(np.uint32)
    mask = np.uint64((1 << SKETCH_BITS) - 1)

    def signatures(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(s)
        order = np.lexsort((s, loads[(s & mask).astype(np.int64)]))
        parts, places = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        if 1 < n <= boundary:
            p = s[order[:prefix_length(n, percent, 2)]]
            i, j = np.triu_indices(len(p), 1)
            parts.append(mix(p[i] * np.uint64(PHI) + p[j]))
            places.append(j - 1)
        if n > boundary or 100 * n >= percent * (boundary + 1):
            parts.append(s[order[:prefix_length(n, percent, 1)]])
            places.append(np.arange(len(parts[-1])))
        return np.concatenate(parts), np.concatenate(places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # classes of this task, at most a scan task's rows
        sig, cls, n, pos, waiting = [], [], [], [], 0
        names = ["sig", "cls", "n", "pos"]

        def flush() -> pa.RecordBatch:
            arrays = [np.concatenate(sig).view(np.int64), np.concatenate(cls), np.concatenate(n), np.concatenate(pos).astype(np.int32)]
            return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names)

        for _, s in _texts(batches, k):
            if not len(s):
                continue
            c = class_of(s)
            if c in seen:
                continue
            seen.add(c)
            own, places = signatures(s)
            if table is not None:
                some = _bit(table, own)
                own, places = own[some], places[some]
            sig.append(own)
            pos.append(places)
            cls.append(np.full(len(own), c, np.int64))
            n.append(np.full(len(own), len(s), np.int32))
            waiting += len(own)
            if waiting > 1 << 17:
                yield flush()
                sig, cls, n, pos, waiting = [], [], [], [], 0
        if waiting:
            yield flush()

    return docs.select(F.col("text").cast("binary").alias("t")).mapInArrow(run, "sig long, cls long, n int, pos int")


def _bit(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys have their bit set."""
    at = (mix(keys) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def bit_table(keys: DataFrame, column: str) -> np.ndarray:
    """Fixed-size table with a bit set for every key (others may share a bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << TABLE_BITS, bool)
        for batch in batches:
            ks = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            bits[(mix(ks) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)], pa.binary())], ["bits"])

    own = keys.select(column)
    tables = own.mapInArrow(run, "bits binary")
    found = _tree_sum(tables, "bits", np.uint8, max(1, own.rdd.getNumPartitions()), np.bitwise_or)
    return np.zeros((1 << TABLE_BITS) // 8, np.uint8) if found is None else found


def sets_of(docs: DataFrame, k: int, table: np.ndarray) -> DataFrame:
    """``cls, shingles`` (sorted uint64 as bytes) of classes whose bit is set in ``table``; once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        cls, sets, waiting = [], [], 0
        for _, s in _texts(batches, k):
            c = class_of(s)
            if c in seen or not len(s) or not _bit(table, np.array([c], np.int64).view(np.uint64))[0]:
                continue
            seen.add(c)
            cls.append(c)
            sets.append(s.tobytes())
            waiting += len(s)
            if waiting > 1 << 18:
                yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(sets, pa.binary())], ["cls", "shingles"])
                cls, sets, waiting = [], [], 0
        if cls:
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(sets, pa.binary())], ["cls", "shingles"])

    return docs.select(F.col("text").cast("binary").alias("t")).mapInArrow(run, "cls long, shingles binary")


@F.pandas_udf(T.LongType())
def _overlap(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                      for x, y in zip(a, b)], dtype="int64")


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, na, nb, common`` for pairs of classes; a hot side is split by AQE, as both sides are fresh scans."""
    left = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb"))
    size = F.length("sa") / 8, F.length("sb") / 8
    return (pairs.join(left, "a").join(right, "b")
                 .select("a", "b", size[0].cast("long").alias("na"), size[1].cast("long").alias("nb"),
                         _overlap("sa", "sb").alias("common")))


def link_classes(docs: DataFrame, summary: DataFrame, sketch: np.ndarray, tmp: Scratch, k: int = 5, percent: int = 75) -> DataFrame:
    """``node, component`` of classes that link with another class."""
    small = {r["n"]: r["c"] for r in summary.where(F.col("n").between(1, MOST_LIGHT))
             .groupBy("n").agg(F.count_distinct("cls").alias("c")).collect()}  # at most MOST_LIGHT rows
    boundary = choose_boundary(small, sketch, percent)
    fits = lambda x, y: 100 * F.least(x, y) >= percent * F.greatest(x, y)

    # lists with two classes or more
    shared = tmp.save(postings(docs, sketch, k, percent, boundary, None)
                      .groupBy("sig").agg(F.min("cls").alias("p0"), F.max("cls").alias("p1"))
                      .where("p0 <> p1"), "shared")
    table = bit_table(shared, "sig")
    member = tmp.save(postings(docs, sketch, k, percent, boundary, table)
                      .join(shared, "sig").groupBy("sig", "cls", "n", "p0", "p1").agg(F.min("pos").alias("pos")), "member")
    tmp.drop("shared")
    flipped = F.col("cls").bitwiseXOR(F.lit(FLIP))  # another order of the classes
    ends = member.groupBy("sig").agg(F.min(flipped).bitwiseXOR(F.lit(FLIP)).alias("p2"), F.max(flipped).bitwiseXOR(F.lit(FLIP)).alias("p3"))
    pivots = F.array_distinct(F.array("p0", "p1", "p2", "p3"))
    sizes = summary.select("cls", "n").distinct()

    def promising(pairs: DataFrame) -> DataFrame:
        """``a, b`` of rows ``a, b, na, nb, met`` that may link."""
        return pairs.where(fits(F.col("na"), F.col("nb")) & (F.col("met") >= least_met(F.col("na"), F.col("nb"), percent, boundary))).select("a", "b")

    def sets_for(pairs: DataFrame, name: str) -> DataFrame:
        both = pairs.select(F.col("a").alias("cls")).union(pairs.select("b"))
        return tmp.save(sets_of(docs, k, bit_table(both, "cls")).dropDuplicates(["cls"]), name)

    linked = 100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))
    share = F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))
    stars = (member.select("sig", "cls", "n", "p0", "p1").join(ends, "sig")
                   .select(F.col("cls").alias("a"), F.col("n").alias("na"), F.explode(pivots).alias("b")).where("a <> b")
                   .groupBy("a", "b", "na").agg(F.count(F.lit(1)).alias("met"))
                   .join(sizes.select(F.col("cls").alias("b"), F.col("n").alias("nb")), "b"))
    stars = tmp.save(promising(stars), "stars")
    sets = sets_for(stars, "sets")
    near = step = tmp.save(compare(stars, sets), "near0")
    for r in range(1, HUBS + 1):  # the member nearest to a pivot is nearer to most others than the pivot: a better pivot
        step = step.withColumn("linked", linked)
        hub = step.groupBy("b").agg(F.max_by(F.struct("a", "linked"), share).alias("hub"))
        # members linked to the pivot are in the hub's component already if the hub is
        again = (step.join(hub, "b").where("a <> hub.a and not (linked and hub.linked)")
                     .select("a", F.col("hub.a").alias("b")).distinct())
        tried = near.select("a", "b").union(near.select("b", "a"))
        step = tmp.save(compare(again.join(tried, ["a", "b"], "left_anti"), sets), f"near{r}")
        near = near.union(step)
    tmp.drop("sets", "stars")
    links = near.where(linked).select("a", "b")
    comps = connected_components(links)

    # lists that still span several components: pairs with a member outside the home of the list, its first pivot's component
    placed = (member.select("sig", "cls", "n", "pos", (F.col("cls") == F.col("p0")).alias("first")).join(comps.select(F.col("node").alias("cls"), "component"), "cls", "left")
                    .withColumn("component", F.coalesce("component", "cls")))
    placed = tmp.save(placed, "placed")
    tmp.drop("member")
    mixed = (placed.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                       F.min(F.when(F.col("first"), F.col("component"))).alias("home"))
                   .where("lo <> hi").select("sig", "home"))
    rest = tmp.save(placed.join(mixed, "sig").select("sig", "cls", "n", "pos", "component", "home"), "rest")
    tmp.drop("placed")
    x, y = rest.where("component <> home").alias("x"), rest.alias("y")
    # the pair's own prefixes: a linking pair has an overlap of o and so meets within the first n - o + 1 of both
    o = F.ceil(percent * (F.col("x.n") + F.col("y.n")) / (100 + percent))
    cross = x.join(y, (F.col("x.sig") == F.col("y.sig")) & (F.col("x.component") != F.col("y.component"))
                   & (F.col("x.pos") <= F.col("x.n") - o) & (F.col("y.pos") <= F.col("y.n") - o)
                   & ((F.col("y.component") == F.col("x.home")) | (F.col("x.cls") < F.col("y.cls"))))
    cross = cross.select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")).distinct()
    tried = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    cross = tmp.save(cross.join(tried, ["a", "b"], "left_anti"), "cross")
    if cross.limit(1).count():
        more = tmp.save(compare(cross, sets_for(cross, "sets")).where(linked).select("a", "b"), "more")
        tmp.drop("sets")
        if more.limit(1).count():
            comps = connected_components(links.union(more))
    tmp.drop("rest", "cross")
    return comps


def near_duplicate_groups(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (``doc_id, text``).

    ``component_id`` is the smallest id reachable by links.  Texts without
    words, null ones included, have an empty set and link with nothing;
    texts with fewer than ``k`` words have one shingle, the whole sequence.
    Repeated rows are copies of each other; rows sharing an id but not a
    text are separate.  A null id is kept and is named by others' ids only.
    Extra columns are ignored.
    """
    return _groups(docs, k, percent).drop("cls")


def _groups(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The columns of ``near_duplicate_groups`` and ``cls``, the class of the row's set."""
    tmp = Scratch(docs.sparkSession, "jaccard")
    both = tmp.save(summarise(docs, k), "summary")
    summary = both.where("sketch is null").select("doc_id", "n", "cls")
    tasks = both.where("sketch is not null")
    sketch = _tree_sum(tasks, "sketch", np.uint32, max(1, tasks.rdd.getNumPartitions()))
    if sketch is None:
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
    comps = link_classes(docs, summary, sketch, tmp, k, percent)
    placed = (summary.join(comps.select(F.col("node").alias("cls"), "component"), "cls", "left")
                     .withColumn("component", F.when(F.col("n") > 0, F.coalesce("component", "cls"))))
    placed = tmp.save(placed, "documents")
    # written, so that the join has two fresh sides and a component of many documents can be split
    first = tmp.save(placed.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("first")), "first")
    return (placed.join(first, "component", "left")
                  .select("doc_id", "cls", F.col("n").cast("long").alias("n_shingles"),
                          F.coalesce("first", "doc_id").alias("component_id")))


def keep_one_each(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: that of the
    smallest id.  Rows sharing an id are decided one by one, by their own
    group.  Rows without words or without an id stay.  All columns are
    unchanged."""
    drop = _groups(docs, k, percent).where("doc_id <> component_id").select(F.col("doc_id").alias("_d"), F.col("cls").alias("_c")).distinct()

    @F.pandas_udf("long")
    def own_class(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: class_of(shingle_set(blank_words(t), k)))

    own = docs.select(*[docs[c] for c in docs.columns], own_class(docs["text"].cast("binary")).alias("_own"))
    return own.join(drop, (own["doc_id"] == F.col("_d")) & (F.col("_own") == F.col("_c")), "left_anti").select(*docs.columns)
