"""Embedding near-dedup by sorted projection passes.

Equal vectors are one class.  Each pass orders all classes
lexicographically by concatenated random hashes (signs of random
projections) and compares every class with the ``window`` before it in that
order; verified pairs are united across passes.  A pass ships 16-bit codes of
the unit vectors with the length of what rounding took away, which bounds the
cosine from both sides: pairs surely at the threshold are united at once, and
the few whose bounds straddle it are settled on the vectors in double
precision.  The sorted ranges are compared as they stream by; only the rows at
the ends of ranges go on to a further, smaller round.  A batch has as many passes
as bring a pair exactly at the threshold together with ``recall`` where
directions are spread evenly.  In a crowded direction most bits are equal and
pairs meet more rarely, so batches with fresh projections follow until one
unites nothing new.

Groups of more near copies than a window would show only part of their
links, so links are counted exactly afterwards: members of a component are
dealt into blocks (those of a component of several blocks in the order of a
projection key, so that blocks hold neighbours), blocks that lie wholly within or beyond the threshold of
each other (by the triangle inequality of angles) count at once, and only
the others are compared.  No pairs are emitted, only counts and one edge a
row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tabflow.llm.components import connected_components
from tabflow.llm.scratch import Scratch


@dataclass(frozen=True)
class PassParams:
    """``window`` rows are compared before each row; ``block`` rows go to one
    task call; ``bits`` random hashes are concatenated; ``recall`` is aimed
    at for pairs at the threshold; ``seed`` draws the projections."""

    threshold: float = 0.9
    window: int = 128
    block: int = 1024
    bits: int = 48
    recall: float = 0.97
    seed: int = 7

    def passes(self, rows: int) -> int:
        """Passes after which a pair at the threshold has met with ``recall``:
        it meets in a pass if it agrees on the bits that separate windows.
        Holds for directions spread evenly; ``near_duplicates`` repeats such batches."""
        needed = max(0.0, math.log2(max(1, rows) / self.window))
        meet = (1 - math.acos(self.threshold) / math.pi) ** needed
        return 1 if meet >= self.recall else math.ceil(math.log(1 - self.recall) / math.log(1 - meet))


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows as unit vectors; scaled by a power of two first, so that no square overflows."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return x / np.linalg.norm(x, axis=1)[:, None]


def _units(vectors: list[bytes]) -> np.ndarray:
    return _unit(np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1))


def _by_dim(lists: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``dim, rows, unit vectors`` of an array column, one dimension at a time."""
    values = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64)
    lengths = np.asarray(pc.list_value_length(lists).to_numpy(zero_copy_only=False), np.int64)
    starts = np.cumsum(lengths) - lengths
    for dim in np.unique(lengths):
        own = np.flatnonzero(lengths == dim)
        yield int(dim), own, _unit(values[starts[own][:, None] + np.arange(dim)])


def _code_type(dim: int) -> np.dtype:
    """A code: ``s * q`` is the unit vector but for a rest of length ``e``."""
    return np.dtype([("s", "<f8"), ("e", "<f8"), ("q", "<i2", (dim,))])


def _codes(x: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), _code_type(x.shape[1]))
    out["s"] = np.abs(x).max(axis=1) / 32767
    out["q"] = np.rint(x / out["s"][:, None])
    out["e"] = np.linalg.norm(x - out["q"] * out["s"][:, None], axis=1)
    return out


def _binary(codes: np.ndarray) -> pa.Array:
    offsets = np.arange(len(codes) + 1, dtype=np.int32) * codes.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer(offsets), pa.py_buffer(codes.tobytes())])


def _planes(p: PassParams, dim: int, batch: int, passes: int) -> np.ndarray:
    return np.random.default_rng([p.seed, dim, batch] if batch else [p.seed, dim]).standard_normal((dim, passes * p.bits))


def _sorted_keys(x: np.ndarray, planes: np.ndarray, bits: int) -> np.ndarray:
    """A row's hashes of each pass as one integer that sorts lexicographically."""
    signs = ((x @ planes) > 0).reshape(len(x), -1, bits)
    return signs.astype(np.int64) @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))


KEYED = "turn int, dim int, key long, id long, v binary"


def _keys(passes: int, p: PassParams, batch: int = 0):
    """One row a pass of a batch and vector: where it sorts, and its code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for rows in batches:
            ids = rows.column("id").to_numpy(zero_copy_only=False)
            for dim, own, x in _by_dim(rows.column("v")):
                if dim not in planes:
                    planes[dim] = _planes(p, dim, batch, passes)
                keys, codes = _sorted_keys(x, planes[dim], p.bits), _binary(_codes(x))
                for k in range(passes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), k, np.int32)), pa.array(np.full(len(own), dim, np.int32)),
                         pa.array(np.ascontiguousarray(keys[:, k])), pa.array(ids[own]), codes], ["turn", "dim", "key", "id", "v"])

    return run


def _joined(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index connected to each of ``n`` rows by the links ``i, j``."""
    label = np.arange(n)
    while len(i):
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (label == before).all():
            break
    return label


def _window_links(codes: np.ndarray, known: int, p: PassParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``i, j, sure`` of rows ``i >= known`` and rows ``j`` at most a window before, unless surely below the threshold."""
    dim, e = codes.dtype["q"].shape[0], codes["e"]
    u = (codes["q"] * codes["s"][:, None]).astype(np.float32)
    slack = 1e-6 + 2.4e-7 * dim  # of sums in single precision
    widest = 2 * e.max() + 3 * e.max() ** 2 + slack
    found = []
    for start in range(known, len(codes), p.window):
        low = max(0, start - p.window)
        dots = u[start:start + p.window] @ u[low:start + p.window].T
        i, j = np.nonzero(dots >= p.threshold - widest)
        dot, i, j = dots[i, j].astype(np.float64), i + start, j + low
        bound = e[i] + e[j] + 3 * e[i] * e[j] + slack
        fits = (j < i) & (i - j <= p.window) & (dot >= p.threshold - bound)
        found.append((i[fits], j[fits], (dot >= p.threshold + bound)[fits]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    return tuple(np.concatenate(c) for c in zip(*found))


COMPARED = "sure boolean, a long, b long, turn int, dim int, key long, v binary"


def _compare(p: PassParams):
    """Over one sorted range: edges ``a, b`` (``sure``, or yet to be settled),
    and, with null ``sure`` and ``b``, the window of rows at either end."""

    def edges(sure: bool, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        none = [pa.nulls(len(a), t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), sure)), pa.array(a), pa.array(b), *none], NAMES)

    def border(t: pa.Table) -> list[pa.RecordBatch]:
        cols = [pa.nulls(len(t), pa.bool_()), t["id"], pa.nulls(len(t), pa.int64()), t["turn"], t["dim"], t["key"], t["v"]]
        return pa.table(cols, names=NAMES).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = pa.Table.from_batches([batch])
            if seen < p.window:
                yield from border(fresh.slice(0, p.window - seen))
            known = len(carry) if carry is not None else 0
            rows = (pa.concat_tables([carry, fresh]) if known else fresh).combine_chunks()
            seen += len(fresh)
            ids, turn, dim = (rows[c].to_numpy() for c in ("id", "turn", "dim"))
            v = rows["v"].chunk(0)
            at = np.frombuffer(v.buffers()[1], np.int32)[v.offset:v.offset + len(v) + 1]
            data = np.frombuffer(v.buffers()[2], np.uint8)
            cuts = np.flatnonzero((np.diff(turn) != 0) | (np.diff(dim) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(rows)]):
                if hi <= known:
                    continue
                codes = np.frombuffer(data[at[lo]:at[hi]].tobytes(), _code_type(int(dim[lo])))
                i, j, sure = _window_links(codes, max(0, known - lo), p)
                label, own = _joined(hi - lo, i[sure], j[sure]), ids[lo:hi]
                moved = np.flatnonzero(label != np.arange(hi - lo))
                yield edges(True, own[moved], own[label[moved]])
                i, j = i[~sure], j[~sure]
                apart = label[i] != label[j]  # united already otherwise
                yield edges(False, own[i[apart]], own[j[apart]])
            carry = rows.slice(max(0, len(rows) - p.window))
        if carry is not None and seen > p.window:  # without what went out as the beginning
            yield from border(carry.slice(max(0, len(carry) - (seen - p.window))))

    return run


NAMES = ["sure", "a", "b", "turn", "dim", "key", "v"]


def _settled(p: PassParams):
    """Of pairs with both vectors, those at the threshold in double precision."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            near = [float((_unit(np.asarray([x], np.float64)) @ _unit(np.asarray([y], np.float64)).T)[0, 0]) >= p.threshold
                    for x, y in zip(pdf["va"], pdf["vb"])]
            yield pdf.loc[np.asarray(near, bool), ["a", "b"]]

    return run


def _angle(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ y.T, -1, 1))


def _ball(pdf: pd.DataFrame) -> pd.DataFrame:
    """A block's centre, radius and number of vectors."""
    x = _units(list(pdf["v"]))
    c = x.sum(axis=0)
    c = c / (np.linalg.norm(c) or 1.0)
    return pd.DataFrame({"component": [pdf["component"].iloc[0]], "block": [pdf["block"].iloc[0]],
                         "centre": [c.tobytes()], "radius": [float(_angle(x, c[None, :]).max())], "n": [int(pdf["size"].sum())]})


def _count_inside(p: PassParams):
    """Links of each row within its own block, weighted by class size."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in pdf.groupby(["component", "block"], sort=True):
            x = _units(list(part["v"]))
            near = x @ x.T >= p.threshold
            np.fill_diagonal(near, False)
            out.append(pd.DataFrame({"id": part["id"].to_numpy(), "links": near @ part["size"].to_numpy()}))
        return pd.concat(out)

    return run


def _count_across(p: PassParams):
    """Links between the rows of two blocks, weighted by class size."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        near = _units(list(a["v"])) @ _units(list(b["v"])).T >= p.threshold
        return pd.DataFrame({"id": np.concatenate([a["id"], b["id"]]),
                             "links": np.concatenate([near @ b["size"].to_numpy(), near.T @ a["size"].to_numpy()])})

    return run


def _one_key(p: PassParams):
    """Members with the key of a first pass."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for width, part in pdf.groupby(pdf["v"].map(len)):
                x = _units(list(part["v"]))
                yield part.assign(key=_sorted_keys(x, _planes(p, width // 8, 0, 1), p.bits)[:, 0])

    return run


def _links_in_components(members: DataFrame, p: PassParams, tmp: Scratch) -> DataFrame:
    """``id, links`` of ``component, id, v, size``: members at the threshold or above, exactly."""
    total = members.groupBy("component").agg(F.count(F.lit(1)).alias("m"))
    sized = members.join(total, "component").withColumn("blocks", F.ceil(F.col("m") / p.block)).drop("m")
    order = ["component", "key", "id"]
    ranged = tmp.save(sized.where("blocks > 1").mapInPandas(_one_key(p), "component long, id long, v binary, size long, blocks long, key long")
                           .repartitionByRange(*order).sortWithinPartitions(*order)
                           .withColumn("_row", F.monotonically_increasing_id()), "ranged")
    # rows numbered within a component: within tasks, shifted by the component's rows in the tasks before
    task = F.shiftright("_row", 33)
    firsts = ranged.groupBy("component", task.alias("task")).agg(F.min("_row").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("component").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    big = ranged.withColumn("task", task).join(firsts, ["component", "task"]).withColumn(
        "block", F.floor((F.col("_row") - F.col("first") + F.col("start")) / p.block).cast("int"))
    columns = ["component", "block", "id", "v", "size", "blocks"]
    dealt = tmp.save(sized.where("blocks = 1").withColumn("block", F.lit(0)).select(*columns).union(big.select(*columns)), "dealt")
    tmp.drop("ranged")
    packs = max(1, dealt.count() // (4 * p.block))  # whole blocks, some thousand rows together
    inside = (dealt.groupBy(F.pmod(F.xxhash64("component", "block"), F.lit(packs)).alias("pack"))
                   .applyInPandas(_count_inside(p), "id long, links long"))
    # only components of several blocks
    balls = tmp.save(dealt.where("blocks > 1").groupBy("component", "block").applyInPandas(
        _ball, "component long, block int, centre binary, radius double, n long"), "balls")
    limit = math.acos(p.threshold)

    @F.pandas_udf("string")
    def relation(ca: pd.Series, ra: pd.Series, cb: pd.Series, rb: pd.Series) -> pd.Series:
        out = []
        for x, r, y, s in zip(ca, ra, cb, rb):
            apart = float(_angle(np.frombuffer(x)[None, :], np.frombuffer(y)[None, :])[0, 0])
            out.append("all" if apart + r + s <= limit - 1e-9 else "none" if apart - r - s > limit + 1e-9 else "some")
        return pd.Series(out, dtype=object)

    x, y = balls.alias("x"), balls.alias("y")
    pairs = x.join(y, (F.col("x.component") == F.col("y.component")) & (F.col("x.block") < F.col("y.block")))  # blocks, not rows
    pairs = tmp.save(pairs.select(F.col("x.component").alias("component"), F.col("x.block").alias("i"), F.col("y.block").alias("j"),
                                  F.col("x.n").alias("ni"), F.col("y.n").alias("nj"),
                                  relation("x.centre", "x.radius", "y.centre", "y.radius").alias("how")), "pairs")
    sure = pairs.where("how = 'all'")
    sure = (sure.select("component", F.col("i").alias("block"), F.col("nj").alias("n"))
                .union(sure.select("component", "j", "ni")).groupBy("component", "block").agg(F.sum("n").alias("links")))
    whole = dealt.join(sure, ["component", "block"]).select("id", "links")
    some = pairs.where("how = 'some'")
    sides = (some.select("component", "i", "j", F.col("i").alias("block"), F.lit(0).alias("side"))
                 .union(some.select("component", "i", "j", F.col("j"), F.lit(1))))
    across = (dealt.join(sides, ["component", "block"]).groupBy("component", "i", "j")
                   .applyInPandas(_count_across(p), "id long, links long"))
    return inside.union(whole).union(across).groupBy("id").agg(F.sum("links").alias("links"))


#: Rows of range ends that a range of the next round holds, about.
BORDER_ROWS = 50_000


def _pass_edges(classes: DataFrame, passes: int, batch: int, p: PassParams, tmp: Scratch) -> DataFrame:
    """``a, b``: what the passes of a batch unite, at most one edge a row and pass beside what was unsure."""
    rows = classes.mapInArrow(_keys(passes, p, batch), KEYED)
    order, parts, depth, edges = ["turn", "dim", "key", "id"], None, 0, None
    while True:
        ranged = rows.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order)
        out = tmp.save(ranged.mapInArrow(_compare(p), COMPARED), f"compared{batch}_{depth}")
        found = out.where("sure is not null").select("sure", "a", "b")
        edges = found if edges is None else edges.union(found)
        if parts == 1:
            break
        rows = out.where("sure is null").select("turn", "dim", "key", F.col("a").alias("id"), "v")
        parts, depth = max(1, rows.count() // BORDER_ROWS), depth + 1
    edges = tmp.save(edges.distinct(), f"edges{batch}")
    for k in range(depth + 1):
        tmp.drop(f"compared{batch}_{k}")
    unsure = edges.where("not sure").select("a", "b")
    if not unsure.limit(1).count():
        return edges.select("a", "b")
    for side in "ab":
        unsure = unsure.join(classes.select(F.col("id").alias(side), F.col("v").alias(f"v{side}")), side)
    settled = unsure.select("a", "b", "va", "vb").mapInPandas(_settled(p), "a long, b long")
    return tmp.save(edges.where("sure").select("a", "b").union(settled), f"settled{batch}")


def _components(classes: DataFrame, p: PassParams, tmp: Scratch) -> DataFrame:
    """``node, component`` of the classes ``id, v`` that batches of passes unite with others."""
    rows = classes.count()
    passes, batch = p.passes(rows), 0
    comps = connected_components(_pass_edges(classes, passes, batch, p, tmp))
    while rows > p.window + 1 and comps.limit(1).count():  # fewer rows have all been compared
        batch += 1
        edges = _pass_edges(classes, passes, batch, p, tmp)
        for side in "ab":
            top = comps.select(F.col("node").alias(side), F.col("component").alias(f"top_{side}"))
            edges = edges.join(top, side, "left").withColumn(side, F.coalesce(f"top_{side}", side)).drop(f"top_{side}")
        fresh = tmp.save(edges.where("a <> b").distinct(), f"fresh{batch}")
        if not fresh.limit(1).count():
            break
        comps = connected_components(comps.select(F.col("node").alias("a"), F.col("component").alias("b")).union(fresh.select("a", "b")))
    return comps


def near_duplicates(vectors: DataFrame, params: PassParams = PassParams(), vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Null, empty and zero vectors and those with a null, NaN or infinite
    component link with nothing and are their own component; so do rows
    without an id (null component, not kept).  Vectors of different lengths
    never link.  Repeated rows link with each other.  Other columns are
    ignored, whatever their names.
    """
    p = params
    tmp = Scratch(vectors.sparkSession, "vectors")
    kind = vectors.select(embedding).schema[0].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    vec = F.col(embedding) if single else F.col(embedding).cast("array<double>")  # single precision is kept as small as it is
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), vec.alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("v", lambda c: c != 0), F.lit(False))
    named = tmp.save(rows.withColumn("usable", usable).select(
        "vec_id", "usable", F.when(F.col("usable"), F.xxhash64("v")).alias("c1"),
        F.when(F.col("usable"), F.xxhash64(F.lit(1), "v")).alias("c2"), F.when(F.col("usable"), F.col("v")).alias("v")), "named")
    classes = tmp.save(named.where("usable").groupBy("c1", "c2").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("size"), F.first("v").alias("v")), "classes")
    comps = _components(classes.select("id", "v"), p, tmp)
    members = comps.withColumnRenamed("node", "id").join(classes.select("id", "v", "size"), "id")
    as_bytes = F.pandas_udf(_pack, "binary")
    links = _links_in_components(members.select("component", "id", as_bytes("v").alias("v"), "size"), p, tmp)
    by_class = (classes.select("c1", "c2", "id", "size").join(comps.withColumnRenamed("node", "id"), "id", "left").join(links, "id", "left")
                       .select("c1", "c2", F.coalesce("component", "id").alias("component"),
                               (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("links")))
    out = named.select("vec_id", "c1", "c2").join(by_class, ["c1", "c2"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _pack(v: pd.Series) -> pd.Series:
    return v.map(lambda x: np.asarray(x, np.float64).tobytes())
