"""Toxicity: FTRL-proximal logistic regression over hashed n-grams.

Features are the distinct words, word pairs and pairs with one word between
(skip-grams) of a text, hashed to ``2 ** BITS`` coordinates.  Training keeps
per-coordinate sums (z, n): each coordinate has its own learning rate and
stays exactly zero until its evidence exceeds ``l1``, so a few thousand
weights remain.  The model has a fixed size (``2 ** BITS`` floats, 1 MB)
whatever the data, so it is sent to every task.

Training is spread over shards of the labelled rows.  In each round every
shard continues from the shared sums over its own rows; the mean of the
shards' changes is taken in a task and added to the shared sums.  The driver sees one merged row a round, the coordinates that
changed, and sends the non-zero sums out again as 32-bit floats.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.columns import make_room
from tabflow.llm.text import PHI, alnum_words, hash_words, mix, ngram_hashes
from tabflow.session import checkpoint_root

BITS = 18
#: Odd multiplier that keeps skip-grams apart from pairs (fixed value).
SKIP = 0x632BE59BD9B4E019


@dataclass(frozen=True)
class FtrlParams:
    """``max_rows`` bounds the labelled sample that is fitted (about: rows are
    chosen by a hash of their id, and of their text if ids repeat);
    ``shard_rows`` and ``max_shards`` set how many shards train side by side;
    ``positive`` weighs rows of label 1.  The strengths were chosen by
    accuracy on four inner folds of the rows that are not held out."""

    alpha: float = 8.0
    beta: float = 1.0
    l1: float = 12.0
    positive: float = 4.0
    rounds: int = 5
    max_rows: int = 200_000
    shard_rows: int = 4_000
    max_shards: int = 16


def features(text: bytes | None) -> np.ndarray:
    """Coordinates of a text, with repeats, in no order."""
    h = hash_words(alnum_words(text))
    parts = [mix(h), ngram_hashes(h, 2)]
    if len(h) > 2:
        parts.append(mix(h[:-2] * np.uint64(PHI) + h[2:] * np.uint64(SKIP)))
    return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64)


def pack(coords: np.ndarray) -> bytes:
    """Distinct coordinates as compressed gaps."""
    return zlib.compress(np.diff(np.unique(coords), prepend=0).astype("<u4").tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), "<u4"), dtype=np.int64)


def weights_of(z: np.ndarray, n: np.ndarray, p: FtrlParams) -> np.ndarray:
    """Closed-form weights of the sums; the last coordinate is the bias, without L1."""
    rate = (p.beta + np.sqrt(n)) / p.alpha
    w = np.where(np.abs(z) <= p.l1, 0.0, -(z - np.sign(z) * p.l1) / rate)
    w[-1] = -z[-1] / rate[-1]
    return w


def _pass(rows: list[tuple[bytes, int]], z: np.ndarray, n: np.ndarray, p: FtrlParams) -> None:
    """One online pass over a shard's rows; updates ``z`` and ``n`` in place."""
    bias = np.array([1 << BITS])
    for packed, y in rows:
        f = np.append(unpack(packed), bias)
        zf, nf = z[f], n[f]
        rate = (p.beta + np.sqrt(nf)) / p.alpha
        w = np.where(np.abs(zf) <= p.l1, 0.0, -(zf - np.sign(zf) * p.l1) / rate)
        w[-1] = -zf[-1] / rate[-1]
        g = (_sigmoid(w.sum()) - y) * (p.positive if y else 1.0)
        z[f] = zf + g - (np.sqrt(nf + g * g) - np.sqrt(nf)) / p.alpha * w
        n[f] = nf + g * g


def _sparse(z: np.ndarray, n: np.ndarray) -> bytes:
    """The coordinates where a sum is not zero, with their sums as 32-bit floats."""
    at = np.flatnonzero((z != 0) | (n != 0))
    return zlib.compress(at.astype("<i4").tobytes() + z[at].astype("<f4").tobytes() + n[at].astype("<f4").tobytes(), 1)


def _dense(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The sums of ``_sparse``, whole."""
    raw = zlib.decompress(data)
    m = len(raw) // 12
    at = np.frombuffer(raw, "<i4", m)
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    z[at], n[at] = np.frombuffer(raw, "<f4", m, 4 * m), np.frombuffer(raw, "<f4", m, 8 * m)
    return z, n


def _shard_round(sums, p: FtrlParams):
    """What one round over each shard changes in the broadcast ``sums``; rows
    come sorted by shard, so a task holds one model and one batch."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, n = _dense(sums.value)
        own, z1, n1 = None, z, n

        def moved() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([own], pa.int64()), pa.array([_sparse(z1 - z, n1 - n)], pa.binary())], ["shard", "moved"])

        for batch in batches:
            for shard, x, y in zip(*[batch.column(c) for c in ("shard", "x", "y")]):
                if shard.as_py() != own:
                    if own is not None:
                        yield moved()
                    own, z1, n1 = shard.as_py(), z.copy(), n.copy()
                _pass([(x.as_py(), y.as_py())], z1, n1, p)
        if own is not None:
            yield moved()

    return train


def _mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mean of all shards' changes, one after another (at most ``max_shards`` rows, each smaller than a model)."""
    z, n, many = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1), 0
    for batch in batches:
        for data in batch.column("moved"):
            dz, dn = _dense(data.as_py())
            z += dz
            n += dn
            many += 1
    if many:
        yield pa.RecordBatch.from_arrays([pa.array([_sparse(z / many, n / many)], pa.binary())], ["moved"])


def _sigmoid(s: float) -> float:
    return 1.0 / (1.0 + np.exp(-np.clip(s, -30.0, 30.0)))


def _forget(table: DataFrame) -> None:
    """Deletes the files of a checkpointed table that nothing reads any more."""
    sc = table.sparkSession.sparkContext
    file = table._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        path = sc._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def fit(rows: DataFrame, text: str, label: str, key: str, params: FtrlParams = FtrlParams()) -> np.ndarray:
    """Weights fitted on ``rows`` (``label`` 0/1; null labels are left out).

    ``key`` only decides the sample, the shard and the order of rows; equal
    rows give equal weights on every run.  No rows give all-zero weights.
    """
    spark = rows.sparkSession
    checkpoint_root(spark)

    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: pack(features(t)))

    known = rows.where(F.col(label).isin(0, 1))
    count = known.count()
    if count > params.max_rows:
        known = known.where(F.pmod(F.xxhash64(F.lit("sample"), key, text), F.lit(1 << 30)) < int((1 << 30) * params.max_rows / count))
        count = params.max_rows
    shards = max(1, min(params.max_shards, -(-count // params.shard_rows)))
    order = F.xxhash64(F.lit("order"), F.col(key))
    # dealt to its shard once; every round reads the checkpoint, whose partitions hold whole shards
    table = (known.select(F.pmod(order, F.lit(shards)).alias("shard"), order.alias("o"), F.col(label).cast("int").alias("y"),
                          packed(F.col(text).cast("binary")).alias("x"))
                  .repartition(shards, "shard").sortWithinPartitions("shard", "o", "x").checkpoint())
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    for _ in range(params.rounds if count else 0):
        sums = spark.sparkContext.broadcast(_sparse(z, n))
        moved = (table.mapInArrow(_shard_round(sums, params), "shard long, moved binary")
                      .repartition(1).sortWithinPartitions("shard").mapInArrow(_mean, "moved binary").first())
        sums.destroy()
        if moved is None:
            break
        dz, dn = _dense(bytes(moved["moved"]))
        z, n = z + dz, n + dn
    _forget(table)
    return weights_of(z, n, params).astype(np.float32)


def score(text: Column, weights: np.ndarray) -> Column:
    """Column with the probability of label 1; null and empty texts get the bias alone."""
    some = np.flatnonzero(weights[:-1])
    index, value, bias = some.astype(np.int32), weights[some], float(weights[-1])

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dense = np.zeros(1 << BITS, np.float64)
        dense[index] = value
        for texts in batches:
            yield pd.Series([_sigmoid(bias + dense[np.unique(f[dense[f] != 0])].sum())
                             for f in map(features, texts)], dtype="float64")

    return probability(text.cast("binary"))


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 1 when divided by 3 (a null id counts as "")."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit_on_labels(docs: DataFrame, labels: DataFrame, params: FtrlParams = FtrlParams()) -> np.ndarray:
    """Weights from the labelled rows of ``docs`` that are not held out.

    ``labels`` has ``doc_id, toxic``; several labels of one id count as 1 if
    any is 1.  The labels kept are at most about ``max_rows`` (16 bytes each,
    so they are broadcast), chosen by a hash of the id.  Columns of ``docs``
    other than its id and text are not used, whatever their names.
    """
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
                   .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    total = known.count()
    if total > params.max_rows:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * params.max_rows / total))
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return fit(rows, "text", "toxic", "doc_id", params)


def classify(docs: DataFrame, weights: np.ndarray, threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from ``threshold`` on) added;
    columns of these names have ``input_`` before them."""
    docs = make_room(docs, "score", "predicted")
    scored = docs.withColumn("score", score(F.col("text"), weights))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def remove_toxic(docs: DataFrame, weights: np.ndarray, threshold: float = 0.7) -> DataFrame:
    """The rows below ``threshold``, all columns unchanged; null and empty texts are scored like others."""
    return docs.where(score(F.col("text"), weights) < threshold)
