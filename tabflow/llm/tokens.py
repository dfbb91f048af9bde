"""Token counts with overlap resynchronisation.

Texts of at most ``chunk`` bytes are encoded whole.  A longer text is cut at
borders, and its chunks, each with an overlap of text at both sides, become
rows of their own that are spread over tasks.  Every chunk is encoded with
offsets.  Two neighbours are spliced at the first position of their overlap
where both encodings begin a token and that is proven stable: BPE only ever
joins two neighbouring symbols into a vocabulary piece, so where no piece
holds the two characters around a position side by side, no merge crosses it,
whatever stands further away.  Where the encodings share no such position the
alignment fails: the text's next round has that border's overlap eight times
wider, and no border there once the overlap would meet the next one, at last
the whole text as one chunk.

The proof needs a BPE model with byte fallback that neither normalises texts
nor strips white space.  With any other model every text is encoded whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabflow.llm.columns import fresh
from tabflow.llm.scratch import Scratch

#: Bytes beyond which a text is cut, and characters of a chunk; characters of the first overlap at each side; its growth.
CHUNK, OVERLAP, WIDEN = 1 << 16, 256, 8
BORDERS = "array<struct<at:long,width:long>>"
ZONE = "array<struct<at:long,before:long>>"


def processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def neighbours(model: bytes) -> frozenset[str] | None:
    """Pairs of neighbouring characters in the pieces (a blank for the space
    mark); None if splicing is not proven for this model."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    norm, trained = proto.normalizer_spec, proto.trainer_spec
    if (trained.model_type != trained.BPE or not trained.byte_fallback or norm.precompiled_charsmap
            or norm.remove_extra_whitespaces or not norm.escape_whitespaces):
        return None
    pairs: set[str] = set()
    for p in proto.pieces:
        if p.type not in (p.BYTE, p.CONTROL, p.UNKNOWN):
            own = p.piece.replace("▁", " ")
            pairs.update(map("".join, zip(own, own[1:])))
    return frozenset(pairs)


def slices(text: str, borders: list[tuple[int, int]]) -> Iterator[tuple[str, int, int, int, int, int]]:
    """Per chunk: its text with the overlaps, where that begins, and position
    and overlap of the borders before and after it (overlap 0: end of the text)."""
    cuts = [(0, 0), *borders, (len(text), 0)]
    for (begin, left), (stop, right) in zip(cuts, cuts[1:]):
        low = max(0, begin - left)
        yield text[low:min(len(text), stop + right)], low, begin, left, stop, right


def stable_starts(part: str, low: int, starts: np.ndarray, at: int, width: int, pairs: frozenset[str]) -> list[tuple[int, int]]:
    """Positions within ``width`` of a border at which a token begins and which
    no merge crosses, each with the number of the slice's tokens before it."""
    own = np.unique(starts[(starts >= max(1, at - width - low)) & (starts <= at + width - low)])
    return [(low + int(p), int(np.searchsorted(starts, p))) for p in own if part[p - 1:p + 1].replace("▁", " ") not in pairs]


def count_tokens(docs: DataFrame, model: str, text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8) and ``n_tokens`` of its text added.

    ``model`` is the path of a sentencepiece model, read on the driver (0.5
    MB) and sent to the tasks.  Counts are the library's for the whole text,
    without begin or end tokens; special strings in texts are ordinary text.
    Null and empty texts have 0 bytes and tokens.  Repeated rows are counted
    each; existing columns stay (of the new names, they are replaced).
    """
    with open(model, "rb") as f:
        data = f.read()
    pairs = neighbours(data)
    sized = docs.withColumn("n_bytes", F.coalesce(F.length(F.col(text).cast("binary")), F.lit(0)).cast("long"))

    @F.pandas_udf("long")
    def whole(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sp = processor(data)
        for texts in batches:
            yield pd.Series([len(sp.encode(t)) if t else 0 for t in texts], dtype="int64")

    if pairs is None:
        return sized.withColumn("n_tokens", whole(F.col(text)))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for h1, h2, t, borders in zip(pdf["h1"], pdf["h2"], pdf["t"], pdf["borders"]):
                if borders is None:  # first round
                    width = max(1, min(overlap, chunk // 2 - 1))
                    borders = [{"at": at, "width": width} for at in range(chunk, len(t), chunk)]
                for k, own in enumerate(slices(t, [(int(b["at"]), int(b["width"])) for b in borders])):
                    yield pd.DataFrame([(h1, h2, k, *own)], columns=["h1", "h2", "k", "part", "low", "begin", "lw", "stop", "rw"])

    @F.pandas_udf(f"total long, left {ZONE}, right {ZONE}")
    def coded(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        sp = processor(data)
        for columns in batches:
            out = []
            for part, low, begin, lw, stop, rw in zip(*columns):
                starts = np.array([a for a, _ in sp.encode(part, return_type="offset_mapping")["offsets"]], dtype=np.int64)
                zones = ([{"at": p, "before": n} for p, n in stable_starts(part, low, starts, at, w, pairs)] if w else [] for at, w in ((begin, lw), (stop, rw)))
                out.append((len(starts), *zones))
            yield pd.DataFrame(out, columns=["total", "left", "right"])

    def encoded(texts: DataFrame) -> DataFrame:
        """A row per chunk: its tokens between its splices, or its failed border."""
        parts = (texts.mapInPandas(cut, "h1 long, h2 long, k long, part string, low long, begin long, lw long, stop long, rw long")
                      .repartition("h1", "h2", "k"))  # spreads one text's chunks
        codes = parts.select("h1", "h2", "k", "stop", "rw", coded("part", "low", "begin", "lw", "stop", "rw").alias("c"))
        row = Window.partitionBy("h1", "h2").orderBy("k")
        inner = F.col("rw") > 0  # a border follows
        common = F.array_min(F.array_intersect("c.right.at", F.lead("c.left.at").over(row)))

        def before(zone: str, at: str):
            return F.get(F.filter(zone, lambda x: x["at"] == F.col(at)), F.lit(0))["before"]

        aligned = codes.withColumn("splice", F.when(inner, common)).withColumn("from", F.lag("splice").over(row))
        count = F.when(inner, before("c.right", "splice")).otherwise(F.col("c.total")) - F.when(F.col("k") == 0, 0).otherwise(before("c.left", "from"))
        return aligned.select("h1", "h2", F.struct(F.col("stop").alias("at"), F.col("rw").alias("width")).alias("border"), inner.alias("inner"),
                              (inner & F.col("splice").isNull()).alias("failed"), count.alias("n"))

    short = sized.where(F.col("n_bytes") <= chunk).withColumn("n_tokens", whole(F.col(text)))
    k1, k2, c1, c2, n = fresh([*sized.columns, "n_tokens"], "h1", "h2", "c1", "c2", "n")
    hashed = sized.where(F.col("n_bytes") > chunk).withColumns({k1: F.xxhash64(text), k2: F.xxhash64(F.lit(1), text)})
    texts = (hashed.select(F.col(k1).alias("h1"), F.col(k2).alias("h2"), F.col(text).alias("t"))
                   .groupBy("h1", "h2").agg(F.first("t").alias("t")))  # copies of a text are encoded once
    tmp = Scratch(docs.sparkSession, "tokens")
    counted, todo, grown = None, texts.withColumn("borders", F.lit(None).cast(BORDERS)), F.col("border.width") * WIDEN
    for k in range(64):  # borders widen or go in every round that is not the last
        states = F.array_sort(F.collect_list(F.when(F.col("inner") & (~F.col("failed") | (grown * 2 < chunk)), F.struct(
            F.col("border.at").alias("at"), F.when(F.col("failed"), grown).otherwise(F.col("border.width")).alias("width")))))
        done = tmp.save(encoded(todo).groupBy("h1", "h2").agg(F.bool_or("failed").alias("failed"), F.sum("n").alias("n"), states.alias("borders")), f"round{k}")
        own = done.where("not failed").select("h1", "h2", "n")
        counted = own if counted is None else counted.union(own)
        again = done.where("failed").select("h1", "h2", "borders")
        if again.isEmpty():
            break
        todo = texts.join(again, ["h1", "h2"])
    counted = counted.select(F.col("h1").alias(c1), F.col("h2").alias(c2), F.col("n").alias(n))
    long = hashed.join(counted, (F.col(k1) == F.col(c1)) & (F.col(k2) == F.col(c2)))
    return short.unionByName(long.withColumn("n_tokens", F.col(n)).select(*[f"`{c}`" for c in short.columns]))
