"""Benchmark decontamination with a generalised suffix automaton.

All items go into one automaton over word ids.  A document's words are
streamed through it: at each word the automaton holds the longest run ending
there that occurs in some item.  A run of ``window`` words or more is a hit;
items shorter than ``window`` hit as a whole.

The automaton is built on the driver from at most ``max_words`` item words
(measured first; about 100 bytes a word) and sent to the tasks.  A larger
benchmark is cut into blocks of that size; each block is streamed over all
documents and the hits are merged, so no object grows with the benchmark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.llm.columns import fresh, make_room
from tabflow.llm.scratch import Scratch
from tabflow.llm.text import ALNUM, alnum_words

HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()),
                                                     T.StructField("last", T.IntegerType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])
#: Hits with the UTF-8 text that is left without them (null: nothing to cut).
CUT = T.StructType([*HITS.fields, T.StructField("rest", T.BinaryType())])


class ItemAutomaton:
    """Generalised suffix automaton of items given as (id, words)."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = 10):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        coded = [(i, [self.vocab.setdefault(w, len(self.vocab)) for w in ws]) for i, ws in items if ws]
        self.size = max(1, len(self.vocab))
        self.next: dict[int, int] = {}  # state * size + word -> state
        self.link, self.length = [-1], [0]
        out: list[list[int]] = [[]]  # words leaving a state, needed while building
        for _, ws in coded:
            last = 0
            for w in ws:
                last = self._extend(last, w, out)
        self.shortest = min([window, *(len(ws) for _, ws in coded)])
        self.at: dict[int, list[tuple[int, str]]] = {}  # state -> (window length, item)
        for item, ws in coded:
            n, v, size = min(window, len(ws)), 0, 0
            for w in ws:
                v, size = self.next[v * self.size + w], size + 1
                if size >= n:
                    u = self._shortened(v, n)
                    if (n, item) not in self.at.setdefault(u, []):
                        self.at[u].append((n, item))
        # nearest state on the way to the root, itself included, that ends a window
        self.marked = [-1] * len(self.link)
        for v in sorted(range(len(self.link)), key=self.length.__getitem__):
            self.marked[v] = v if v in self.at else self.marked[self.link[v]] if v else -1

    def _shortened(self, v: int, n: int) -> int:
        """The state of the last ``n`` words of a string in state ``v``."""
        while self.length[self.link[v]] >= n:
            v = self.link[v]
        return v

    def _new(self, length: int, link: int, words: list[int], out: list[list[int]]) -> int:
        self.length.append(length)
        self.link.append(link)
        out.append(list(words))
        return len(self.link) - 1

    def _split(self, p: int, w: int, out: list[list[int]]) -> int:
        """The state of p's strings followed by w, split off where it holds longer strings too."""
        q = self.next[p * self.size + w]
        if self.length[q] == self.length[p] + 1:
            return q
        c = self._new(self.length[p] + 1, self.link[q], out[q], out)
        for x in out[q]:
            self.next[c * self.size + x] = self.next[q * self.size + x]
        self.link[q] = c
        while p != -1 and self.next.get(p * self.size + w) == q:
            self.next[p * self.size + w] = c
            p = self.link[p]
        return c

    def _extend(self, last: int, w: int, out: list[list[int]]) -> int:
        if last * self.size + w in self.next:
            return self._split(last, w, out)
        cur, p = self._new(self.length[last] + 1, 0, [], out), last
        while p != -1 and p * self.size + w not in self.next:
            self.next[p * self.size + w] = cur
            out[p].append(w)
            p = self.link[p]
        if p != -1:
            self.link[cur] = self._split(p, w, out)
        return cur

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        """Spans (first and last word, merged) covered by windows; the items they belong to."""
        ids = np.fromiter(map(self.vocab.get, words, repeat(-1)), np.int64, len(words))
        known = np.concatenate(([0], (ids >= 0).view(np.int8), [0]))
        edges = np.flatnonzero(np.diff(known))
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        for start, end in zip(edges[::2], edges[1::2]):
            if end - start >= self.shortest:  # an occurrence lies within a run of known words
                self._run(ids[start:end].tolist(), int(start), spans, found)
        return spans, sorted(found)

    def _run(self, ids: list[int], start: int, spans: list[tuple[int, int]], found: set[str]) -> None:
        size, nxt, link, length, marked = self.size, self.next, self.link, self.length, self.marked
        v = have = 0
        for i, w in enumerate(ids, start):
            u = nxt.get(v * size + w)
            while u is None and v:
                v = link[v]
                have = length[v]
                u = nxt.get(v * size + w)
            if u is None:
                continue
            v, have = u, have + 1
            m = marked[v]
            reach = 0
            while m != -1:
                for n, item in self.at[m]:
                    if n <= have:
                        found.add(item)
                        reach = max(reach, n)
                m = marked[link[m]] if m else -1
            if reach:
                first = i - reach + 1
                while spans and spans[-1][1] >= first - 1 and spans[-1][0] >= first:
                    spans.pop()
                if spans and spans[-1][1] >= first - 1:
                    spans[-1] = (spans[-1][0], i)
                else:
                    spans.append((first, i))


def _hits_udf(automaton: ItemAutomaton, cut: bool = False):
    """Hits of each text.  With ``cut`` also what is left of it, and Spark may
    neither repeat nor move the call: a filter on the hits would else scan the
    texts again, in a worker of its own."""
    kind = CUT if cut else HITS

    @F.pandas_udf(kind)
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                ws = alnum_words(t)
                spans, items = automaton.scan(ws)
                rest = [cut_spans(t, spans) if spans else None] if cut else []
                rows.append((len(ws), sum(b - a + 1 for a, b in spans), spans, items, *rest))
            yield pd.DataFrame(rows, columns=kind.names)

    return hits.asNondeterministic() if cut else hits


def _blocks(items: DataFrame, item_id: str, text: str, max_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items in lists of about ``max_words`` words; one list is on the driver at a time."""
    own = items.select(F.col(item_id).cast("string").alias("i"), F.col(text).cast("binary").alias("t")).where("t is not null and i is not null")
    size = own.agg(F.sum(F.length("t"))).first()[0] or 0
    parts = max(1, -(-size // (6 * max_words)))  # about six bytes a word
    part = F.pmod(F.xxhash64("i", "t"), F.lit(parts))
    for k in range(parts):
        rows = own.where(part == k).distinct().collect()
        yield sorted((r["i"], alnum_words(bytes(r["t"]))) for r in rows)


def find_hits(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
              window: int = 10, max_words: int = 200_000) -> DataFrame:
    """``docs`` with a struct ``hits``: ``n_words``, ``n_hit`` (words inside an
    occurrence), ``spans`` of words and ``items`` (ids as sorted strings).

    Null texts and items have no words; items without an id or words never
    hit; repeated item ids count once.  Extra columns stay untouched; one
    named ``hits`` becomes ``input_hits``.
    """
    return _with_hits(make_room(docs, "hits"), items, "hits", text, item_id, item_text, window, max_words)


def _with_hits(docs: DataFrame, items: DataFrame, name: str, text: str, item_id: str, item_text: str, window: int, max_words: int,
               cut: bool = False) -> DataFrame:
    """``docs`` with the struct in a column ``name`` that ``docs`` doesn't have; with ``cut`` it also has ``rest``."""
    blocks = _blocks(items, item_id, item_text, max_words)
    first = next(blocks)
    content = F.col(text).cast("binary")
    automaton = ItemAutomaton(first, window)
    rest: list[DataFrame] = []
    tmp = None
    for k, block in enumerate(blocks):
        tmp = tmp or Scratch(docs.sparkSession, "decontaminate")
        own = docs.select(content.alias("t")).select(
            F.xxhash64("t").alias("h1"), F.xxhash64(F.lit(1), "t").alias("h2"),
            _hits_udf(ItemAutomaton(block, window))(F.col("t")).alias("more"))
        rest.append(tmp.save(own.where("size(more.items) > 0").distinct(), f"block{k}"))
    if not rest:
        return docs.withColumn(name, _hits_udf(automaton, cut)(content))
    found = docs.withColumn(name, _hits_udf(automaton)(content))
    more = rest[0]
    for x in rest[1:]:
        more = more.union(x)
    h1, h2, spans, ids = fresh(found.columns, "h1", "h2", "spans", "ids")
    merged = more.groupBy(F.col("h1").alias(h1), F.col("h2").alias(h2)).agg(
        F.flatten(F.collect_list("more.spans")).alias(spans), F.flatten(F.collect_list("more.items")).alias(ids))
    joined = (found.withColumns({h1: F.xxhash64(content), h2: F.xxhash64(F.lit(1), content)})
                   .join(merged, [h1, h2], "left"))
    merge = _merge_udf(cut)(F.col(name), F.col(spans), F.col(ids), *([content] if cut else []))
    return joined.withColumn(name, merge).select(*[f"`{c}`" for c in found.columns])


def _merge_udf(cut: bool):
    """Hits of the first block with those of the others; with ``cut`` (of ``texts``) as in ``_hits_udf``."""
    kind = CUT if cut else HITS

    def merge(hits: pd.DataFrame, spans: pd.Series, items: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = []
        for n, a, i, b, j, t in zip(hits["n_words"], hits["spans"], hits["items"], spans, items, texts):
            ends: list[list[int]] = []
            for x in sorted((int(s["first"]), int(s["last"])) for part in (a, b) if part is not None for s in part):
                if ends and x[0] <= ends[-1][1] + 1:
                    ends[-1][1] = max(ends[-1][1], x[1])
                else:
                    ends.append(list(x))
            ids = sorted({*i, *(j if j is not None else ())})
            rest = [cut_spans(t, [tuple(e) for e in ends]) if ends else None] if cut else []
            rows.append((n, sum(y - x + 1 for x, y in ends), [tuple(e) for e in ends], ids, *rest))
        return pd.DataFrame(rows, columns=kind.names)

    if cut:
        return F.pandas_udf(merge, kind).asNondeterministic()

    @F.pandas_udf(kind)
    def merged(hits: pd.DataFrame, spans: pd.Series, items: pd.Series) -> pd.DataFrame:
        return merge(hits, spans, items, spans)

    return merged


def cut_spans(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """UTF-8 text without the bytes from each span's first to its last word; a line break is left in place."""
    where = [m.span() for m in re.finditer(rb"[0-9a-z\x80-\xff]+", data.lower().translate(ALNUM))]
    out, at = [], 0
    for first, last in spans:
        out.append(data[at:where[first][0]].rstrip(b" "))
        at = where[last][1]
    out.append(data[at:])
    return b"\n".join(out)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.5, max_words: int = 200_000) -> DataFrame:
    """Documents with every hit span cut out of their text; those with more
    than ``max_coverage`` of their words hit are dropped whole.  ``n_chars``,
    where there is one, follows the new text.  Documents without a hit, null
    and empty texts stay as they are, and so do all other columns."""
    (hits,) = fresh(docs.columns, "hits")
    kept = _with_hits(docs, items, hits, "text", "item_id", "text", window, max_words, cut=True).where(
        f"{hits}.n_hit = 0 or {hits}.n_hit <= {hits}.n_words * " + repr(max_coverage))
    clean = kept.withColumn("text", F.when(F.col(f"{hits}.n_hit") > 0, F.col(f"{hits}.rest").cast("string")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.col(f"{hits}.n_hit") > 0, F.length("text")).otherwise(F.col("n_chars"))
                                 .cast(docs.schema["n_chars"].dataType))
    return clean.select(*[f"`{c}`" for c in docs.columns])
