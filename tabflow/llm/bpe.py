"""Byte-level BPE encoding and decoding with a pair occurrence index.

Texts are cut into pieces (words with their leading blank, numbers, marks,
white space), which BPE never joins.  The distinct new pieces of many texts
of a partition are laid out as one array of symbols, and an index maps each
mergeable pair to all its positions there.  Active ranks are applied in
ascending order: the lowest one merges all its positions, which removes and
adds occurrences only at the neighbours, whose lists are updated; the index
never has to be built again.  So a merge costs its occurrences, however many
texts share them, and a piece of a million bytes costs about as much as its
bytes in short pieces.  Pieces are remembered for the rest of the partition,
up to ``REMEMBERED`` of them.

The vocabulary (a JSON file of the tokenizers library, about 1.5 MB) is read
on the driver and sent to the tasks compressed.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Pieces of byte-level BPE (fixed value: part of the vocabulary's definition).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces a task remembers, characters of the longest of them, bytes of pieces laid out
#: together and characters of texts cut into pieces at a time (single ones may be larger).
REMEMBERED, LONGEST, TOGETHER, AT_ONCE = 400_000, 64, 1 << 20, 1 << 21


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte: itself if it is printable
    Latin-1 (but the blank, the no-break space and the soft hyphen), the others in order from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """A vocabulary in use by one task."""

    def __init__(self, packed: bytes):
        import regex

        spec = json.loads(zlib.decompress(packed))
        ids, back = spec["model"]["vocab"], byte_symbols()
        self.base = np.zeros(256, np.int64)
        for c, b in back.items():
            self.base[b] = ids[c]
        self.size = max([*ids.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.merges: list[tuple[int, int, int]] = []
        self.rank: dict[int, int] = {}
        for m in spec["model"]["merges"]:
            a, b = m.split(" ") if isinstance(m, str) else m
            self.rank.setdefault(ids[a] * self.size + ids[b], len(self.merges))
            self.merges.append((ids[a], ids[b], ids[a + b]))
        self.codes = np.array(sorted(self.rank), np.int64)
        self.ranks = np.array([self.rank[c] for c in self.codes.tolist()], np.int64)
        self.bytes_of: dict[int, bytes] = {i: bytes(back[c] for c in t) for t, i in ids.items()}
        self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in spec["added_tokens"]}
        self.bytes_of |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.splitter = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.pattern = regex.compile(PIECES)
        self.known: dict[str, bytes] = dict(self.added)

    def pieces(self, text: str) -> list[str]:
        """Pieces of a text; added tokens that occur in it are pieces of their own."""
        if self.splitter is None or not any(t in text for t in self.added):
            return self.pattern.findall(text)
        out: list[str] = []
        for part in self.splitter.split(text):
            out += [part] if part in self.added else self.pattern.findall(part)
        return out

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, little-endian and 32 bits wide."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        ends = np.cumsum(lengths)
        flat = self.base[np.frombuffer(b"".join(pieces), np.uint8)]
        n = len(flat)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[(ends - lengths)] = -1
        # the index: positions of each mergeable pair, ascending
        left = np.flatnonzero(after >= 0)
        code = flat[left] * self.size + flat[left + 1]
        at = np.minimum(np.searchsorted(self.codes, code), max(len(self.codes) - 1, 0))
        some = self.codes[at] == code if len(self.codes) else np.zeros(len(code), bool)
        left, ranks = left[some], self.ranks[at[some]]
        order = np.argsort(ranks, kind="stable")
        first = np.flatnonzero(np.diff(ranks[order], prepend=-1))
        index: dict[int, list[int]] = {int(ranks[order[f]]): part.tolist() for f, part in zip(first, np.split(left[order], first[1:]))} if len(order) else {}
        active = list(index)
        heapq.heapify(active)
        sym, nxt, prv, rank, size = flat.tolist(), after.tolist(), before.tolist(), self.rank, self.size
        while active:
            r = heapq.heappop(active)
            a, b, c = self.merges[r]
            positions = index.pop(r)
            if a == b:
                positions.sort()  # overlapping occurrences merge from the left
            for p in positions:
                q = nxt[p]
                if sym[p] != a or q < 0 or sym[q] != b:
                    continue
                sym[p], sym[q] = c, -1
                s = nxt[p] = nxt[q]
                if s >= 0:
                    prv[s] = p
                    new = rank.get(c * size + sym[s])
                    if new is not None:
                        if new in index:
                            index[new].append(p)
                        else:
                            index[new] = [p]
                            heapq.heappush(active, new)
                o = prv[p]
                if o >= 0:
                    new = rank.get(sym[o] * size + c)
                    if new is not None:
                        if new in index:
                            index[new].append(o)
                        else:
                            index[new] = [o]
                            heapq.heappush(active, new)
        done = np.array(sym, np.int64)
        alive = done >= 0
        data = done[alive].astype("<u4").tobytes()
        stops = 4 * np.cumsum(alive)[ends - 1] if len(ends) else ends
        return [data[i:j] for i, j in zip([0, *stops[:-1].tolist()], stops.tolist())]

    def learn(self, new: set[str]) -> None:
        """Puts the ids of ``new`` pieces into ``known``, laying out a bounded number together."""
        some: list[str] = []
        data: list[bytes] = []
        size = 0
        for p in new:
            some.append(p)
            data.append(p.encode())
            size += len(data[-1])
            if size > TOGETHER:
                self.known.update(zip(some, self.merge(data)))
                some, data, size = [], [], 0
        if some:
            self.known.update(zip(some, self.merge(data)))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, little-endian and 32 bits wide; null and empty texts have none."""
        cut = [self.pieces(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = dict(self.added)
        new = set().union(*cut).difference(self.known)
        self.learn(new)
        out = [b"".join(map(self.known.__getitem__, ps)) for ps in cut]
        for p in new:
            if len(p) > LONGEST:
                del self.known[p]
        return out

    def decode(self, ids: bytes | None) -> str:
        """Text of little-endian 32-bit ids; bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""
        some = np.frombuffer(ids or b"", "<u4").tolist()
        return b"".join([self.bytes_of.get(i, b"") for i in some]).decode("utf-8", "replace")


def load(path: str) -> bytes:
    """A vocabulary file, checked and compressed, for ``encode`` and ``decode``.

    Supported: BPE with a byte-level pre-tokenizer, without prefix space,
    normalizer, truncation, padding or options; added tokens are taken as they
    are found in texts.  Anything else raises ``ValueError``.
    """
    with open(path, "rb") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    odd += [k for k in ("normalizer", "truncation", "padding", "post_processor") if spec.get(k)]
    odd += [t["content"] for t in spec["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
    if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or odd:
        raise ValueError(f"not a plain byte-level BPE vocabulary: {path} {odd}")
    return zlib.compress(json.dumps({"model": {k: model[k] for k in ("vocab", "merges")}, "added_tokens": spec["added_tokens"]}).encode(), 6)


def _in_parts(bpe: Bpe, texts: pd.Series) -> list[bytes]:
    """Ids of many texts; the pieces held at once are bounded."""
    out: list[bytes] = []
    some: list[str | None] = []
    chars = 0
    for t in texts:
        some.append(t)
        chars += len(t) if t else 0
        if chars > AT_ONCE:
            out += bpe.encode(some)
            some, chars = [], 0
    return out + bpe.encode(some)


def encode(text: Column, vocabulary: bytes) -> Column:
    """Column with a text's ids as little-endian 32-bit integers (binary);
    null and empty texts have none.  Strings of added tokens in a text become
    those tokens, as the library does by default."""

    @F.pandas_udf("binary")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = Bpe(vocabulary)
        for texts in batches:
            yield pd.Series(_in_parts(bpe, texts), dtype=object)

    return ids(text.cast("string"))


def decode(ids: Column, vocabulary: bytes) -> Column:
    """Column with the text of ids as ``encode`` gives them, added tokens
    included; null ids give an empty text, ids outside the vocabulary nothing."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = Bpe(vocabulary)
        for some in batches:
            yield pd.Series([bpe.decode(x) for x in some], dtype=object)

    return text(ids)


def round_trip(text: Column, vocabulary: bytes) -> Column:
    """Column of ``ids`` (see ``encode``) and ``decoded`` (see ``decode``) of
    those ids, in one pass: one vocabulary and one Python worker a task."""

    @F.pandas_udf("ids binary, decoded string")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = Bpe(vocabulary)
        for texts in batches:
            ids = _in_parts(bpe, texts)
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series(map(bpe.decode, ids), dtype=object)})

    return both(text.cast("string"))


def n_tokens(ids: Column) -> Column:
    return (F.coalesce(F.length(ids), F.lit(0)) / 4).cast("long")
