"""Blocked Bloom filter of keys as a small table, built and tested with DataFrame functions.

A key's hash names a block of 256 bits (four 64-bit words) and one bit in
each word.  The filter is a table of blocks, aggregated by ``bit_or`` (combined
before the shuffle), of at most ``MAX_BLOCKS`` rows (about 10 MB), which is why
it may be broadcast: rows are tested where they are, without a shuffle.  A row
whose bits are not all set holds none of the keys; the others (all that do and
about one in a hundred of the rest) are candidates for an exact join.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a filter at most, keys that a block is meant for, words of a block.
MAX_BLOCKS, KEYS_PER_BLOCK, WORDS = 1 << 17, 24, 4


def blocks_for(n_keys: int, copies: int = 1) -> Optional[int]:
    """Blocks of a filter for ``n_keys`` (a power of two), None if ``copies`` such filters would exceed ``MAX_BLOCKS``."""
    blocks = 64
    while blocks * KEYS_PER_BLOCK < n_keys:
        blocks *= 2
    return blocks if blocks * copies <= MAX_BLOCKS else None


def _place(keys: Sequence[Column], blocks: int) -> tuple[Column, list[Column]]:
    """A key's block and its bit in each word."""
    bits = F.xxhash64(F.lit("bits"), *keys)
    one = F.lit(1).cast("long")
    return (F.pmod(F.xxhash64(F.lit("block"), *keys), F.lit(blocks)).cast("int"),
            [F.call_function("shiftleft", one, F.pmod(F.shiftright(bits, 6 * i), F.lit(64)).cast("int")) for i in range(WORDS)])


def build_filter(df: DataFrame, keys: Sequence[str], blocks: int, by: Sequence[str] = ()) -> DataFrame:
    """``by..., _block, _w0 ... _w3``: one filter of the keys of ``df`` for each value of ``by`` (null keys are left out)."""
    block, bits = _place([F.col(k) for k in keys], blocks)
    some = df.dropna(subset=list(keys)).select(*by, block.alias("_block"), *[b.alias(f"_w{i}") for i, b in enumerate(bits)])
    return some.groupBy(*by, "_block").agg(*[F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(WORDS)])


def mark_candidates(df: DataFrame, keys: Sequence[str], blocks: int, built: DataFrame, by: Sequence[str] = (),
                    name: str = "_candidate") -> DataFrame:
    """``df`` with a boolean ``name``: False if the row's key is surely not in the filter ``built`` (of its ``by``)."""
    block, bits = _place([F.col(k) for k in keys], blocks)
    placed = df.select("*", block.alias("_block"))
    joined = placed.join(F.broadcast(built), [*by, "_block"], "left")  # at most MAX_BLOCKS rows
    found = F.lit(True)
    for i, b in enumerate(bits):
        found = found & (F.col(f"_w{i}").bitwiseAND(b) != 0)
    return joined.select(*df.columns, F.coalesce(found, F.lit(False)).alias(name))
