"""Words and 64-bit word hashes of UTF-8 texts, vectorised with numpy.

Texts reach tasks as bytes (``cast("binary")``), so nothing is decoded and
no text is too long or malformed to be split.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

#: Odd multiplier of the polynomial over word hashes (fixed value: 2^64 / golden ratio).
PHI = 0x9E3779B97F4A7C15

#: Byte table: everything in ASCII but 0-9 and a-z becomes a blank (after lower-casing A-Z).
ALNUM = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def blank_words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space (0x20, 0x09-0x0D), A-Z lower-cased; null has none."""
    return text.lower().split() if text else []


def alnum_words(text: bytes | None) -> list[bytes]:
    """Runs of 0-9, a-z and non-ASCII characters, A-Z lower-cased; null has none."""
    return text.lower().translate(ALNUM).split() if text else []


def hash_words(words: list[bytes]) -> np.ndarray:
    """uint64 hash of each word, the same on every machine."""
    if not words:
        return np.empty(0, np.uint64)
    a = np.empty(len(words), object)
    a[:] = words
    return pd.util.hash_array(a, categorize=False)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 output bits (two xor-shift multiplies)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(PHI)
    return h ^ (h >> np.uint64(32))


def ngram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` word hashes, in text order (duplicates kept)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = h[:n].copy()
    for i in range(1, k):
        acc *= np.uint64(PHI)
        acc += h[i:i + n]
    return mix(acc)


def shingle_set(words: list[bytes], k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; fewer words than
    ``k`` make one shingle of the whole sequence; no words make none."""
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(ngram_hashes(hash_words(words), min(k, len(words))))
