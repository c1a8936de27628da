"""Word shingles as 64-bit hashes, shared by the near-duplicate operators.

Words are maximal runs of characters outside ``[\\x20\\x09-\\x0D]`` after
lower-casing A-Z only: exactly what ``bytes.lower`` and ``bytes.split`` do.
"""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection on 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """One hash per word, in order. Null or blank text has no words."""
    if not text:
        return np.empty(0, np.uint64)
    words = text.encode("utf-8", "replace").lower().split()
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles of a text.

    With fewer than ``n`` words the whole sequence is the one shingle; without
    words the set is empty.
    """
    w = word_hashes(text)
    if len(w) == 0:
        return w
    span = min(n, len(w))
    last = len(w) - span + 1
    h = np.full(last, span, np.uint64) * _ODD
    for i in range(span):
        h = mix64(h + _ODD + w[i : i + last])
    return np.unique(h)
