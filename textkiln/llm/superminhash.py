"""SuperMinHash signatures, vectorised over a batch of sets.

Every element ranks the ``k`` slots by a permutation of its own and offers
``rank + fraction`` to each slot; a slot keeps the least offer. Ranks within an
element are correlated (each is used once), which lowers the variance of the
estimate against independent hashes. Offers are made rank by rank: as soon as
all slots of a set hold less than the next rank, later ranks cannot win and the
set stops early, usually after a few ranks.

The permutations are affine maps over a prime field, ``slot = a * rank + b``:
a family that is uniform on every pair of slots, and which gives the slot of a
rank without storing the permutation.
"""

from __future__ import annotations

import numpy as np

from .shingles import mix64

_STEP = 0xD1342543DE82EF95
_SALT = np.uint64(0xA0761D6478BD642F)
_HIGH = np.uint64(32)


def is_prime(k: int) -> bool:
    return k > 1 and all(k % i for i in range(2, int(k**0.5) + 1))


def signatures(sets: list[np.ndarray], k: int) -> np.ndarray:
    """``len(sets) x k`` signatures (uint64); rows of empty sets are all ones."""
    if not is_prime(k):
        raise ValueError("the number of slots must be prime")
    n = len(sets)
    out = np.full(n * k, np.iinfo(np.uint64).max, np.uint64)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    if sizes.sum() == 0:
        return out.reshape(n, k)
    h = np.concatenate(sets)
    row = np.repeat(np.arange(n, dtype=np.int64), sizes)
    m = mix64(h ^ _SALT)
    a = (m & np.uint64(0xFFFFFFFF)).astype(np.int64) % (k - 1) + 1
    slot = (m >> _HIGH).astype(np.int64) % k
    live = np.arange(n)[sizes > 0]
    for rank in range(k):
        offer = (mix64(h + np.uint64((rank + 1) * _STEP % 2**64)) >> _HIGH) | (np.uint64(rank) << _HIGH)
        np.minimum.at(out, row * k + slot, offer)
        worst = out.reshape(n, k)[live].max(axis=1)
        still = worst >= (np.uint64(rank + 1) << _HIGH)
        if not still.all():
            live = live[still]
            if not len(live):
                break
            alive = np.zeros(n, bool)
            alive[live] = True
            keep = alive[row]
            h, row, a, slot = h[keep], row[keep], a[keep], slot[keep]
        slot = (slot + a) % k
    return out.reshape(n, k)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """``n x bands`` keys (int64), each a hash of the band's number and its rows."""
    n, k = sig.shape
    if bands * rows > k:
        raise ValueError("bands * rows must not exceed the number of slots")
    cells = sig[:, : bands * rows].reshape(n, bands, rows)
    key = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(_STEP)), (n, bands)).copy()
    for i in range(rows):
        key = mix64(key + _SALT + cells[:, :, i])
    return key.view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted distinct arrays."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both, len(a) + len(b) - both
