"""Words of a batch of texts as numpy arrays: one pass over the batch's bytes, no loop over words.

A word's 64-bit hash is a polynomial over its bytes modulo 2^64 (difference of
prefix sums times an inverse power), mixed with its length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (public domain constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_P, _P_INV)):
            a = np.full(n, base, dtype=np.uint64)
            a[0] = 1
            _powers[k] = np.cumprod(a, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def batches(texts: Iterable[str | None], most: int = 1 << 21) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, UTF-8 texts) in groups of about ``most`` bytes; a longer text is a group of its own."""
    first, group, held = 0, [], 0
    for i, t in enumerate(texts):
        b = (t or "").encode("utf-8", "surrogatepass")
        if group and held + len(b) > most:
            yield first, group
            first, group, held = i, [], 0
        group.append(b)
        held += len(b)
    if group:
        yield first, group


def word_hashes(group: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word in order, words per text); A-Z lower-cased."""
    raw = np.frombuffer(b"\n".join(group) + b"\n", dtype=np.uint8)
    inside = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside))))  # raw ends with white space: edges pair up
    start, end = edge[0::2], edge[1::2]
    text_end = np.cumsum([len(b) + 1 for b in group])
    counts = np.diff(np.concatenate(([0], np.searchsorted(start, text_end))))
    power, inverse = _power(len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    h = (total[end] - total[start]) * inverse[start]
    return mix(h ^ ((end - start).astype(np.uint64) << np.uint64(48))), counts
