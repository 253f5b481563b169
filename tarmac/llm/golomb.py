"""Golomb-Rice coding of sorted 64-bit integers (numpy, no loop over the values)."""

from __future__ import annotations

import numpy as np


def encode(values: np.ndarray) -> tuple[int, bytes]:
    """(Rice parameter, code) of strictly increasing unsigned integers below 2^62.

    Gaps are split into a quotient, written in unary, and a remainder of k
    bits; k is the binary logarithm of the mean gap.
    """
    if not len(values):
        return 0, b""
    gaps = np.diff(np.concatenate((np.zeros(1, dtype=np.uint64), values.astype(np.uint64))))
    k = max(0, int(values[-1]) // len(values)).bit_length()
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.zeros(int(quotient.sum()) + len(gaps), dtype=np.uint8)
    unary[np.cumsum(quotient + 1) - 1] = 1
    rest = np.empty((len(gaps), k), dtype=np.uint8)
    for j in range(k):
        rest[:, j] = (gaps >> np.uint64(k - 1 - j)) & np.uint64(1)
    return k, np.packbits(np.concatenate((unary, rest.ravel()))).tobytes()


def decode(n: int, k: int, code: bytes) -> np.ndarray:
    """The ``n`` integers that ``encode`` was given."""
    if not n:
        return np.empty(0, dtype=np.uint64)
    bits = np.unpackbits(np.frombuffer(code, dtype=np.uint8))
    ends = np.flatnonzero(bits)[:n]   # the unary part comes first: its n ones end the quotients
    gaps = np.diff(np.concatenate(([-1], ends))).astype(np.uint64) - np.uint64(1)
    rest = bits[ends[-1] + 1:ends[-1] + 1 + n * k].reshape(n, k)
    for j in range(k):
        gaps = (gaps << np.uint64(1)) | rest[:, j].astype(np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)
