"""Sorted integers in Golomb-Rice code, in whole-array steps."""

from __future__ import annotations

import numpy as np


def rice_bits(span: int, count: int) -> int:
    """The remainder's width for ``count`` values spread over ``span``."""
    return max(0, (max(1, span) // max(1, count)).bit_length() - 1)


def encode(values: np.ndarray, low: int, k: int) -> bytes:
    """Ascending distinct values from ``low`` on: all quotients of the gaps in unary, then all remainders."""
    gaps = np.diff(values, prepend=np.uint64(low)).astype(np.uint64)
    gaps[1:] -= np.uint64(1)
    ends = np.cumsum((gaps >> np.uint64(k)).astype(np.int64) + 1)
    unary = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    unary[ends - 1] = 1
    shifts = np.arange(k, dtype=np.uint64)
    rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
    return np.packbits(np.concatenate([unary, rest])).tobytes()


def decode(data: bytes, count: int, low: int, k: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(data, np.uint8))
    ends = np.flatnonzero(bits)[:count]
    length = int(ends[-1]) + 1 if count else 0
    high = np.diff(ends, prepend=-1).astype(np.uint64) - np.uint64(1)
    rest = bits[length : length + count * k].reshape(count, k).astype(np.uint64)
    low_bits = (rest << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    gaps = (high << np.uint64(k)) | low_bits
    gaps[1:] += np.uint64(1)
    return np.cumsum(gaps, dtype=np.uint64) + np.uint64(low)
