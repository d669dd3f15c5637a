"""Keyed permutations of 0 .. n-1, evaluated only where they are asked for.

A Feistel network permutes the numbers of 2h bits; numbers that land at n or
beyond are sent through it again until they fall below n (cycle walking), which
leaves a permutation of 0 .. n-1. The domain is less than 4n, so a number needs
fewer than four passes on average, whatever n is.
"""

from __future__ import annotations

import sys

import numpy as np

try:  # ship this module's code with the functions, so workers need not import the package
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: workers import the package instead
    pass

ROUNDS = 6
_M32, _GOLDEN32, _MIX32 = 0xFFFFFFFF, 0x9E3779B1, 0x45D9F3B


def _mix32(x):
    for _ in range(2):
        x = ((x ^ (x >> 16)) * _MIX32) & _M32
    return x ^ (x >> 16)


def half_bits(n: int) -> int:
    """Bits of each Feistel half for numbers below n."""
    return max(1, ((n - 1).bit_length() + 1) // 2)


def round_keys(offset: int, stream, group: int) -> list:
    """Keys of the rounds of permutation (stream, group) under a salt's offset;
    ``stream`` is a number or an array of numbers."""
    base = _mix32((offset + stream * _GOLDEN32) & _M32)
    return [_mix32((base + group * _GOLDEN32 + r) & _M32) for r in range(ROUNDS)]


def permuted(index: np.ndarray, n: int, keys: list) -> np.ndarray:
    """Images of ``index`` (numbers below n); ``keys`` are numbers, or arrays with
    a key for each index."""
    keys = [np.broadcast_to(k, index.shape) for k in keys]
    half = half_bits(n)
    mask = (1 << half) - 1
    x = index.astype(np.int64)
    todo = np.arange(len(x))
    while todo.size:
        left, right = x[todo] >> half, x[todo] & mask
        for key in keys:
            left, right = right, left ^ (_mix32((right + key[todo]) & _M32) & mask)
        x[todo] = (left << half) | right
        todo = todo[x[todo] >= n]
    return x
