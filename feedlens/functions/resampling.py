"""Draws of whole counts from hashed uniforms: Poisson weights of collapsed users, and samples without replacement.

Every draw is a function of its key alone, so a retried task repeats it. Keys
are mixed from 32-bit halves as in ``functions.columns``; a number's place in the
stream is added before the last mix.

* ``poisson`` draws Poisson(n) for a whole n, which is the sum of n users' Poisson(1)
  weights: by inversion of the distribution function up to ``SMALL_MEAN``, above
  that by transformed rejection with squeeze (Hörmann 1993).
* ``hypergeometric`` draws how many of k users taken out of N come from a part
  with K of them. Values are tried outwards from the mode, so a draw takes about
  one standard deviation of steps; the mode's probability comes from saddle-point
  terms, which keep their digits for any N.
* ``split_sample`` deals a sample of k users over the cells of a table of counts (a
  multivariate hypergeometric draw): a binary tree over the cells splits the
  sample at each node. Cells that share no node with k left cost nothing.
"""

from __future__ import annotations

import math
import sys
from decimal import Decimal, localcontext
from functools import lru_cache

import numpy as np

try:  # ship this module's code with the functions, so workers need not import the package
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: workers import the package instead
    pass

SMALL_MEAN = 16
_M32, _GOLDEN32, _MIX32 = 0xFFFFFFFF, 0x9E3779B1, 0x45D9F3B


def _mix32(x):
    for _ in range(2):
        x = ((x ^ (x >> 16)) * _MIX32) & _M32
    return x ^ (x >> 16)


def draws(hi, lo, rep, number: int = 0):
    """32-bit draw ``number`` of repetition ``rep`` under a key of two halves; number 0 is ``columns.draw32``."""
    return _mix32((_mix32((lo + rep * _GOLDEN32) & _M32) + hi + number * _GOLDEN32) & _M32)


@lru_cache(maxsize=None)
def poisson_bounds(mean: int) -> tuple[int, ...]:
    """Upper bounds on a 32-bit draw for Poisson(mean) weights 0, 1, 2 ..., until the tail is below its resolution."""
    with localcontext() as ctx:
        ctx.prec = 60
        term, cdf, out, k = (-Decimal(mean)).exp(), Decimal(0), [], 0
        while 1 - (cdf + term) >= Decimal(2) ** -32:
            cdf += term
            out.append(int(cdf * 2**32))
            k += 1
            term = term * mean / k
    return tuple(out)


@lru_cache(maxsize=None)
def _stirling_table() -> np.ndarray:
    """log n! minus Stirling's formula, for small n."""
    n = np.arange(1, 64, dtype=float)
    exact = np.array([math.log(math.factorial(int(v))) for v in n])
    return np.r_[0.0, exact - ((n + 0.5) * np.log(n) - n + 0.5 * math.log(2 * math.pi))]


def _stirling_error(n: np.ndarray) -> np.ndarray:
    table, x = _stirling_table(), np.maximum(n, 16.0)
    series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * x * x)) / (x * x)) / (x * x)) / x
    return np.where(n < len(table), table[np.minimum(n, len(table) - 1).astype(np.int64)], series)


def log_factorial(n: np.ndarray) -> np.ndarray:
    x = np.maximum(n, 1.0)
    return np.where(n < 1, 0.0, (x + 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + _stirling_error(n))


def poisson(mean: int, hi: np.ndarray, lo: np.ndarray, reps: np.ndarray) -> np.ndarray:
    """Poisson(mean) weights, one for each (key, repetition); arrays of one shape."""
    if mean <= SMALL_MEAN:
        return np.searchsorted(np.array(poisson_bounds(mean), np.int64), draws(hi, lo, reps), side="right")
    root, log_mean = math.sqrt(mean), math.log(mean)
    b = 0.931 + 2.53 * root
    a = -0.059 + 0.02483 * b
    inverse_alpha = 1.1239 + 1.1328 / (b - 3.4)
    v_r = 0.9277 - 3.6224 / (b - 2)
    out, todo, attempt = np.zeros(hi.shape, np.int64), np.arange(hi.size), 0
    while todo.size:
        u = (draws(hi[todo], lo[todo], reps[todo], 2 * attempt) + 0.5) / 2.0**32 - 0.5
        v = (draws(hi[todo], lo[todo], reps[todo], 2 * attempt + 1) + 0.5) / 2.0**32
        us = 0.5 - np.abs(u)
        k = np.floor((2 * a / us + b) * u + mean + 0.43)
        possible = (k >= 0) & ~((us < 0.013) & (v > us))
        fits = np.log(v) + math.log(inverse_alpha) - np.log(a / (us * us) + b) <= \
            k * log_mean - mean - log_factorial(np.maximum(k, 0.0))
        taken = ((us >= 0.07) & (v <= v_r)) | (possible & fits)
        out[todo[taken]] = k[taken].astype(np.int64)
        todo, attempt = todo[~taken], attempt + 1
    return out


def _deviance(x: np.ndarray, m: np.ndarray) -> np.ndarray:
    """x log(x / m) + m - x for positive x."""
    d = (m - x) / x
    return x * (d - np.log1p(d))


def _log_binomial(x: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Log of the binomial probability of x out of n, from saddle-point terms."""
    inner = (x > 0) & (x < n)
    xs, ns = np.where(inner, x, 1.0), np.where(inner, n, 2.0)
    mid = (_stirling_error(ns) - _stirling_error(xs) - _stirling_error(ns - xs) - _deviance(xs, ns * p)
           - _deviance(ns - xs, ns * (1 - p)) + 0.5 * np.log(ns / (2 * math.pi * xs * (ns - xs))))
    return np.where(inner, mid, np.where(x <= 0, n * np.log1p(-p), n * np.log(p)))


def hypergeometric(total: np.ndarray, part: np.ndarray, taken: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """How many of ``taken`` out of ``total`` come from ``part`` of them; ``draw`` are 32-bit draws, arrays of one shape."""
    low, high = np.maximum(0, taken - (total - part)), np.minimum(part, taken)
    out = low.copy()
    todo = np.flatnonzero(low < high)
    if not todo.size:
        return out
    n, g, k = (v[todo].astype(float) for v in (total, part, taken))
    u = (draw[todo] + 0.5) / 2.0**32
    low, high = low[todo], high[todo]
    mode = np.clip(np.floor((k + 1) * (g + 1) / (n + 2)), low, high)
    p = k / n
    at_mode = np.exp(_log_binomial(mode, g, p) + _log_binomial(k - mode, n - g, p) - _log_binomial(k, n, p))
    out[todo] = mode  # also where rounding leaves a rest after the last value
    up, down, p_up, p_down = mode.copy(), mode.copy(), at_mode.copy(), at_mode.copy()
    u = u - at_mode
    left = np.flatnonzero(u >= 0)
    state = [v[left] for v in (up, down, p_up, p_down, u, n, g, k, low, high)] + [todo[left]]
    while state[0].size:
        up, down, p_up, p_down, u, n, g, k, low, high, place = state
        more = up < high
        p_up = np.where(more, p_up * (g - up) * (k - up) / ((up + 1) * np.maximum(n - g - k + up + 1, 1)), 0.0)
        up = up + more
        u = u - p_up
        found = more & (u < 0)
        out[place[found]] = up[found]
        less = ~found & (down > low)
        p_down = np.where(less, p_down * down * (n - g - k + down) / ((g - down + 1) * (k - down + 1)), 0.0)
        down = down - less
        u = u - p_down
        hit = less & (u < 0)
        out[place[hit]] = down[hit]
        go = ~found & ~hit & ((up < high) | (down > low))
        state = [v[go] for v in (up, down, p_up, p_down, u, n, g, k, low, high, place)]
    return out


def node_draws(offset: int, stream: np.ndarray, group: int, level: int, nodes: np.ndarray) -> np.ndarray:
    """32-bit draws of a tree's nodes on one level, for each stream (rows) and node (columns)."""
    base = _mix32((offset + stream * _GOLDEN32) & _M32)
    of_level = _mix32((base + group * _GOLDEN32 + level) & _M32)
    return _mix32((of_level[:, None] + nodes[None, :]) & _M32)


def split_sample(counts: np.ndarray, taken: np.ndarray, offset: int, stream: np.ndarray, group: int,
                 low: int = 0, first: int = 0, levels: int | None = None) -> np.ndarray:
    """For each stream (rows) how many of its ``taken`` users come from each cell (columns).

    ``counts`` are the cells' users. Cell i is node ``first + i`` of level ``low`` of the
    tree; ``levels`` says how far above it the root is. Cells of a table may thus be
    split in two goes, ranges first and then the cells of a range, with the same result.
    """
    m = len(counts)
    if levels is None:
        levels = max(0, (m - 1).bit_length())
    total = np.r_[0, np.cumsum(counts, dtype=np.int64)]
    held = taken.astype(np.int64)[:, None]
    for up in range(levels, 0, -1):
        size = 1 << up
        nodes = np.arange((m + size - 1) // size)
        begin, mid, end = (total[np.minimum(nodes * size + s, m)] for s in (0, size // 2, size))
        shape = held.shape
        draw = node_draws(offset, stream, group, low + up, (first >> up) + nodes)
        left = hypergeometric(np.broadcast_to(end - begin, shape).ravel(), np.broadcast_to(mid - begin, shape).ravel(),
                              held.ravel(), draw.ravel()).reshape(shape)
        held = np.stack([left, held - left], axis=2).reshape(shape[0], -1)[:, :(m + size // 2 - 1) // (size // 2)]
    return held
