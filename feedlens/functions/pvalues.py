"""Two-sided p-values for the test statistics.

Spark has no t or normal CDF, so these are the only Python UDFs in the
library. They are Arrow-batched pandas UDFs applied to result rows (one per
test, or one per A/A simulation), never to raw events. The maths is numpy:
the regularized incomplete beta function by Lentz's continued fraction, and
the complementary error function from the standard library.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship this module's code with the UDFs (by value), so Python workers do not
# need the package on their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: workers import the package instead
    pass

_EPS = 1e-15
_TINY = 1e-300
_MAX_ITER = 400


def _beta_cf(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (vectorized Lentz)."""
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < _TINY, _TINY, d)
    d = 1.0 / d
    h = d.copy()
    done = np.zeros(x.shape, dtype=bool)
    for m in range(1, _MAX_ITER + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < _TINY, _TINY, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        d = 1.0 / d
        h = np.where(done, h, h * d * c)
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < _TINY, _TINY, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        d = 1.0 / d
        delta = d * c
        h = np.where(done, h, h * delta)
        done |= np.abs(delta - 1.0) < _EPS
        if done.all():
            break
    return h


_LARGE = 1e4


def log_gamma_ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log Gamma(a + b) - log Gamma(a); by the series in 1/a where a is large,
    since the difference of two large logarithms loses its digits."""
    lg = np.vectorize(math.lgamma, otypes=[float])
    out = np.empty(a.shape)
    large = a > _LARGE
    if (~large).any():
        out[~large] = lg(a[~large] + b[~large]) - lg(a[~large])
    if large.any():
        u, v = a[large], b[large]
        out[large] = (v * np.log(u) + v * (v - 1) / (2 * u) - v * (v - 1) * (2 * v - 1) / (12 * u**2)
                      + (v * (v - 1)) ** 2 / (12 * u**3))
    return out


def betainc_regularized(a, b, x, complement=None) -> np.ndarray:
    """I_x(a, b) for arrays; NaN where an input is NaN or out of range. Pass
    ``complement`` = 1 - x where it is known more exactly than x."""
    complement = 1.0 - np.asarray(x, dtype=float) if complement is None else complement
    a, b, x, y = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x, complement))
    out = np.full(x.shape, np.nan)
    ok = np.isfinite(a) & np.isfinite(b) & np.isfinite(x) & (a > 0) & (b > 0) & (x >= 0) & (x <= 1)
    out[ok & (x == 0)] = 0.0
    out[ok & (y == 0)] = 1.0
    inner = ok & (x > 0) & (y > 0) & (x <= 1)
    if inner.any():
        ai, bi, xi, yi = a[inner], b[inner], x[inner], y[inner]
        lg = np.vectorize(math.lgamma, otypes=[float])
        log_x = np.where(xi < 0.5, np.log(xi), np.log1p(-np.minimum(yi, 0.5)))
        log_front = log_gamma_ratio(ai, bi) - lg(bi) + ai * log_x + bi * np.log(yi)
        front = np.exp(log_front)
        direct = xi < (ai + 1.0) / (ai + bi + 2.0)
        res = np.empty(xi.shape)
        if direct.any():
            res[direct] = front[direct] * _beta_cf(ai[direct], bi[direct], xi[direct]) / ai[direct]
        flip = ~direct
        if flip.any():
            res[flip] = 1.0 - front[flip] * _beta_cf(bi[flip], ai[flip], yi[flip]) / bi[flip]
        out[inner] = res
    return out


# From so many degrees of freedom on, the expansion around the normal law is
# more exact than the continued fraction, which needs about sqrt(df) terms.
_NEAR_NORMAL = 2e5


def student_t_two_sided(t, df) -> np.ndarray:
    """P(|T| >= |t|) for Student's t with df degrees of freedom (df may be fractional)."""
    t, df = np.broadcast_arrays(np.abs(np.asarray(t, dtype=float)), np.asarray(df, dtype=float))
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        near = df > _NEAR_NORMAL
        d = np.where(near, np.nan, df)
        p = betainc_regularized(d / 2.0, 0.5, d / (d + t * t), t * t / (d + t * t))
        # Fisher's expansion in 1/df of the tail around the normal tail
        u, n = np.where(near & np.isfinite(t), t, 0.0), np.where(near, df, 1.0)
        terms = u * (u**2 + 1) / (4 * n) + u * (3 * u**6 - 7 * u**4 - 5 * u**2 - 3) / (96 * n**2)
        tail = normal_two_sided_upper(u) + 2 * np.exp(-u * u / 2) / math.sqrt(2 * math.pi) * terms
        p = np.where(near & np.isfinite(t), tail, p)
    p = np.where(np.isinf(t) & (df > 0), 0.0, p)
    return np.clip(p, 0.0, 1.0)


def normal_two_sided_upper(z) -> np.ndarray:
    """2 * P(Z >= z), clipped to [0, 1] (the Mann-Whitney convention: z is
    computed from the larger U, so it is rarely negative)."""
    z = np.asarray(z, dtype=float)
    out = np.full(z.shape, np.nan)
    ok = ~np.isnan(z)
    erfc = np.vectorize(math.erfc, otypes=[float])
    out[ok] = erfc(z[ok] / math.sqrt(2.0))
    return np.clip(out, 0.0, 1.0)


EXACT_MAX = 8  # fixed value: the exact law is used when a group has at most 8 values and no ties


def _u_counts(m: int, n: int) -> list[int]:
    """Number of orderings of m + n distinct values giving U = 0 .. m*n
    (the coefficients of the Gaussian binomial [m + n choose m])."""
    coef = [1] + [0] * (m * n)
    for i in range(1, m + 1):
        # multiply by (1 - q^(n + i)), then divide by (1 - q^i)
        for k in range(m * n, n + i - 1, -1):
            coef[k] -= coef[k - n - i]
        for k in range(i, m * n + 1):
            coef[k] += coef[k - i]
    return coef


# The exact law counts orderings over m * n + 1 values of U in one Python process.
EXACT_TABLE = 2_000_000


def mann_whitney_exact_p(u_a: float, u_b: float, n_a: int, n_b: int) -> float:
    """Two-sided exact p-value: 2 * P(U >= max(u_a, u_b)), clipped to 1."""
    m, n = sorted((int(n_a), int(n_b)))
    if m * n > EXACT_TABLE:
        raise ValueError(f"exact Mann-Whitney law for groups of {m} and {n} values: pass method='asymptotic'")
    u = int(round(max(u_a, u_b)))
    coef = _u_counts(m, n)
    return min(1.0, 2.0 * (sum(coef[u:]) / sum(coef)))


def mann_whitney_method(n_a: Column, n_b: Column, tie_sum: Column, method: str = "auto") -> Column:
    """The law behind the p-value: 'exact' or 'asymptotic'. ``auto`` is the
    study's rule (scipy's default): exact when a group has at most 8 values and
    there are no ties."""
    if method == "auto":
        small = (F.least(n_a, n_b) <= EXACT_MAX) & (F.least(n_a, n_b) > 0)
        return F.when(small & (tie_sum == 0), F.lit("exact")).otherwise(F.lit("asymptotic"))
    if method == "exact":
        # the count of orderings does not cover ties
        tied = F.raise_error(F.lit("exact Mann-Whitney law asked for values with ties"))
        return F.when(tie_sum > 0, tied).otherwise(F.lit("exact"))
    if method != "asymptotic":
        raise ValueError(f"method {method!r}: use 'auto', 'exact' or 'asymptotic'")
    return F.lit("asymptotic")


@F.pandas_udf(T.DoubleType())
def _mw_p_udf(u_a: pd.Series, u_b: pd.Series, n_a: pd.Series, n_b: pd.Series,
              method: pd.Series, z: pd.Series) -> pd.Series:
    out = normal_two_sided_upper(z.to_numpy(dtype=float, na_value=np.nan))
    for i in range(len(out)):
        if method.iat[i] == "exact":
            out[i] = mann_whitney_exact_p(u_a.iat[i], u_b.iat[i], n_a.iat[i], n_b.iat[i])
    return pd.Series(out)


def mann_whitney_p_value(u_a: Column, u_b: Column, n_a: Column, n_b: Column,
                         method: Column, z: Column) -> Column:
    """The law named by ``method`` ('exact' or 'asymptotic')."""
    return _mw_p_udf(u_a, u_b, n_a, n_b, method, z)


@F.pandas_udf(T.DoubleType())
def _t_p_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(student_t_two_sided(t.to_numpy(dtype=float, na_value=np.nan),
                                         df.to_numpy(dtype=float, na_value=np.nan)))


@F.pandas_udf(T.DoubleType())
def _z_p_udf(z: pd.Series) -> pd.Series:
    return pd.Series(normal_two_sided_upper(z.to_numpy(dtype=float, na_value=np.nan)))


def t_test_p_value(t: Column, df: Column) -> Column:
    return _t_p_udf(t, df)


def normal_p_value(z: Column) -> Column:
    return _z_p_udf(z)


def decision(p: Column, alpha: float = 0.05) -> Column:
    """Reject the null hypothesis when p < alpha (strictly)."""
    return (F.when(p.isNull(), F.lit(None).cast("string"))
            .when(p < alpha, F.lit("rejected"))
            .otherwise(F.lit("not rejected")))
