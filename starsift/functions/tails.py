"""Tail probabilities of the normal, Student t and chi-square laws.

Plain numpy over Arrow batches. They run on test results (one row per test or
per product), never on the reviews themselves.
"""

from __future__ import annotations

import math
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TINY = 1e-300
#: From these degrees of freedom on, the t tail is a normal tail at a corrected point.
_LARGE_DOF = 1e5


def _each(f, *values) -> np.ndarray:
    """A scalar function over arrays."""
    return np.array([f(*v) for v in zip(*values)], dtype=float)


def normal_upper(z) -> np.ndarray:
    """P(Z > z)."""
    return 0.5 * _each(math.erfc, np.atleast_1d(np.asarray(z, dtype=float)) / math.sqrt(2.0))


def _nonzero(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) < _TINY, _TINY, x)


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz); every row stops for itself."""
    out = np.ones_like(x)
    rows = np.arange(len(x))
    c = np.ones_like(x)
    d = 1.0 / _nonzero(1.0 - (a + b) * x / (a + 1.0))
    h = d.copy()
    before = np.full_like(x, np.inf)
    for m in count(1):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 / _nonzero(1.0 + term * d)
            c = _nonzero(1.0 + term / c)
            step = d * c
            h = h * step
        off = np.abs(step - 1.0)
        done = _settled(off, before) | np.isnan(off)
        out[rows[done]] = h[done]
        if done.all():
            return out
        rows, a, b, x, c, d, h, before = (v[~done] for v in (rows, a, b, x, c, d, h, off))


def _settled(off, before):
    """A fraction ends once a step changes a few last digits at most, or rounding keeps it from getting closer."""
    return (off < 4e-15) | ((off < 1e-11) & (off >= before))


def _half_step(a: float) -> float:
    """ln gamma(a + 1/2) - ln gamma(a), without cancellation for large a."""
    if a > 1e4:
        return 0.5 * math.log(a) - 1 / (8 * a) + 1 / (192 * a**3)
    return math.lgamma(a + 0.5) - math.lgamma(a)


def _normal_point(t: np.ndarray, dof: np.ndarray) -> np.ndarray:
    """Where the normal law has the tail that t has with many degrees of freedom (Hill 1970, three terms)."""
    a = dof - 0.5
    w = np.where(np.isinf(dof), np.abs(t), np.sqrt(np.where(np.isinf(dof), 1.0, a) * np.log1p(t * t / dof)))
    b = 48 * a * a
    third = (4 * w**7 + 33 * w**5 + 240 * w**3 + 855 * w) / (10 * b * (b + 0.8 * w**4 + 100))
    return w + (w**3 + 3 * w) / b - np.where(np.isinf(b), 0.0, third)


def t_two_sided(t, dof) -> np.ndarray:
    """P(|T| > |t|) with `dof` degrees of freedom; infinite t gives 0, undefined t stays undefined.

    The tail is the regularised incomplete beta function of (dof/2, 1/2) at
    dof / (dof + t^2); its fraction runs until it converges, and large counts
    take the normal law, where it would converge slowly.
    """
    t, dof = (np.array(v, dtype=float, ndmin=1) for v in np.broadcast_arrays(t, dof))
    if not t.size:
        return t
    defined = ~np.isnan(t) & ~np.isnan(dof) & (dof > 0)
    usable = defined & ~np.isinf(t) & (t != 0)
    squared = np.where(usable, t, 1.0) ** 2
    large = usable & (dof >= _LARGE_DOF)
    n = np.where(defined & ~large, dof, 1.0)
    squared = np.where(large, 1.0, squared)
    x, y = n / (n + squared), squared / (n + squared)
    a = n / 2.0
    front = np.exp(
        _each(_half_step, a) - 0.5 * math.log(math.pi) - a * np.log1p(squared / n) + 0.5 * np.log(y)
    )
    low = x < (a + 1.0) / (a + 2.5)
    half = np.full_like(a, 0.5)
    part = (
        front
        * _beta_fraction(np.where(low, a, half), np.where(low, half, a), np.where(low, x, y))
        / np.where(low, a, half)
    )
    p = np.where(low, part, 1.0 - part)
    if large.any():
        p[large] = 2 * normal_upper(_normal_point(t[large], dof[large]))
    p = np.where(np.isinf(t), 0.0, np.where(t == 0, 1.0, p))
    return np.where(defined, p, np.nan)


def _gamma_series(a: float, x: float) -> float:
    term = total = 1.0 / a
    n = a
    while abs(term) > abs(total) * 1e-16:
        n += 1.0
        term *= x / n
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _gamma_fraction(a: float, x: float) -> float:
    b = x + 1.0 - a
    c = 1.0 / _TINY
    d = 1.0 / b
    h = d
    off = math.inf
    for i in count(1):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = b + an / c
        c = c if abs(c) > _TINY else _TINY
        step = d * c
        h *= step
        before, off = off, abs(step - 1.0)
        if _settled(off, before) or math.isnan(off):
            break
    return h * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _chi_square_upper(x: float, dof: float) -> float:
    if math.isnan(x) or math.isnan(dof) or dof <= 0:
        return math.nan
    if x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    a, half = dof / 2.0, x / 2.0
    return 1.0 - _gamma_series(a, half) if half < a + 1.0 else _gamma_fraction(a, half)


def chi_square_upper(x, dof) -> np.ndarray:
    """P(X > x) of the chi-square law."""
    x, dof = (np.array(v, dtype=float, ndmin=1) for v in np.broadcast_arrays(x, dof))
    return _each(_chi_square_upper, x, dof)


@F.pandas_udf(T.DoubleType())
def normal_upper_p(z: pd.Series) -> pd.Series:
    return pd.Series(normal_upper(z.to_numpy(dtype=float)))


@F.pandas_udf(T.DoubleType())
def t_two_sided_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(t_two_sided(t.to_numpy(dtype=float), dof.to_numpy(dtype=float)))


@F.pandas_udf(T.DoubleType())
def chi_square_p(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(chi_square_upper(x.to_numpy(dtype=float), dof.to_numpy(dtype=float)))
