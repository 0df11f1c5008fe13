"""Tail probabilities as vectorised UDFs; the statistics themselves are Spark expressions."""

from __future__ import annotations

import math

from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_lgamma = np.frompyfunc(math.lgamma, 1, 1)


def lgamma(x) -> np.ndarray:
    return np.asarray(_lgamma(np.asarray(x, dtype=float)), dtype=float)


def beta_inc(a, b, x) -> np.ndarray:
    """Regularised incomplete beta by the continued fraction (modified Lentz)."""
    a, b, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x))
    swap = x > (a + 1) / (a + b + 2)
    p, q, z = np.where(swap, b, a), np.where(swap, a, b), np.clip(np.where(swap, 1 - x, x), 0, 1)
    tiny = 1e-300
    c = np.ones_like(z)
    d = 1 - (p + q) * z / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 400):
        for num in (m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)),
                    -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1 + num * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + num / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
        if np.all(np.abs(d * c - 1) < 1e-15):
            break
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(lgamma(p + q) - lgamma(p) - lgamma(q) + p * np.log(z) + q * np.log1p(-z)) / p
    out = np.where(z <= 0, 0.0, np.where(z >= 1, 1.0, front * h))
    return np.where(swap, 1 - out, out)


def gamma_sf(a, x) -> np.ndarray:
    """Upper regularised incomplete gamma: series below a+1, continued fraction above."""
    a, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, x))
    safe = np.maximum(x, 1e-300)
    front = np.exp(-safe + a * np.log(safe) - lgamma(a))
    term = total = 1 / a
    for n in range(1, 500):
        term = term * safe / (a + n)
        total = total + term
    series = 1 - front * total
    b = safe + 1 - a
    c, d = np.full_like(b, 1e300), 1 / np.where(b == 0, 1e-300, b)
    h = d.copy()
    for i in range(1, 500):
        an = -i * (i - a)
        b = b + 2
        d = an * d + b
        d = 1 / np.where(np.abs(d) < 1e-300, 1e-300, d)
        c = b + an / c
        c = np.where(np.abs(c) < 1e-300, 1e-300, c)
        h = h * d * c
    return np.where(x <= 0, 1.0, np.clip(np.where(x < a + 1, series, front * h), 0, 1))


@F.pandas_udf(DoubleType())
def t_two_sided(t: pd.Series, dof: pd.Series) -> pd.Series:
    """Two-sided p of Student's t."""
    tt, v = t.to_numpy(float), np.maximum(dof.to_numpy(float), 1e-12)
    return pd.Series(np.where(np.isnan(tt), np.nan, beta_inc(v / 2, 0.5, v / (v + tt * tt))))


@F.pandas_udf(DoubleType())
def chi_square_sf(x: pd.Series, dof: pd.Series) -> pd.Series:
    """Upper tail of the chi-square distribution."""
    xx = x.to_numpy(float)
    out = gamma_sf(np.maximum(dof.to_numpy(float), 1e-12) / 2, np.nan_to_num(xx) / 2)
    return pd.Series(np.where(np.isnan(xx), np.nan, out))


@F.pandas_udf(DoubleType())
def hypergeometric_tail(k: pd.Series, drawn: pd.Series, good: pd.Series, total: pd.Series) -> pd.Series:
    """P(X >= k) for `drawn` draws without return from `total` items of which `good` count."""
    k, n, g, m = (c.to_numpy(np.int64) for c in (k, drawn, good, total))
    out = np.zeros(len(k))
    least, top = np.maximum(0, n + g - m), np.minimum(n, g)
    out[k <= least] = 1.0
    rows = np.flatnonzero((k > least) & (k <= top))
    if not len(rows):
        return pd.Series(out)
    k, n, g, m, least, top = (v[rows] for v in (k, n, g, m, least, top))
    up = k > (n + 1) * (g + 1) / (m + 2)  # on the far side of the mode terms fall upwards, else downwards; the shorter tail is summed
    x = np.where(up, k, k - 1)
    lf = lambda v: np.array([lgamma(a + 1.0) for a in v.tolist()])
    choose = lambda a, b: lf(a) - lf(b) - lf(a - b)
    term = np.exp(choose(g, x) + choose(m - g, n - x) - choose(m, n))
    total_ = term.copy()
    open_ = np.flatnonzero(np.where(up, x < top, x > least))
    while len(open_):  # each term follows from the one before; a row ends with its range, or when a term adds nothing any more
        i, nn, gg, mm = x[open_], n[open_], g[open_], m[open_]
        rise = (gg - i) * (nn - i) / ((i + 1.0) * (mm - gg - nn + i + 1.0))
        fall = i * (mm - gg - nn + i) / ((gg - i + 1.0) * (nn - i + 1.0))
        term[open_] *= np.where(up[open_], rise, fall)
        x[open_] += np.where(up[open_], 1, -1)
        total_[open_] += term[open_]
        more = (term[open_] > 1e-17 * total_[open_]) & np.where(up[open_], x[open_] < top[open_], x[open_] > least[open_])
        open_ = open_[more]
    out[rows] = np.clip(np.where(up, total_, 1 - total_), 0, 1)
    return pd.Series(out)


def pooled_t(n1: Column, mean1: Column, var1: Column, n2: Column, mean2: Column, var2: Column) -> Column:
    """Student's t with pooled variance; `var` is the sample variance."""
    sp = ((n1 - 1) * var1 + (n2 - 1) * var2) / (n1 + n2 - 2)
    return (mean1 - mean2) / F.sqrt(sp * (F.lit(1.0) / n1 + F.lit(1.0) / n2))
