"""Tails of distributions: as expressions where a row of a large table needs them, in numpy where only results do."""

from __future__ import annotations

import math
from functools import lru_cache, reduce

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Coefficients of a rational approximation of erfc (relative error below 1.2e-7).
ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def neg_log10_kolmogorov(d: Column, n_e: Column, terms: int = 100) -> Column:
    """-log10 of the two-sided asymptotic p-value. The first term's exponent is taken out of the alternating series, so tiny p-values stay finite; 0 at d = 0."""
    m = -2.0 * n_e * d * d
    rest = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), lambda a, k: a + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(m * (k * k - 1)))
    value = -(math.log10(2.0) + m / math.log(10.0) + F.when(rest > 0, F.log10(rest)))
    return F.when(d.isNull() | n_e.isNull(), None).otherwise(F.greatest(F.lit(0.0), F.coalesce(value, F.lit(0.0))))


def log_erfc(x: Column) -> Column:
    """ln erfc(x) for x >= 0, never leaving the log scale."""
    t = 1.0 / (1.0 + 0.5 * x)
    poly = reduce(lambda acc, c: F.lit(c) + t * acc, reversed(ERFC[:-1]), F.lit(ERFC[-1]))
    return F.log(t) - x * x + poly


def neg_log10_two_sided_normal(z: Column) -> Column:
    return F.greatest(F.lit(0.0), -log_erfc(F.abs(z) / math.sqrt(2.0)) / math.log(10.0))


def normal_cdf(z: Column) -> Column:
    tail = F.exp(log_erfc(F.abs(z) / math.sqrt(2.0)))
    return 1.0 - 0.5 * F.when(z >= 0, tail).otherwise(2.0 - tail)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Lentz's continued fraction of the incomplete beta function."""
    tiny, c = 1e-300, 1.0
    d = 1.0 / (1 - (a + b) * x / (a + 1) or tiny)
    h = d
    for m in range(1, 500):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 / (1 + step * d or tiny)
            c = 1 + step / c or tiny
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if not 0 < x < 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_fraction(b, a, 1 - x) / b


def f_sf(f: float, dfn: float, dfd: float) -> float:
    if math.isnan(f):
        return math.nan
    if math.isinf(f):
        return 0.0
    return 1.0 if f <= 0 else beta_inc(dfd / 2, dfn / 2, dfd / (dfd + dfn * f))


_erf = np.frompyfunc(math.erf, 1, 1)
#: Ranges of standard normals are tabulated up to here, in steps of STEP; beyond, their distribution is 1 but for rounding.
WIDEST, STEP = 24.0, 0.01


def _normal(v: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + _erf(v / math.sqrt(2)).astype(float))


@lru_cache(1)
def _nodes():
    return np.polynomial.legendre.leggauss(160)


@lru_cache(512)
def _range_table(k: float) -> tuple[np.ndarray, np.ndarray]:
    """The distribution of the range of k standard normals at 0, STEP, .. WIDEST, and its slope."""
    x, w = _nodes()
    z, phi = 8.5 * x, np.exp(-((8.5 * x) ** 2) / 2) / math.sqrt(2 * math.pi)
    at = np.arange(round(WIDEST / STEP) + 1) * STEP
    below = z[None, :] - at[:, None]
    between = np.clip(_normal(z)[None, :] - _normal(below), 0, 1)
    value = k * (between ** (k - 1) * (phi * 8.5 * w)).sum(1)
    slope = k * (k - 1) * (between ** (k - 2) * np.exp(-below * below / 2) / math.sqrt(2 * math.pi) * (phi * 8.5 * w)).sum(1)
    return value, slope


def _range_cdf(w: np.ndarray, k: float) -> np.ndarray:
    """Between table points by the cubic that has their values and slopes (error below 1e-10)."""
    value, slope = _range_table(float(k))
    at = np.minimum(w / STEP, len(value) - 1.000001)
    i = at.astype(np.int64)
    t = at - i
    a, b = value[i], value[i + 1]
    c, d = slope[i] * STEP, slope[i + 1] * STEP
    return np.clip(a + t * (c + t * (3 * (b - a) - 2 * c - d + t * (2 * (a - b) + c + d))), 0, 1)


def studentized_range_sf_many(q: np.ndarray, k: float, df: float) -> np.ndarray:
    """P(range of k normals / independent s > q) for many q at once: s by Gauss-Legendre, the range from its table."""
    x, w = _nodes()
    # s is sqrt(chi2 / df): around 1 with a spread of 1 / sqrt(2 df)
    low, high = max(0.0, 1 - 12 / math.sqrt(2 * df)), 1 + 14 / math.sqrt(2 * df)
    s, ws = (high - low) / 2 * x + (high + low) / 2, (high - low) / 2 * w
    log_density = math.log(2) + df / 2 * math.log(df / 2) - math.lgamma(df / 2) + (df - 1) * np.log(s) - df * s * s / 2
    weight = ws * np.exp(log_density)
    out = np.full(len(q), np.nan)
    out[q <= 0] = 1.0
    for at in np.array_split(np.flatnonzero(q > 0), max(1, len(q) // 20_000)):
        out[at] = np.clip(((1 - _range_cdf(q[at][:, None] * s[None, :], k)) * weight).sum(1), 0, 1)
    return out


def studentized_range_sf(q: float, k: float, df: float) -> float:
    return float(studentized_range_sf_many(np.array([q], float), k, df)[0])


def mann_whitney_greater(x: np.ndarray, y: np.ndarray) -> float:
    """One-sided p-value that x tends to be larger: exact where there are no ties and one side has at most 8 values, else normal with ties and continuity."""
    n, m = len(x), len(y)
    if not n or not m:
        return math.nan
    both = np.concatenate([x, y])
    values, inverse, counts = np.unique(both, return_inverse=True, return_counts=True)
    upto = np.cumsum(counts)
    rank = (upto - (counts - 1) / 2)[inverse]
    u = rank[:n].sum() - n * (n + 1) / 2
    if min(n, m) <= 8 and len(values) == len(both):
        ways = np.zeros((n + 1, n * m + 1))
        ways[0, 0] = 1
        for j in range(1, n + m + 1):  # ways to draw i of the first j ranks with rank sum excess u
            for i in range(min(j, n), 0, -1):
                shift = j - i
                if shift <= m:
                    ways[i, shift:] += ways[i - 1, : n * m + 1 - shift]
        return float(ways[n, int(u):].sum() / math.comb(n + m, n))
    total = n + m
    var = n * m / 12 * (total + 1 - (counts**3 - counts).sum() / (total * (total - 1)))
    return 0.5 * math.erfc((u - n * m / 2 - 0.5) / math.sqrt(2 * var)) if var > 0 else 1.0
