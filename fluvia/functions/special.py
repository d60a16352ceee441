"""Tails of distributions. Integer cases are finite sums; fractional ones use Arrow batches."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _log_choose(n: Column, k: Column) -> Column:
    """Sum of logs; n is a count of dates, so the sum is short."""
    steps = F.when(k > 0, F.sequence(F.lit(1), k.cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, F.lit(0.0), lambda a, j: a + F.log((n - k + j) / j))


def binomial_upper(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) >= k) for integer columns."""
    terms = F.when(k <= n, F.sequence(k.cast("int"), n.cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(terms, F.lit(0.0), lambda a, j: a + F.exp(_log_choose(n, j) + j * math.log(p) + (n - j) * math.log(1 - p)))


def label_confidence(k: Column, n: Column, fmin: float = 0.5) -> Column:
    """Probability that the share behind k of n lies on the side of fmin that k/n does; NULL for n = 0."""
    below = binomial_upper(k + 1, n + 1, fmin)
    return F.when(n > 0, F.when(k / n >= fmin, 1 - below).otherwise(below))


def hypergeometric_upper(x: Column, total: Column, good: Column, drawn: Column) -> Column:
    """P(X >= x) of good ones among drawn out of total."""
    low, high = F.greatest(x, drawn + good - total, F.lit(0)), F.least(good, drawn)
    terms = F.when(low <= high, F.sequence(low.cast("int"), high.cast("int"))).otherwise(F.array().cast("array<int>"))
    every = _log_choose(total, drawn)
    return F.aggregate(terms, F.lit(0.0), lambda a, j: a + F.exp(_log_choose(good, j) + _log_choose(total - good, drawn - j) - every))


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised I_x(a, b) by the continued fraction of modified Lentz steps."""
    a, b, x = (np.asarray(v, float) for v in np.broadcast_arrays(a, b, x))
    lgamma = np.vectorize(math.lgamma, otypes=[float])
    swap = x > (a + 1) / (a + b + 2)
    p, q, z = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(lgamma(p + q) - lgamma(p) - lgamma(q) + p * np.log(z) + q * np.log1p(-z)) / p
    tiny = 1e-300
    c, d = np.ones_like(z), 1 / np.where(np.abs(1 - (p + q) * z / (p + 1)) < tiny, tiny, 1 - (p + q) * z / (p + 1))
    h = d.copy()
    for m in range(1, 300):
        for num in (m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1 + num * d
            c = 1 + num / c
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = np.where(np.abs(c) < tiny, tiny, c)
            h *= d * c
    v = np.where(z <= 0, 0.0, np.where(z >= 1, 1.0, front * h))
    return np.where(swap, 1 - v, v)


@F.pandas_udf(DoubleType())
def student_upper(t: pd.Series, df: pd.Series) -> pd.Series:
    """P(T > t)."""
    x = t.to_numpy(float)
    tail = incomplete_beta(df.to_numpy(float) / 2, 0.5, df / (df + x * x)) / 2
    return pd.Series(np.where(np.isnan(x), np.nan, np.where(x >= 0, tail, 1 - tail)))


@F.pandas_udf(DoubleType())
def normal_upper(z: pd.Series) -> pd.Series:
    return z.map(lambda v: 0.5 * math.erfc(v / math.sqrt(2)) if v == v else None)


@F.pandas_udf(DoubleType())
def normal_quantile_upper(p: pd.Series) -> pd.Series:
    """z with P(Z > z) = p, for p floored at 1e-300 and z clipped to +-40."""
    from statistics import NormalDist

    unit = NormalDist()
    return p.map(lambda v: None if v != v else 40.0 if v < 1e-300 else max(-40.0, min(40.0, -unit.inv_cdf(min(v, 1 - 1e-16)))))
