"""Upper tails of the chi-square and F distributions, which Spark has no function for.

The chi-square tail with an even number of degrees is a finite sum and stays a column
expression. The others are evaluated by Arrow batches over small result tables.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def chi2_tail_even(q: Column, degrees: int) -> Column:
    """P(X > q) for an even number of degrees: exp(-q/2) * sum over i < d/2 of (q/2)^i / i!."""
    if degrees < 2 or degrees % 2:
        raise ValueError("degrees must be even and at least 2")
    half = q / 2
    out = F.exp(-half)
    for i in range(1, degrees // 2):
        out = out + F.exp(i * F.ln(half) - half - F.lit(math.lgamma(i + 1)))
    return F.when(q <= 0, F.lit(1.0)).otherwise(out)


def _beta_part(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if not 0.0 < x < 1.0:
        return float("nan") if math.isnan(x) else float(x >= 1.0)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_part(b, a, 1.0 - x)
    tiny, c = 1e-300, 1.0
    d = 1.0 / max(1.0 - (a + b) * x / (a + 1), tiny)
    f = d
    for m in range(1, 500):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            f *= d * c
        if abs(d * c - 1.0) < 1e-14:
            break
    front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    return math.exp(front) * f / a


def _f_upper(stat: float, d1: float, d2: float) -> float:
    if not (stat >= 0 and d1 > 0 and d2 > 0):
        return float("nan")
    return _beta_part(d2 / 2, d1 / 2, d2 / (d2 + d1 * stat))


@F.pandas_udf(T.DoubleType())
def f_tail(stat: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    """P(F > stat) with (d1, d2) degrees; for small result tables."""
    return pd.Series(np.array([_f_upper(*row) for row in zip(stat, d1, d2)], dtype=float))


def f_two_sided(stat: Column, d1: Column, d2: Column) -> Column:
    upper = f_tail(stat.cast("double"), d1.cast("double"), d2.cast("double"))
    return F.least(F.lit(1.0), 2 * F.least(upper, 1 - upper))
