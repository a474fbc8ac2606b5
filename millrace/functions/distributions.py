"""Tail probabilities for test statistics, applied to the few result rows of a test.

The incomplete beta and gamma functions are shares of one integral: of the part up to a point in
the whole. In the logarithm of the odds, or of the value, the integrand has a single peak and
smooth sides at any parameters. Both parts are summed over Gauss-Legendre panels relative to the
peak, so no gamma function is needed and no digits are lost at very many degrees of freedom.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

PANELS, NODES, NEGLIGIBLE = 160, 12, -46.0


def _integral(log_density: Callable[[np.ndarray], np.ndarray], low: float, high: float, scale: float) -> float:
    """The logarithm of the integral of exp(log_density) over [low, high]."""
    if not low < high:
        return -math.inf
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    edges = np.linspace(low, high, PANELS + 1)
    half = np.diff(edges) / 2
    values = log_density((edges[:-1] + half)[:, None] + half[:, None] * nodes[None, :])
    top = values.max()
    return top + math.log(float((np.exp(values - top) * weights).sum(axis=1) @ half) / scale)


def _share_below(log_density: Callable[[np.ndarray], np.ndarray], point: float, scale: float) -> float:
    """The share of the integral below ``point``; the peak lies at 0 with height 1 and width ``scale``."""

    def end(start: float, side: int) -> float:
        """Where the density has become negligible beside that at ``start``."""
        floor, step = float(log_density(np.array(start))) + NEGLIGIBLE, scale
        while float(log_density(np.array(start + side * step))) > floor:
            step *= 2
        near = step / 2 if step > scale else 0.0
        for _ in range(20):
            middle = (near + step) / 2
            if float(log_density(np.array(start + side * middle))) > floor:
                near = middle
            else:
                step = middle
        return start + side * step

    if math.isinf(point):
        return float(point > 0)
    upper = _integral(log_density, 0.0, end(0.0, 1), scale)
    lower = _integral(log_density, end(0.0, -1), 0.0, scale)
    whole = np.logaddexp(lower, upper)
    if point <= 0:
        return float(np.exp(_integral(log_density, end(point, -1), point, scale) - whole))
    return float(np.exp(np.logaddexp(lower, _integral(log_density, 0.0, min(point, end(0.0, 1)), scale)) - whole))


def odds_share(h: float, a: float, b: float) -> float:
    """P(log odds of a beta(a, b) value < log(a / b) + h)."""
    low, high = a / (a + b), b / (a + b)

    def log_density(x: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            below = np.where(x < -600, -x + math.log(high) if high else 0.0, np.log1p(high * np.expm1(-np.maximum(x, -600))))
            above = np.where(x > 600, x + math.log(low) if low else 0.0, np.log1p(low * np.expm1(np.minimum(x, 600))))
        return -a * below - b * above

    return _share_below(log_density, h, math.sqrt(1 / a + 1 / b))


def gamma_tail(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0:
        return 1.0

    def log_density(h: np.ndarray) -> np.ndarray:
        # seen from the tail, so that h counts downwards
        up = -h
        small = -up * up * (1 / 2 + up * (1 / 6 + up * (1 / 24 + up * (1 / 120 + up / 720))))
        return a * np.where(np.abs(up) < 1e-2, small, up - np.expm1(np.minimum(up, 700.0)))

    return _share_below(log_density, -math.log(x / a), 1 / math.sqrt(a))


def normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def t_two_sided(t: float, df: float) -> float:
    return odds_share(-2 * math.log(abs(t)), df / 2, 0.5) if t else 1.0


def f_tail(f: float, df1: float, df2: float) -> float:
    return odds_share(-math.log(f), df2 / 2, df1 / 2) if f > 0 else 1.0


def chi2_tail(x: float, df: float) -> float:
    return gamma_tail(df / 2, x / 2)


def t_critical(df: float, alpha: float = 0.05) -> float:
    """Two-sided critical value by bisection."""
    low, high = 0.0, 1.0
    while t_two_sided(high, df) > alpha:
        high *= 2
    while (middle := (low + high) / 2) not in (low, high):
        if t_two_sided(middle, df) > alpha:
            low = middle
        else:
            high = middle
    return (low + high) / 2


def _column(function: Callable, *series: pd.Series) -> pd.Series:
    rows = zip(*[s.to_numpy(dtype=float) for s in series])
    return pd.Series([np.nan if any(map(math.isnan, row)) else function(*row) for row in rows], dtype=float)


@F.pandas_udf(T.DoubleType())
def t_two_sided_column(t: pd.Series, df: pd.Series) -> pd.Series:
    return _column(t_two_sided, t, df)


@F.pandas_udf(T.DoubleType())
def t_critical_column(df: pd.Series) -> pd.Series:
    return _column(t_critical, df)


@F.pandas_udf(T.DoubleType())
def f_tail_column(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    return _column(f_tail, f, df1, df2)


@F.pandas_udf(T.DoubleType())
def chi2_tail_column(x: pd.Series, df: pd.Series) -> pd.Series:
    return _column(chi2_tail, x, df)


@F.pandas_udf(T.DoubleType())
def normal_tail_column(z: pd.Series) -> pd.Series:
    return _column(normal_tail, z)
