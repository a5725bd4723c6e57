"""Tail probabilities for test statistics, vectorised over a few reduced rows."""

from __future__ import annotations

from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

_TINY = 1e-300


def _lgamma(x):
    # made anew, as a vectorized function that has run cannot travel with the plan
    return np.vectorize(lgamma, otypes=[float])(x)


def _beta_fraction(a, b, x, rounds: int = 400):
    """Continued fraction of the incomplete beta function (Lentz's method)."""
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < _TINY, _TINY, d)
    h = d.copy()
    for m in range(1, rounds + 1):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / np.where(np.abs(d) < _TINY, _TINY, d)
            c = 1.0 + num / c
            c = np.where(np.abs(c) < _TINY, _TINY, c)
            step = c * d
            h = h * step
        if np.all(np.abs(step - 1.0) < 1e-15):
            break
    return h


def inc_beta(a, b, x):
    """Regularised incomplete beta function I_x(a, b)."""
    a, b, x = np.broadcast_arrays(*[np.asarray(v, float) for v in (a, b, x)])
    inner = np.clip(x, 1e-300, 1 - 1e-16)
    front = np.exp(_lgamma(a + b) - _lgamma(a) - _lgamma(b) + a * np.log(inner) + b * np.log1p(-inner))
    low = front * _beta_fraction(a, b, inner) / a
    high = 1.0 - front * _beta_fraction(b, a, 1.0 - inner) / b
    out = np.where(inner < (a + 1.0) / (a + b + 2.0), low, high)
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, out))


def t_two_sided(t, df):
    """P(|T| >= |t|) of Student's t."""
    t, df = np.asarray(t, float), np.asarray(df, float)
    return inc_beta(df / 2.0, 0.5, df / (df + t * t))


def _gamma_series(a, x, rounds: int = 1000):
    term = 1.0 / a
    total = term.copy()
    for n in range(1, rounds + 1):
        term = term * x / (a + n)
        total = total + term
        if np.all(np.abs(term) <= np.abs(total) * 1e-16):
            break
    return total


def _gamma_fraction(a, x, rounds: int = 1000):
    b = x + 1.0 - a
    c = np.full_like(x, 1.0 / _TINY)
    d = 1.0 / np.where(np.abs(b) < _TINY, _TINY, b)
    h = d.copy()
    for i in range(1, rounds + 1):
        an = -i * (i - a)
        b = b + 2.0
        d = an * d + b
        d = 1.0 / np.where(np.abs(d) < _TINY, _TINY, d)
        c = b + an / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        step = d * c
        h = h * step
        if np.all(np.abs(step - 1.0) < 1e-15):
            break
    return h


def chi2_tail(x, dof):
    """P(X >= x) of the chi-square distribution."""
    x, dof = np.broadcast_arrays(np.asarray(x, float), np.asarray(dof, float))
    a, z = dof / 2.0, np.maximum(x / 2.0, 1e-300)
    front = np.exp(a * np.log(z) - z - _lgamma(a))
    series = z < a + 1.0
    with np.errstate(over="ignore", invalid="ignore"):
        upper = np.where(
            series,
            1.0 - front * _gamma_series(a, np.where(series, z, 0.5 * a)),
            front * _gamma_fraction(a, np.where(series, a + 2.0, z)),
        )
    return np.where(x <= 0, 1.0, upper)


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    ok = t.notna() & df.notna()
    out = pd.Series(np.nan, index=t.index)
    if ok.any():
        out[ok] = t_two_sided(t[ok].to_numpy(), df[ok].to_numpy())
    return out.where(ok, None)


@F.pandas_udf(T.DoubleType())
def chi2_pvalue(x: pd.Series, dof: pd.Series) -> pd.Series:
    ok = x.notna() & dof.notna() & (dof > 0)
    out = pd.Series(np.nan, index=x.index)
    if ok.any():
        out[ok] = chi2_tail(x[ok].to_numpy(), dof[ok].to_numpy())
    return out.where(ok, None)
