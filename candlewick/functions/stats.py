"""Distribution functions as columns."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rational approximation of the normal distribution function in double precision (West 2005).
CDF_TOP = (
    0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
)
CDF_BOTTOM = (
    0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
)


def _poly(x: Column, coefficients) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def normal_cdf(x: Column) -> Column:
    a = F.abs(x)
    e = F.exp(-a * a / 2)
    near = e * _poly(a, CDF_TOP) / _poly(a, CDF_BOTTOM)
    tail = a + 0.65
    for k in (4, 3, 2, 1):
        tail = a + F.lit(float(k)) / tail
    far = e / tail / 2.506628274631
    upper = F.when(a > 37, 0.0).when(a < 7.07106781186547, near).otherwise(far)
    return F.when(x > 0, 1 - upper).otherwise(upper)


def normal_cdf_once(x: Column) -> Column:
    """The same function for a long argument, which is computed once and not wherever the formula names it."""
    return F.get(F.transform(F.array(x), normal_cdf), F.lit(0))


def normal_cdf_array(x: np.ndarray) -> np.ndarray:
    """The same function over an array."""
    a = np.minimum(np.abs(x), 37.0)
    e = np.exp(-a * a / 2)
    tail = a + 0.65
    for k in (4, 3, 2, 1):
        tail = a + k / tail
    upper = np.where(a < 7.07106781186547, e * np.polyval(CDF_TOP, a) / np.polyval(CDF_BOTTOM, a), e / tail / 2.506628274631)
    return np.where(x > 0, 1 - upper, upper)


def normal_cdf_sql(x: str) -> str:
    """The same function as SQL text (central part, |x| < 7)."""

    def poly(cs):
        out = repr(cs[0])
        for c in cs[1:]:
            out = f"({out} * abs({x}) + {c!r})"
        return out

    upper = f"(exp(-power({x}, 2) / 2) * {poly(CDF_TOP)} / {poly(CDF_BOTTOM)})"
    return f"(CASE WHEN ({x}) > 0 THEN 1 - {upper} ELSE {upper} END)"


def normal_pdf(x: Column) -> Column:
    return F.exp(-x * x / 2) / math.sqrt(2 * math.pi)


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + num * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return front * _betacf(a, b, x) / a
    return 1 - front * _betacf(b, a, 1 - x) / b


def t_two_sided(t: float, df: float) -> float:
    if not (t == t and df > 0):
        return float("nan")
    return betainc(df / 2, 0.5, df / (df + t * t))


def chi2_sf(x: float, k: float) -> float:
    """Upper tail of the chi-square distribution (series / continued fraction of the incomplete gamma)."""
    if not (x == x):
        return float("nan")
    if x <= 0:
        return 1.0
    a, z = k / 2, x / 2
    front = math.exp(-z + a * math.log(z) - math.lgamma(a))
    if z < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= z / n
            total += term
        return 1 - total * front
    b, c = z + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1 / ((an * d + b) or 1e-300)
        c = (b + an / c) or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


@F.pandas_udf(T.DoubleType())
def t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p-value of Student's t; meant for small result tables."""
    return pd.Series([t_two_sided(float(a), float(b)) for a, b in zip(t, df)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi2_p_value(x: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf(float(a), float(b)) for a, b in zip(x, k)], dtype="float64")


def normal_ppf(p: float) -> float:
    """Quantile of the normal distribution by bisection on the error function."""
    lo, hi = -40.0, 40.0
    for _ in range(200):
        mid = (lo + hi) / 2
        if 0.5 * math.erfc(-mid / math.sqrt(2)) < p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


def t_ppf(p: float, df: float) -> float:
    """Quantile of Student's t by bisection."""
    lo, hi = -1e6, 1e6
    for _ in range(200):
        mid = (lo + hi) / 2
        tail = t_two_sided(mid, df) / 2
        if (tail if mid < 0 else 1 - tail) < p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2




# --- the same p-values as SQL text, for whole degrees of freedom: finite sums instead of continued fractions


def t_p_sql(t: str, df: str) -> str:
    """Two-sided p-value of Student's t (``df`` >= 1, whole)."""
    cos2 = f"(({df}) / (({df}) + power({t}, 2)))"
    sin = f"(abs({t}) / sqrt(({df}) + power({t}, 2)))"
    even = f"{sin} * list_sum(list_transform(range(CAST(({df}) // 2 AS BIGINT)), lambda k: exp(lgamma(k + 0.5) - lgamma(k + 1.0) - 0.5 * ln(pi()) + k * ln({cos2}))))"
    odd = f"coalesce(list_sum(list_transform(range(CAST((({df}) - 1) // 2 AS BIGINT)), lambda k: exp(lgamma(k + 1.0) - lgamma(k + 1.5) + 0.5 * ln(pi()) + k * ln({cos2}) - ln(2)))), 0)"
    odd = f"2 / pi() * (atan(abs({t}) / sqrt({df})) + {sin} * sqrt({cos2}) * {odd})"
    return f"(1 - CASE WHEN ({df}) % 2 = 0 THEN {even} ELSE {odd} END)"


def chi2_p_sql(x: str, k: int) -> str:
    """Upper tail of chi-square with an even number of degrees of freedom."""
    terms = " + ".join(f"power(({x}) / 2, {i}) / {math.factorial(i)}" for i in range(k // 2))
    return f"(exp(-({x}) / 2) * ({terms}))"
