"""Statistical helpers: column expressions, plus scalar tail probabilities evaluated on the driver.

The scalar functions only ever receive a handful of numbers (a test statistic and its degrees
of freedom); they are the standard series / continued-fraction evaluations of the regularised
incomplete gamma and beta functions.
"""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))


def predict_label(x, threshold: float = 0.5) -> Column:
    """1 when sigmoid(x) >= threshold else 0."""
    return F.when(sigmoid(x) >= threshold, F.lit(1)).otherwise(F.lit(0))


def normal_quantile(p) -> Column:
    """Inverse standard-normal CDF by a rational approximation (relative error < 1.2e-9)."""
    p = _c(p)
    # Coefficients of the rational approximation.
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]
    lo = 0.02425

    def poly(coefs, x):
        acc = F.lit(coefs[0])
        for k in coefs[1:]:
            acc = acc * x + F.lit(k)
        return acc

    q_lo = F.sqrt(-2 * F.log(p))
    q_hi = F.sqrt(-2 * F.log(1 - p))
    q = p - 0.5
    r = q * q
    tail_lo = poly(c, q_lo) / (poly(d, q_lo) * q_lo + 1)
    tail_hi = -poly(c, q_hi) / (poly(d, q_hi) * q_hi + 1)
    central = poly(a, r) * q / (poly(b, r) * r + 1)
    return F.when(p < lo, tail_lo).when(p > 1 - lo, tail_hi).otherwise(central)


# ---------------------------------------------------------------- scalar tails (driver side)

def _gammainc_lower_series(a: float, x: float) -> float:
    term = 1.0 / a
    total = term
    n = a
    for _ in range(10000):
        n += 1.0
        term *= x / n
        total += term
        if abs(term) < abs(total) * 1e-15:
            break
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _gammainc_upper_cf(a: float, x: float) -> float:
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def chi2_sf(x: float, df: float) -> float:
    """Upper tail P(X > x) of a chi-square with ``df`` degrees of freedom."""
    if x is None or math.isnan(x):
        return float("nan")
    if x <= 0:
        return 1.0
    a, h = df / 2.0, x / 2.0
    if h < a + 1.0:
        return 1.0 - _gammainc_lower_series(a, h)
    return _gammainc_upper_cf(a, h)


def _betacf(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = tiny if abs(d) < tiny else d
    d = 1.0 / d
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = tiny if abs(d) < tiny else d
        c = 1.0 + aa / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = tiny if abs(d) < tiny else d
        c = 1.0 + aa / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return h


def betainc_reg(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    bt = math.exp(lbt)
    if x < (a + 1) / (a + b + 2):
        return bt * _betacf(a, b, x) / a
    return 1.0 - bt * _betacf(b, a, 1 - x) / b


def t_sf_two_sided(t: float, df: float) -> float:
    """P(|T| > |t|) for Student's t with ``df`` degrees of freedom."""
    x = df / (df + t * t)
    return betainc_reg(df / 2.0, 0.5, x)
