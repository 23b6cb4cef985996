"""Upper tail of the F distribution, for the one-way ANOVA p-value.

The statistic itself is computed by Spark aggregates; only the final
one-row (F, df1, df2) goes through this helper inside a pandas UDF.
P(F > f) = I_x(a, b) with a = df2/2, b = df1/2, x = df2 / (df2 + df1 f) and
y = 1 - x, where I is the regularised incomplete beta function.

Every step adds positive terms, so no digits cancel, however far the tail and
however many rows:

- I_x(a, b + 1) = I_x(a, b) + x^a y^b G(a + b) / (G(a) G(b + 1)), G the gamma
  function, starts from I_x(a, 1) = x^a where b is whole;
- where b is a half more, it starts from I_x(a, 1/2), which is
  2 G(a + 1/2) / (G(a) sqrt(pi)) times the integral of (1 - r^2)^(a - 1) over r
  from sqrt(y) to 1.  That is smooth once a is not small; a small a is reached
  from a larger one by I_x(a, b) = I_x(a + 1, b) + x^a y^b G(a + b) / (G(a + 1) G(b)).

Powers of x are taken from y as exp(a log1p(-y)).
"""

from __future__ import annotations

import math

import numpy as np

_LEAST_A = 24.0       # from here on the integrand is smooth up to its ends
_PANELS, _NODES = 48, 16
_END = 50.0           # the integral ends where its integrand has fallen by exp(-50)
_LARGE = 1e250


def _log_gamma_ratio(a: float, b: float) -> float:
    """log(Gamma(a + b) / Gamma(a)) for a multiple b of 1/2, without the
    cancellation of two large log-gammas."""
    total = 0.0
    while b >= 1.0:
        b -= 1.0
        total += math.log(a + b)
    if b:  # log(Gamma(a + 1/2) / Gamma(a)), its asymptotic series after a shift
        while a < 64.0:
            total += math.log(a) - math.log(a + 0.5)
            a += 1.0
        total += 0.5 * math.log(a) - 1 / (8 * a) + 1 / (192 * a**3) - 1 / (640 * a**5)
    return total


def _half(a: float, y: float) -> tuple[float, float]:
    """log and factor of I_x(a, 1/2): it is exp(log) * factor."""
    log_x = math.log1p(-y)
    steps = max(0, math.ceil(_LEAST_A - a))
    high = a + steps
    r0, x = math.sqrt(y), 1.0 - y
    fallen = -math.expm1(-_END / (high - 1.0)) * x
    width = fallen / (r0 + math.sqrt(r0 * r0 + fallen)) / _PANELS
    node, weight = np.polynomial.legendre.leggauss(_NODES)
    t = ((np.arange(_PANELS)[:, None] + (node + 1.0) / 2.0) * width).ravel()
    falls = np.exp((high - 1.0) * np.log1p(-t * (2.0 * r0 + t) / x))
    integral = float(np.sum(falls * np.tile(weight, _PANELS))) * width / 2.0
    # both parts over x^a
    front = math.exp(_log_gamma_ratio(high, 0.5)) / math.sqrt(math.pi)
    total = 2.0 * front * integral * math.exp((steps - 1.0) * log_x)
    for k in range(steps):
        at = a + k
        total += math.exp(k * log_x + 0.5 * math.log(y) + _log_gamma_ratio(at, 0.5) - math.log(at)) / math.sqrt(math.pi)
    return a * log_x, total


def reg_inc_beta(a: float, b: float, y: float) -> float:
    """I_x(a, b) at x = 1 - y, for a multiple b of 1/2."""
    if y >= 1.0:
        return 0.0
    if y <= 0.0:
        return 1.0
    if 2 * b != int(2 * b):
        raise ValueError("df1 must be a whole number")
    whole = b == int(b)
    if whole:
        log_front, total, at = a * math.log1p(-y), 1.0, 1.0
        term = 1.0  # over x^a, the term that made I_x(a, at)
    else:
        log_front, total = _half(a, y)
        at = 0.5
        term = math.exp(0.5 * math.log(y) + _log_gamma_ratio(a, 0.5)) / math.gamma(0.5)
    while at < b:
        # x^a y^at G(a + at) / (G(a) G(at + 1)) from its predecessor
        term *= y * (a + at - 1.0) / at if whole or at > 0.5 else 1.0 / 0.5
        total += term
        at += 1.0
        if total > _LARGE:
            log_front += math.log(_LARGE)
            term, total = term / _LARGE, total / _LARGE
    return min(1.0, math.exp(log_front + math.log(total))) if total else 0.0


def f_survival(f: float, df1: float, df2: float) -> float:
    """P(X > f) for X ~ F(df1, df2), df1 whole; NaN when undefined."""
    if f is None or df1 is None or df2 is None:
        return float("nan")
    if any(map(math.isnan, (f, df1, df2))) or df1 <= 0 or df2 <= 0:
        return float("nan")
    if math.isinf(f):
        return 0.0
    if f <= 0:
        return 1.0
    return reg_inc_beta(df2 / 2.0, df1 / 2.0, df1 * f / (df2 + df1 * f))
