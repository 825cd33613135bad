"""Upper tail of the F distribution, for the few feature scores of a report."""

from __future__ import annotations

import math


def _continued_fraction(x: float, a: float, b: float) -> float:
    """Lentz's method for the incomplete beta function."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for step in (even, odd):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return value


def incomplete_beta(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    front = math.exp(log_front)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _continued_fraction(x, a, b) / a
    return 1.0 - front * _continued_fraction(1.0 - x, b, a) / b


def f_upper_tail(score: float, df_between: float, df_within: float) -> float:
    """P(F > score)."""
    if math.isinf(score):
        return 0.0
    return incomplete_beta(df_within / (df_within + df_between * score), df_within / 2, df_between / 2)
