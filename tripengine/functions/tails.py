"""Upper tails of the chi-square and the F distribution, for single test results."""

from __future__ import annotations

from math import exp, lgamma, log, log1p


def chi_square_tail(x: float, freedom: int) -> float:
    """Probability of a chi-square value above ``x``: the upper incomplete gamma ratio."""
    a, z = freedom / 2, x / 2
    if z <= 0:
        return 1.0
    front = exp(a * log(z) - z - lgamma(a))
    if z < a + 1:  # series of the lower part
        term = total = 1 / a
        n = a
        while term > total * 1e-17:
            n += 1
            term *= z / n
            total += term
        return max(0.0, 1 - front * total)
    # continued fraction of the upper part
    b = z + 1 - a
    c, d = 1e300, 1 / b
    value = d
    for i in range(1, 10_000):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b or 1e-300)
        c = b + step / c or 1e-300
        value *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return front * value


def f_tail(x: float, upper: int, lower: int) -> float:
    """Probability of an F value above ``x``: an incomplete beta ratio."""
    if x <= 0:
        return 1.0
    a, b = lower / 2, upper / 2
    z = lower / (lower + upper * x)
    return _beta_ratio(z, a, b)


def _beta_ratio(z: float, a: float, b: float) -> float:
    if z <= 0 or z >= 1:
        return float(z >= 1)
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(z) + b * log1p(-z))
    if z > (a + 1) / (a + b + 2):
        return 1 - _beta_ratio(1 - z, b, a)
    c, d = 1.0, 1 - (a + b) * z / (a + 1)
    d = 1 / (d or 1e-300)
    value = d
    for m in range(1, 10_000):
        for step in (m * (b - m) * z / ((a + 2 * m - 1) * (a + 2 * m)),
                     -(a + m) * (a + b + m) * z / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + step * d or 1e-300)
            c = 1 + step / c or 1e-300
            value *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return front * value / a
