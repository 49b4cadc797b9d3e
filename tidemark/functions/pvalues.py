"""Tail probabilities of a few scalar statistics.

Inputs are single numbers that Spark has already reduced a table to; nothing
here sees data rows.
"""

from __future__ import annotations

import math

import numpy as np

_TINY = 1e-300
_STEPS = 1000


def ks_two_sample(statistic: float, n_a: int, n_b: int, method: str = "asymptotic") -> float:
    """P(D >= statistic) for two samples of the given sizes.

    ``exact`` counts the merges of the two samples that reach the distance
    ``statistic``: by reflection for equal sizes, else along the band of places
    nearer than that; ``asymptotic`` is the limiting distribution.
    """
    if method not in ("asymptotic", "exact"):
        raise ValueError(f"unknown method {method}")
    if statistic <= 0:
        return 1.0
    if method == "asymptotic":
        return _kolmogorov_tail(statistic * math.sqrt(n_a * n_b / (n_a + n_b)))
    limit = round(statistic * n_a * n_b)
    if n_a == n_b:
        return _equal_sizes(n_a, limit // n_a)
    return _banded_paths(min(n_a, n_b), max(n_a, n_b), limit)


def _log_choose(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def _equal_sizes(n: int, lead: int) -> float:
    """Share of the merges of two samples of ``n`` in which one is ever ``lead`` ahead, by reflection."""
    everything = _log_choose(2 * n, n)
    terms = (
        2 * (-1) ** (j - 1) * math.exp(_log_choose(2 * n, n - j * lead) - everything)
        for j in range(1, n // lead + 1)
    )
    return min(1.0, max(0.0, math.fsum(terms)))


def _banded_paths(n: int, m: int, limit: int) -> float:
    """Share of the merges of ``n`` and ``m`` draws with ``|x * m - y * n| >= limit`` at some point.

    Only the band inside the limit is held.  A free walk with the samples' shares
    as its chances goes through it, which keeps all numbers near each other; it
    is counted where it first leaves the band, weighed by what the merges have
    more or less of that place than the walk, so that small shares keep their
    digits.
    """
    total = n + m
    take, skip, everything = n / total, m / total, _log_choose(total, n)

    def leave(mass: float, x: int, y: int) -> float:
        if mass <= 0 or x > n or y > m:
            return 0.0
        walk = x * math.log(take) + y * math.log(skip)
        return math.exp(math.log(mass) + _log_choose(total - x - y, n - x) - everything - walk)

    low, alive, share = 0, np.ones(1), 0.0
    for step in range(1, total + 1):
        moved = np.empty(len(alive) + 1)
        np.multiply(alive, skip, out=moved[:-1])
        moved[-1] = 0.0
        moved[1:] += alive * take
        first = max((step * n - limit) // total + 1, step - m, 0)
        last = min(-((-step * n - limit) // total) - 1, step, n)
        for x in (*range(low, first), *range(last + 1, low + len(moved))):
            share += leave(float(moved[x - low]), x, step - x)
        if first > last:
            break
        alive, low = moved[first - low : last - low + 1], first
    return min(1.0, share)


def _kolmogorov_tail(x: float) -> float:
    if x < 0.2:
        return 1.0
    terms = (2 * (-1) ** (k - 1) * math.exp(-2 * (k * x) ** 2) for k in range(1, 101))
    return min(1.0, max(0.0, math.fsum(terms)))


def chi_square(statistic: float, dof: int) -> float:
    """P(X >= statistic) for a chi-square variable."""
    if statistic <= 0 or dof <= 0:
        return 1.0
    if dof == 1:
        return math.erfc(math.sqrt(statistic / 2))
    a, x = dof / 2, statistic / 2
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        for k in range(1, _STEPS * 10):
            term *= x / (a + k)
            total += term
            if term < total * 1e-17:
                break
        return max(0.0, 1 - front * total)
    # numerators and denominators of the continued fraction of the upper tail
    return front / _continued_fraction(
        lambda k: (k * (a - k), x + 2 * k + 1 - a), x + 1 - a
    )


def f_ratio(statistic: float, dof_between: float, dof_within: float) -> float:
    """P(F >= statistic)."""
    if math.isnan(statistic):
        return math.nan
    if statistic <= 0:
        return 1.0
    x = dof_within / (dof_within + dof_between * statistic)
    return _incomplete_beta(dof_within / 2, dof_between / 2, x)


def _incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1 - _incomplete_beta(b, a, 1 - x)
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )

    def term(n: int) -> tuple[float, float]:
        m = n // 2
        if n % 2:
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    # odd and even terms start at n = 1
    return math.exp(log_front) / a / _continued_fraction(term, 1.0)


def _continued_fraction(term, start: float) -> float:
    """``start + a1/(b1 + a2/(b2 + ...))`` by forward evaluation of ratios."""
    value = start or _TINY
    upper, lower = value, 0.0
    for n in range(1, _STEPS * 10):
        a, b = term(n)
        lower = 1 / ((b + a * lower) or _TINY)
        upper = (b + a / upper) or _TINY
        step = upper * lower
        value *= step
        if abs(step - 1) < 1e-16:
            break
    return value
