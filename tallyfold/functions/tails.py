"""Tail probabilities of the normal and Student t distributions, and the exact rank-sum tail.

Spark has neither ``erf`` nor an incomplete beta function. Both continuous tails are therefore
written as short quadrature sums in built-in expressions, so a statistics plan needs no Python
worker for them:

* normal: Taylor series near zero, beyond it the trapezoidal sum for ``erfc`` with its pole
  correction (Hunter and Regan, Math. Comp. 26, 1972);
* Student t: substituting ``s = sqrt(df) sinh(u)`` turns the density into ``sech(u)**df``, whose
  tail is summed with the double-exponential rule (Takahasi and Mori, 1974).

Both keep about 13 significant digits, also in the far tail.
"""

from __future__ import annotations

import math
import sys
from itertools import combinations

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

ERFC_STEP = 0.5
ERFC_TERMS = 13
SERIES_TERMS = 24
SERIES_BELOW = 0.75
DE_STEP = 0.1
DE_FIRST, DE_LAST = -37, 46


def _de_nodes() -> str:
    """SQL of the rule's nodes and weights, a literal: (y, w) of every k."""
    nodes = []
    for k in range(DE_FIRST, DE_LAST + 1):
        shrink = math.exp(-k * DE_STEP)
        y = math.exp(k * DE_STEP - shrink)
        nodes.append(f"named_struct('y', {y!r}D, 'w', {y * (1 + shrink)!r}D)")
    return f"array({', '.join(nodes)})"


_DE_NODES = _de_nodes()


def _let(name: str, value: str, body: str) -> str:
    """SQL of ``body`` with ``name`` bound to ``value``, evaluated once per row."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


# erf(x) = 2x/sqrt(pi) exp(-x^2) sum (2x^2)^n / (1 3 5 .. (2n+1)), by Horner's rule.
_ERFC_NEAR = (
    f"1D - {2.0 / math.sqrt(math.pi)!r}D * x * exp(-x * x) * aggregate("
    f"sequence({SERIES_TERMS}, 1), 1D, (s, n) -> 1D + x * x * 2D / (2 * n + 1) * s)")
_ERFC_FAR = (
    f"x * exp(-x * x) * {ERFC_STEP / math.pi!r}D * aggregate("
    f"sequence(1, {ERFC_TERMS}), 1D / (x * x), (s, k) -> "
    f"s + 2D * exp(-k * k * {ERFC_STEP ** 2}D) / (x * x + k * k * {ERFC_STEP ** 2}D)) "
    f"- if(x < {math.pi / ERFC_STEP!r}D, "
    f"2D / (exp(x * {2 * math.pi / ERFC_STEP!r}D) - 1D), 0D)")
_UPPER_TAIL = _let("x", f"abs(z) / {math.sqrt(2.0)!r}D",
                   f"0.5D * if(x < {SERIES_BELOW}D, {_ERFC_NEAR}, {_ERFC_FAR})")


def normal_sf(z: str) -> Column:
    """P(Z > z) of the standard normal distribution; ``z`` is a column name or SQL expression."""
    return F.expr(_let("z", z, f"if(z >= 0D, {_UPPER_TAIL}, 1D - {_UPPER_TAIL})"))


def _log_cosh(u: str) -> str:
    return f"0.5D * log1p(sinh({u}) * sinh({u}))"


def _sech_tail(start: str) -> str:
    """Integral of (cosh(start)/cosh(u))**d.df over u from start to infinity."""
    drop = f"{_log_cosh(f'({start} + f.scale * k.y)')} - f.floor"
    nodes = f"aggregate({_DE_NODES}, 0D, (s, k) -> s + exp(-d.df * ({drop})) * k.w)"
    fixed = (f"named_struct('scale', 1D / (sqrt(d.df) + d.df * tanh({start})), "
             f"'floor', {_log_cosh(start)})")
    return _let("f", fixed, f"{nodes} * f.scale * {DE_STEP}D")


def student_t_two_sided(t: str, df: str) -> Column:
    """P(|T| > |t|) for real-valued ``df``; 0 for an infinite t. Names or SQL expressions."""
    bound = (f"named_struct('t', abs(CAST({t} AS DOUBLE)), 'df', CAST({df} AS DOUBLE), "
             f"'u', asinh(least(abs({t}), 1e150D) / sqrt({df})))")
    tail = f"exp(-d.df * ({_log_cosh('d.u')})) * {_sech_tail('d.u')} / {_sech_tail('0D')}"
    return F.expr(_let("d", bound, "CASE WHEN d.t = double('Infinity') THEN 0D "
                                   "WHEN d.t IS NOT NULL AND d.df IS NOT NULL "
                                   f"THEN least({tail}, 1D) END"))


# --- exact rank-sum tail -------------------------------------------------------------------


def _partition_numerator(n: int) -> tuple[int, list[int]]:
    """(L, coefficients of P) with 1/((1-q)(1-q)(1-q^2)..(1-q^n)) = P(q) / (1-q^L)^(n+1)."""
    period = math.lcm(*range(1, n + 1))
    poly = [1]
    for part in (1, *range(1, n + 1)):
        # Times (1 - q^L) / (1 - q^part), the quotient being a polynomial.
        out = poly + [0] * (period - part)
        for i in range(len(out)):
            out[i] -= poly[i - period] if period <= i else 0
            out[i] += out[i - part] if part <= i else 0
        poly = out
    return period, poly


def rank_sum_cdf(u: int, n1: int, n2: int, numerators: dict | None = None) -> float:
    """P(U <= u) without ties, exact in integers; the cost depends on min(n1, n2) only.

    Arrangements with rank-sum statistic at most u are partitions inside an n1 x n2 box, counted
    by inclusion and exclusion over the box limit. ``numerators`` is a reusable cache.
    """
    n, m = min(n1, n2), max(n1, n2)
    numerators = {} if numerators is None else numerators
    if n not in numerators:
        numerators[n] = _partition_numerator(n)
    period, poly = numerators[n]
    ways = 0
    for size in range(n + 1):
        for chosen in combinations(range(1, n + 1), size):
            left = u - size * m - sum(chosen)
            if left < 0:
                continue
            partitions = sum(poly[t] * math.comb((left - t) // period + n, n)
                             for t in range(left % period, min(left, len(poly) - 1) + 1, period))
            ways += (-1) ** size * partitions
    return ways / math.comb(n + m, n)


def exact_rank_sum_p(u_smaller: Column, n1: Column, n2: Column) -> Column:
    """Two-sided exact p-value of result rows (one per compared group); NULL in, NULL out."""
    # Ship this module's code with the function: executors need no installed package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    def two_sided(u: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        numerators: dict = {}
        return pd.Series([
            None if pd.isna(x) else min(1.0, 2.0 * rank_sum_cdf(int(x), int(y), int(z), numerators))
            for x, y, z in zip(u, a, b)], dtype="float64")

    return F.pandas_udf(two_sided, T.DoubleType())(u_smaller, n1, n2)
