"""Tails of the chi-square and t distributions as column expressions.

The regularised incomplete gamma and beta functions by their series and continued
fractions (modified Lentz), each an ``aggregate`` over a fixed number of steps, so
that results stay in the plan and no row passes through the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Steps of a series or fraction: enough for shape parameters up to about 10,000.
STEPS = 400
#: Beyond this many degrees of freedom t is turned into the normal deviate of nearly equal tails.
NORMAL_DOF = 20_000
TINY = 1e-300

# fixed values: coefficients of the Lanczos approximation of the gamma function (g = 7, n = 9)
LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
           12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)


def _col(x) -> Column:
    return (x if isinstance(x, Column) else F.lit(float(x))).cast("double")


def ln_gamma(a) -> Column:
    """Logarithm of the gamma function for ``a`` of 1/2 and more."""
    z = _col(a) - 1.0
    series = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], 1):
        series = series + F.lit(c) / (z + float(i))
    t = z + 7.5
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.ln(t) - t + F.ln(series)


def _steps(start: Column, step, end) -> Column:
    """``end`` of the state after STEPS steps; ``step`` takes the state's fields and the step's number."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, lambda acc, i: step(acc, i.cast("double")), end)


def _kept(x: Column) -> Column:
    """``x`` away from zero, as the fraction divides by it."""
    return F.when(F.abs(x) < TINY, F.lit(TINY)).otherwise(x)


def gamma_q(a, x) -> Column:
    """Upper regularised incomplete gamma function Q(a, x)."""
    a, x = _col(a), _col(x)
    front = F.exp(a * F.ln(x) - x - ln_gamma(a))
    below = _steps(F.struct((1.0 / a).alias("term"), (1.0 / a).alias("sum")),
                   lambda s, i: F.struct((s["term"] * x / (a + i)).alias("term"), (s["sum"] + s["term"] * x / (a + i)).alias("sum")), lambda s: s["sum"])

    def fraction(s, i):
        an, b = -i * (i - a), s["b"] + 2.0
        d, c = 1.0 / _kept(an * s["d"] + b), _kept(b + an / s["c"])
        return F.struct(b.alias("b"), c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"))

    b0 = x + 1.0 - a
    above = _steps(F.struct(b0.alias("b"), F.lit(1 / TINY).alias("c"), (1.0 / _kept(b0)).alias("d"), (1.0 / _kept(b0)).alias("h")), fraction, lambda s: s["h"])
    return F.when(x <= 0, F.lit(1.0)).when(x < a + 1.0, 1.0 - front * below).otherwise(front * above)


def beta_i(a, b, x) -> Column:
    """Regularised incomplete beta function I_x(a, b)."""
    a, b, x = _col(a), _col(b), _col(x)

    def fraction(a, b, x):
        def step(s, m):
            even = m * (b - m) * x / ((a + 2.0 * m - 1.0) * (a + 2.0 * m))
            d, c = 1.0 / _kept(1.0 + even * s["d"]), _kept(1.0 + even / s["c"])
            odd = -(a + m) * (a + b + m) * x / ((a + 2.0 * m) * (a + 2.0 * m + 1.0))
            d2, c2 = 1.0 / _kept(1.0 + odd * d), _kept(1.0 + odd / c)
            return F.struct(c2.alias("c"), d2.alias("d"), (s["h"] * d * c * d2 * c2).alias("h"))

        d0 = 1.0 / _kept(1.0 - (a + b) * x / (a + 1.0))
        return _steps(F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h")), step, lambda s: s["h"])

    front = F.exp(ln_gamma(a + b) - ln_gamma(a) - ln_gamma(b) + a * F.ln(x) + b * F.log1p(-x))
    inside = F.when(x < (a + 1.0) / (a + b + 2.0), front * fraction(a, b, x) / a).otherwise(1.0 - front * fraction(b, a, 1.0 - x) / b)
    return F.when(x <= 0, F.lit(0.0)).when(x >= 1, F.lit(1.0)).otherwise(inside)


def chi2_tail(x, dof) -> Column:
    """Probability that chi-square with ``dof`` degrees of freedom exceeds ``x``."""
    return gamma_q(_col(dof) / 2.0, _col(x) / 2.0)


def chi2_quantile(q: float, dof, rounds: int = 8) -> Column:
    """Value that chi-square with ``dof`` degrees of freedom exceeds with probability ``1 - q``: Newton steps from the
    Wilson-Hilferty value."""
    from statistics import NormalDist

    dof = _col(dof)
    cube = 1.0 - 2.0 / (9.0 * dof) + F.lit(NormalDist().inv_cdf(q)) * F.sqrt(2.0 / (9.0 * dof))

    def newton(x, _):
        density = F.exp((dof / 2.0 - 1.0) * F.ln(x) - x / 2.0 - F.lit(math.log(2.0)) * dof / 2.0 - ln_gamma(dof / 2.0))
        return F.greatest(x + (chi2_tail(x, dof) - F.lit(1.0 - q)) / density, x / 10.0)

    start = F.greatest(dof * cube * cube * cube, F.lit(1e-8))
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, newton)


def t_tails(t, dof) -> Column:
    """Two-sided tail probability of ``t`` with ``dof`` degrees of freedom."""
    t, dof = _col(t), _col(dof)
    z = t * (1.0 - 1.0 / (4.0 * dof)) / F.sqrt(1.0 + t * t / (2.0 * dof))
    return F.when(dof > NORMAL_DOF, gamma_q(0.5, z * z / 2.0)).otherwise(beta_i(dof / 2.0, 0.5, dof / (dof + t * t)))
