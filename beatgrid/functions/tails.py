"""Upper tails of the F and t distributions, for single numbers and as column expressions."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta integral (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 500):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            total *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return total


def incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def f_tail(value: float, df1: float, df2: float) -> float:
    """P(F > value) with df1 and df2 degrees of freedom."""
    return incomplete_beta(df2 / 2.0, df1 / 2.0, df2 / (df2 + df1 * value))


def t_tail(value: float, df: float) -> float:
    """Two-sided P(\\|t\\| > \\|value\\|)."""
    return f_tail(value * value, 1.0, df)


# --- the same as column expressions ----------------------------------------------

# The Lanczos approximation of the gamma function for g = 7.
_LANCZOS_G = 7
_LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313,
    -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6,
    1.5056327351493116e-7,
)


def log_gamma(x: Column) -> Column:
    """Natural logarithm of the gamma function, for x of 0.5 and more."""
    series = F.lit(_LANCZOS[0])
    for i, c in enumerate(_LANCZOS[1:]):
        series += F.lit(c) / (x + F.lit(float(i)))
    base = x + F.lit(_LANCZOS_G - 0.5)
    return F.lit(0.5 * math.log(2 * math.pi)) + (x - F.lit(0.5)) * F.ln(base) - base + F.ln(series)


def _fraction_column(a: Column, b: Column, x: Column, steps: Column) -> Column:
    """The continued fraction of ``_beta_fraction`` as a fold over the step numbers.

    The arguments are bound to a lambda variable, so that a step does not compute them again.
    """
    kept = lambda v: F.when(F.abs(v) > 1e-300, v).otherwise(1e-300)

    def fold(given):
        a, b, x = given["a"], given["b"], given["x"]

        def step(state, half):
            m = F.floor(half / 2)
            numerator = F.when(half % 2 == 0, m * (b - m) * x / ((a + m * 2 - 1) * (a + m * 2))).otherwise(
                -(a + m) * (a + b + m) * x / ((a + m * 2) * (a + m * 2 + 1)))
            moved = F.transform(F.array(numerator), lambda term: F.struct(
                kept(F.lit(1.0) + term / state["c"]).alias("c"), (F.lit(1.0) / kept(F.lit(1.0) + term * state["d"])).alias("d")))
            return F.transform(moved, lambda n: F.struct(n["c"].alias("c"), n["d"].alias("d"), (state["total"] * n["c"] * n["d"]).alias("total")))[0]

        first = F.lit(1.0) / kept(F.lit(1.0) - (a + b) * x / (a + 1))
        start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("total"))
        halves = F.transform(F.sequence(F.lit(2), given["steps"] * 2 + 1), lambda i: i.cast("double"))
        return F.aggregate(halves, start, step, lambda s: s["total"])

    return F.transform(F.array(F.struct(a.alias("a"), b.alias("b"), x.alias("x"), steps.alias("steps"))), fold)[0]


def _fraction_steps(t: Column, direct: Column) -> Column:
    """Steps after which the fraction of ``t_tail_column`` stands still, for any degrees of freedom.

    With one parameter at 1/2 it tends, as the other grows, to the fraction of the incomplete gamma
    integral: the rest after m steps falls as exp(-4 sqrt(m t^2 / 2)), and on the other side of the
    switch faster. ``t^2`` is over 1 on the direct side.
    """
    return F.when(direct, F.lit(20) + F.lit(180.0) / (t * t)).otherwise(20).cast("int")


def t_tail_column(t: Column, df: Column) -> Column:
    """Two-sided P(\\|T\\| > \\|t\\|) with ``df`` degrees of freedom, missing where either is.

    The steps of the continued fraction depend on ``t`` alone, see ``_fraction_steps``.
    """
    df = df.cast("double")
    a, half = df / 2, F.lit(0.5)
    x = df / (df + t * t)
    y = t * t / (df + t * t)
    # The series of the gamma ratio spares large degrees of freedom a difference of large numbers.
    ratio = (F.when(a < 50, log_gamma(a + half) - log_gamma(a))
             .otherwise(half * F.ln(a) - 1 / (a * 8) + 1 / (F.pow(a, F.lit(3.0)) * 192) - 1 / (F.pow(a, F.lit(5.0)) * 640)))
    front = F.exp(ratio - F.lit(math.lgamma(0.5)) - a * F.log1p(t * t / df) + half * F.ln(y))
    direct = x < (a + 1) / (a + F.lit(2.5))
    steps = _fraction_steps(t, direct)
    # One fraction serves both sides of the switch: its arguments change places.
    fraction = _fraction_column(F.when(direct, a).otherwise(half), F.when(direct, half).otherwise(a),
                                F.when(direct, x).otherwise(y), steps)
    tail = F.when(direct, front * fraction / a).otherwise(F.lit(1.0) - front * fraction / half)
    return (F.when(t.isNull() | df.isNull() | (df <= 0), F.lit(None).cast("double"))
            .when(F.isnan(t), F.lit(float("nan"))).when(t == 0, F.lit(1.0))
            .when(F.abs(t) == float("inf"), F.lit(0.0)).otherwise(tail))


def stars(p: Column) -> Column:
    """Marks of a significance below 0.01, 0.05 and 0.1."""
    return F.when(p < 0.01, "***").when(p < 0.05, "**").when(p < 0.1, "*").otherwise("")
