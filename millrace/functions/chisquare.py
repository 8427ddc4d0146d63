"""Upper tail of the chi-square distribution and the wording of a test's outcome."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: method name, null hypothesis and the wording of the four outcomes
METHOD = "pearson"
NULL_HYPOTHESIS = "observed follows the same distribution as expected."
PRESUMPTIONS = [
    (0.01, "Very strong presumption against null hypothesis"),
    (0.05, "Strong presumption against null hypothesis"),
    (0.1, "Low presumption against null hypothesis"),
]
NO_PRESUMPTION = "No presumption against null hypothesis"

CLOSED_FORM_DF = 1000


def _steps(first: int, last: Column) -> Column:
    """The numbers from ``first`` to ``last``; empty when there are none."""
    counted = F.sequence(F.lit(first), F.greatest(last, F.lit(first)))
    return F.when(last >= first, counted).otherwise(F.array().cast("array<int>"))


def _log_series(log_first: Column, half: Column, steps: Column, shift: float) -> Column:
    """Log of t + t*h/(s1-shift) + t*h/(s1-shift)*h/(s2-shift) + ...; nothing overflows."""

    def add(state: Column, i: Column) -> Column:
        term = state["term"] + F.log(half) - F.log(i - F.lit(shift))
        larger = F.greatest(state["total"], term)
        total = larger + F.log1p(F.exp(-F.abs(state["total"] - term)))
        return F.struct(term.alias("term"), total.alias("total"))

    start = F.struct(log_first.alias("term"), log_first.alias("total"))
    return F.aggregate(steps, start, add, lambda state: state["total"])


def _even_tail(half: Column, df: Column) -> Column:
    """``exp(-h) * sum(h^i / i!, 0 <= i < df/2)``."""
    last = (df / 2).cast("int") - 1
    return F.exp(_log_series(F.lit(0.0), half, _steps(1, last), 0.0) - half)


def _erfc_of_root(half: Column) -> Column:
    """Complementary error function of ``sqrt(h)``: a series below 9, a continued fraction above."""
    terms = F.sequence(F.lit(1), F.lit(80))
    near = F.aggregate(
        terms,
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda s, n: F.struct(
            (s["term"] * 2 * half / (2 * n + 1)).alias("term"),
            (s["total"] + s["term"] * 2 * half / (2 * n + 1)).alias("total"),
        ),
        lambda s: s["total"],
    )
    far = F.aggregate(
        F.reverse(terms), F.lit(1.0), lambda f, n: F.lit(1.0) + n / (F.lit(2.0) * half) / f
    )
    scale = F.exp(-half) / math.sqrt(math.pi)
    return F.when(half < 9, 1 - 2 * F.sqrt(half) * scale * near).otherwise(
        scale / F.sqrt(half) / far
    )


def _odd_tail(half: Column, df: Column) -> Column:
    """``erfc(sqrt(h)) + exp(-h) * sum(h^(i-1/2) / gamma(i+1/2), 1 <= i <= (df-1)/2)``."""
    last = ((df - 1) / 2).cast("int")
    log_first = F.log(half) / 2 + math.log(2 / math.sqrt(math.pi))
    rest = F.exp(_log_series(log_first, half, _steps(2, last), 0.5) - half)
    return _erfc_of_root(half) + F.when(last >= 1, rest).otherwise(0.0)


def _large_tail(half: Column, df: Column) -> Column:
    """Upper incomplete gamma function at df/2 in some 8 * sqrt(df/2) steps instead of df/2.

    A continued fraction from the mean on, one minus a series below it; the factor in front
    uses Stirling's formula, which is exact to double precision for so many degrees.
    """
    a = df / 2
    steps = F.sequence(F.lit(1), (F.sqrt(a) * 8).cast("int") + 100)
    off = (half - a) / a
    log_front = a * (F.log1p(off) - off) + F.log(a) / 2 - math.log(2 * math.pi) / 2
    front = F.exp(log_front - 1 / (12 * a) + 1 / (360 * a * a * a))
    fraction = F.aggregate(
        F.reverse(steps),
        half + 2 * F.size(steps) + 1 - a,
        lambda f, i: half + 2 * i - 1 - a - i * (i - a) / f,
    )
    series = F.aggregate(
        steps,
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda s, i: F.struct(
            (s["term"] * half / (a + i)).alias("term"),
            (s["total"] + s["term"] * half / (a + i)).alias("total"),
        ),
        lambda s: s["total"],
    )
    return F.when(half >= a, front / fraction).otherwise(1 - front / a * series)


def chisq_pvalue(statistic: Column, df: Column) -> Column:
    """Probability of a chi-square value of at least ``statistic`` at ``df`` degrees.

    Closed forms with positive terms only, so the far tail keeps its accuracy; beyond
    ``CLOSED_FORM_DF`` degrees, where they would take a term for every second degree, the
    incomplete gamma function.
    """
    half = statistic / 2
    return (
        F.when(statistic.isNull() | F.isnan(statistic), F.lit(float("nan")))
        .when((df == 0) | (half <= 0), F.lit(1.0))
        .when(df > CLOSED_FORM_DF, _large_tail(half, df))
        .when(df % 2 == 0, _even_tail(half, df))
        .otherwise(_odd_tail(half, df))
    )


def presumption(p: Column) -> Column:
    """Wording of the outcome at p-value ``p``; null when ``p`` is not a number."""
    (first, text), *rest = PRESUMPTIONS
    chain = F.when(F.isnan(p) | p.isNull(), F.lit(None).cast("string")).when(p <= first, text)
    for bound, words in rest:
        chain = chain.when(p <= bound, words)
    return chain.otherwise(NO_PRESUMPTION)
