"""Statistical Column expressions (JVM-side, no Python per row)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

KS_SERIES_TERMS = 100


def ks_pvalue(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided two-sample KS p-value with Stephens' correction.

    e = n*m/(n+m); lambda = (sqrt(e) + 0.12 + 0.11/sqrt(e)) * D;
    p = 2 * sum_{j>=1} (-1)^(j-1) exp(-2 j^2 lambda^2), clamped to [0, 1];
    p = 1 when lambda < 0.2 (the series has not converged there).
    """
    e = (n.cast("double") * m.cast("double")) / (n + m).cast("double")
    lam = (F.sqrt(e) + 0.12 + 0.11 / F.sqrt(e)) * d
    terms = F.sequence(F.lit(1), F.lit(KS_SERIES_TERMS))
    series = F.aggregate(
        terms, F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(F.lit(-2.0) * j * j * lam * lam))
    p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(2.0) * series))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(p)


def chi2_pvalue(x: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution; 1 for no degree of freedom.

    One minus the lower incomplete gamma series with a = dof / 2, summed in
    logs: each term adds log(x / 2) - log(a + n). The terms fall off beyond
    n = x / 2, so x + 100 of them are summed.
    """
    a, half = dof / 2, x / 2
    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.floor((dof + 1) / 2).cast("int")))
    # log gamma(a + 1): over 1..a for even dof, from sqrt(pi) over 1/2..a for odd
    odd = dof % 2 == 1
    factors = F.filter(F.transform(steps, lambda i: F.when(odd, i - 0.5).otherwise(i.cast("double"))), lambda v: v <= a)
    start = F.when(odd, F.log(F.lit(math.pi)) / 2).otherwise(F.lit(0.0))
    log_gamma = F.aggregate(factors, start, lambda s, v: s + F.log(v))
    first = a * F.log(half) - half - log_gamma
    zero = F.struct(first.alias("term"), F.exp(first).alias("sum"))

    def add(state: Column, n: Column) -> Column:
        term = state["term"] + F.log(half) - F.log(a + n)
        return F.struct(term.alias("term"), (state["sum"] + F.exp(term)).alias("sum"))

    lower = F.aggregate(F.sequence(F.lit(1), (F.ceil(x) + 100).cast("int")), zero, add)["sum"]
    return F.when((dof < 1) | (x <= 0), F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1 - lower))
