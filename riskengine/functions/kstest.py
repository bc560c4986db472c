"""Significance of a two-sample Kolmogorov-Smirnov distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SERIES_TERMS = 100
# Below this argument the alternating series has not converged and the p-value is 1 to 5 places.
SMALL_LAMBDA = 0.3


def ks_lambda(ks: Column, n: Column, m: Column) -> Column:
    n, m = n.cast("double"), m.cast("double")
    return ks * F.sqrt(n * m / (n + m))


def ks_pvalue(ks: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value, 2 * sum (-1)^(k-1) exp(-2 k^2 lambda^2)."""
    lam = ks_lambda(ks, n, m)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0))
        * F.exp(F.lit(-2.0) * k.cast("double") * k.cast("double") * lam * lam),
    )
    return F.when(lam < SMALL_LAMBDA, F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), series))
    )
