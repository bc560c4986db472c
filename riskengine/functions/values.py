"""Small value-level expressions: missing tests, guarded division, corrected moments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_missing(col: Column | str) -> Column:
    """True for NULL and for NaN (numeric columns)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNull() | F.isnan(c)


def plain(col: Column | str) -> Column:
    """The value as a double with -0.0 folded into 0.0, so equal values always compare equal."""
    c = (F.col(col) if isinstance(col, str) else col).cast("double")
    return F.when(c == 0, F.lit(0.0)).otherwise(c)


def ratio(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """num / den as double, `default` where the denominator is zero."""
    out = F.when(den != 0, num.cast("double") / den.cast("double"))
    return out if default is None else out.otherwise(F.lit(default))


def sample_skewness(col: str) -> Column:
    """Bias-corrected skewness: NULL below 3 values, 0 for a constant column."""
    n = F.count(col).cast("double")
    g1 = F.skewness(col)
    return (
        F.when(n < 3, F.lit(None).cast("double"))
        .when(F.min(col) == F.max(col), F.lit(0.0))
        .otherwise(g1 * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))
    )


def sample_kurtosis(col: str) -> Column:
    """Bias-corrected excess kurtosis: NULL below 4 values, 0 for a constant column."""
    n = F.count(col).cast("double")
    g2 = F.kurtosis(col)
    return (
        F.when(n < 4, F.lit(None).cast("double"))
        .when(F.min(col) == F.max(col), F.lit(0.0))
        .otherwise((n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0)) * ((n + 1) * g2 + 6))
    )


def count_where(cond: Column) -> Column:
    """Number of rows meeting `cond`, as BIGINT, 0 on empty input."""
    return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long")
