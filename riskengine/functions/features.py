"""The two engineered features and the rules a raw row must meet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskengine.functions.values import is_missing
from riskengine.schema import PCA_FEATURES, RAW_COLUMNS

SECONDS_PER_DAY = 86400.0
SECONDS_PER_HOUR = 3600.0


def log_amount(col: str = "Amount") -> Column:
    """ln(1 + Amount). Spark's log1p is NULL at and below -1, so both cases are spelled out."""
    c = F.col(col)
    return (
        F.when(c == -1, F.lit(float("-inf")))
        .when(c < -1, F.lit(float("nan")))
        .otherwise(F.log1p(c))
    )


def hour_of_day(col: str = "Time") -> Column:
    """Hour within the day in [0, 24), also for negative offsets."""
    return F.pmod(F.col(col), F.lit(SECONDS_PER_DAY)) / SECONDS_PER_HOUR


def feature_columns() -> list[Column]:
    """The 30 model inputs in their fixed order."""
    return [
        *[F.col(c) for c in PCA_FEATURES],
        log_amount().alias("log_amount"),
        hour_of_day().alias("hour_of_day"),
    ]


def any_missing() -> Column:
    return reduce(lambda a, b: a | b, [is_missing(c) for c in RAW_COLUMNS])


def unusable() -> Column:
    """True for a raw row that cannot be turned into features; never NULL."""
    return any_missing() | (F.col("Amount") == -1)


def row_problem() -> Column:
    """What is wrong with an unusable row; NULL for a usable one."""
    absent = F.filter(
        F.array(*[F.when(is_missing(c), F.lit(c)) for c in RAW_COLUMNS]), lambda c: c.isNotNull()
    )
    return F.when(
        any_missing(), F.concat(F.lit("missing:"), F.array_join(absent, ","))
    ).when(F.col("Amount") == -1, F.lit("infinite:log_amount"))
