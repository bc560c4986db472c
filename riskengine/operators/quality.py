"""Data contracts: required columns, missing and infinite values, unusable messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.functions.features import (
    feature_columns,
    hour_of_day,
    log_amount,
    row_problem,
    unusable,
)
from riskengine.functions.values import count_where, is_missing
from riskengine.schema import FEATURES, LABEL, PCA_FEATURES, RAW_COLUMNS, ROW_ID


def require_columns(df: DataFrame, needed: list[str] = RAW_COLUMNS) -> None:
    """Raise on absent columns; looks at the schema only."""
    absent = [c for c in needed if c not in df.columns]
    if absent:
        raise ValueError(f"columns not present: {', '.join(absent)}")


def null_audit(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Missing values (NULL or NaN) per column, from one pass: (feature, n_missing)."""
    cols = cols or df.columns
    numeric = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    one = df.agg(
        *[
            count_where(is_missing(c) if c in numeric else F.col(c).isNull()).alias(c)
            for c in cols
        ]
    )
    items = ", ".join(f"'{c}', `{c}`" for c in cols)
    return one.select(F.expr(f"stack({len(cols)}, {items}) as (feature, n_missing)"))


def require_no_nulls(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Return df unchanged, or raise with the counts of the offending columns."""
    bad = {
        r["feature"]: r["n_missing"] for r in null_audit(df, cols).where("n_missing > 0").collect()
    }
    if bad:
        raise ValueError(f"{sum(bad.values())} missing values: {bad}")
    return df


def inf_audit(df: DataFrame, col: str) -> DataFrame:
    """Infinite and NaN values of one column."""
    c = F.col(col)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        count_where(F.abs(c) == float("inf")).alias("n_inf"),
        count_where(F.isnan(c)).alias("n_nan"),
    )


def require_no_inf(df: DataFrame, col: str) -> DataFrame:
    n = inf_audit(df, col).first()["n_inf"]
    if n:
        raise ValueError(f"{n} infinite values in {col}")
    return df


def compute_features(df: DataFrame, keep: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """The 30 model inputs (after any `keep` columns); the same projection for table and stream.

    `strict` makes the job fail on the first row that has no valid features.
    """
    require_columns(df)
    if strict:
        df = df.where(
            F.when(~unusable(), F.lit(True)).otherwise(
                F.raise_error(F.concat(F.lit("no features: "), row_problem()))
            )
        )
    return df.select(*keep, *feature_columns())


def transform_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("log_amount", log_amount())


def engineer_time(df: DataFrame) -> DataFrame:
    return df.withColumn("hour_of_day", hour_of_day())


def prepare_features(df: DataFrame) -> DataFrame:
    """All raw columns plus the two engineered ones."""
    require_columns(df)
    return df.withColumns({"log_amount": log_amount(), "hour_of_day": hour_of_day()})


def feature_matrix(df: DataFrame) -> DataFrame:
    """Row id, the 30 inputs and the label in one table, so nothing relies on row position."""
    return compute_features(df, keep=tuple(c for c in (ROW_ID, LABEL) if c in df.columns))


def prescale_check(df: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of each V column, from one pass."""
    cols = [c for c in PCA_FEATURES if c in df.columns]
    one = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]
    )
    items = ", ".join(f"'{c}', m_{c}, s_{c}" for c in cols)
    return one.select(F.expr(f"stack({len(cols)}, {items}) as (feature, mean, std)"))


def feature_names() -> list[str]:
    return list(FEATURES)
