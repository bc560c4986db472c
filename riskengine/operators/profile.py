"""Dataset summary, per-column profile, class comparison and amount outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.functions.values import (
    count_where,
    is_missing,
    ratio,
    sample_kurtosis,
    sample_skewness,
)
from riskengine.operators.ordered import melt
from riskengine.operators.quality import null_audit
from riskengine.operators.summaries import exact_quantiles, summarize
from riskengine.schema import LABEL, RAW_COLUMNS, TXN_SCHEMA

# The quantiles of a profile row and of the outlier report.
PROFILE_QUANTILES = {
    "median": 0.5,
    "p1": 0.01,
    "p5": 0.05,
    "p25": 0.25,
    "p75": 0.75,
    "p95": 0.95,
    "p99": 0.99,
}
OUTLIER_QUANTILES = {"q1": 0.25, "q3": 0.75, "p99": 0.99, "p999": 0.999}
FENCE_WIDTH = 1.5


def dataset_summary(df: DataFrame) -> DataFrame:
    """Row, column and class counts with the number of missing cells, from one pass."""
    cols = [c for c in TXN_SCHEMA.fieldNames() if c in df.columns]
    doubles = [c for c in cols if c != LABEL]
    missing = sum(
        [count_where(is_missing(c)) for c in doubles], start=count_where(F.col(LABEL).isNull())
    )
    fraud = F.col("n_fraud")
    rate = ratio(fraud, F.col("n_rows"), None)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        count_where(F.col(LABEL) == 1).alias("n_fraud"),
        count_where(F.col(LABEL) == 0).alias("n_legit"),
        missing.alias("n_missing"),
    ).select(
        "n_rows",
        F.lit(len(cols)).cast("long").alias("n_cols"),
        "n_fraud",
        "n_legit",
        rate.alias("fraud_rate"),
        (rate * 100).alias("fraud_rate_pct"),
        "n_missing",
    )


def column_summary(df: DataFrame) -> DataFrame:
    """Position, type and missing count of each column."""
    cols = [c for c in TXN_SCHEMA.fieldNames() if c in df.columns]
    place = F.create_map(*[F.lit(v) for i, c in enumerate(cols, 1) for v in (c, i)])
    kinds = F.create_map(
        *[F.lit(v) for c in cols for v in (c, df.schema[c].dataType.simpleString())]
    )
    return null_audit(df, cols).select(
        "feature",
        place[F.col("feature")].cast("long").alias("position"),
        kinds[F.col("feature")].alias("dtype"),
        "n_missing",
    )


def _profile(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    moments = {
        "mean": F.avg("value"),
        "std": F.stddev_samp("value"),
        "min": F.min("value"),
        "max": F.max("value"),
        "skewness": sample_skewness("value"),
        "kurtosis": sample_kurtosis("value"),
    }
    return summarize(df, cols, PROFILE_QUANTILES, by, moments).select(
        *by, "feature", "mean", "std", "median", "min", "max", "skewness", "kurtosis",
        "p1", "p5", "p25", "p75", "p95", "p99",
    )


def statistical_profile(df: DataFrame, cols: list[str] = RAW_COLUMNS) -> DataFrame:
    """13 statistics per column; quantiles are exact order statistics."""
    return _profile(df, cols, [])


def class_comparison(df: DataFrame, cols: list[str] = RAW_COLUMNS) -> DataFrame:
    """Fraud against legit means per column, from one pass; undefined when legit has no spread."""
    fraud = F.when(F.col(LABEL) == 1, F.col("value"))
    legit = F.when(F.col(LABEL) == 0, F.col("value"))
    stats = (
        melt(df, cols, keep=[LABEL])
        .groupBy("feature")
        .agg(
            F.avg(fraud).alias("fraud_mean"),
            F.avg(legit).alias("legit_mean"),
            F.stddev_samp(fraud).alias("fraud_std"),
            F.stddev_samp(legit).alias("legit_std"),
        )
    )
    diff = F.col("fraud_mean") - F.col("legit_mean")
    return stats.select(
        "feature",
        "fraud_mean",
        "legit_mean",
        diff.alias("mean_diff"),
        ratio(diff, F.col("legit_std"), float("nan")).alias("effect_size"),
        "fraud_std",
        "legit_std",
    )


def class_profiles(df: DataFrame, cols: list[str] = RAW_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """The full profile of the fraud rows and of the legit rows, found together."""
    both = _profile(df.where(F.col(LABEL).isin(0, 1)), cols, [LABEL])
    return tuple(both.where(F.col(LABEL) == y).drop(LABEL) for y in (1, 0))


def amount_outliers(df: DataFrame) -> DataFrame:
    """Amount fences and fraud rates on either side of them, with amount statistics by class."""
    by_class = df.select(
        "Amount",
        F.when(F.col(LABEL) == 1, F.col("Amount")).alias("fraud"),
        F.when(F.col(LABEL) == 0, F.col("Amount")).alias("legit"),
    )
    found = {
        r["feature"]: r
        for r in exact_quantiles(
            by_class, by_class.columns, {"median": 0.5, **OUTLIER_QUANTILES}
        ).collect()
    }
    if "Amount" not in found:
        raise ValueError("no amounts to analyse")
    q = found["Amount"]
    iqr = q["q3"] - q["q1"]
    upper = q["q3"] + FENCE_WIDTH * iqr
    lower = q["q1"] - FENCE_WIDTH * iqr
    amount, label = F.col("Amount"), F.col(LABEL)
    # A comparison with a missing amount is false, so such a row is not beyond the fence.
    beyond = F.coalesce(amount > upper, F.lit(False))
    extreme = F.coalesce(amount > q["p99"], F.lit(False))

    def rate(cond):
        return F.coalesce(F.avg(F.when(cond, label.cast("double"))), F.lit(0.0))

    fraud, legit = F.when(label == 1, amount), F.when(label == 0, amount)
    stats = df.agg(
        F.max(amount).alias("max_amount"),
        count_where(beyond).alias("n_outlier_iqr"),
        count_where(extreme).alias("n_extreme_p99"),
        rate(beyond).alias("fraud_rate_outlier_iqr"),
        rate(~beyond).alias("fraud_rate_normal"),
        rate(extreme).alias("fraud_rate_extreme_p99"),
        F.avg(label.cast("double")).alias("overall_fraud_rate"),
        F.avg(fraud).alias("fraud_amount_mean"),
        F.max(fraud).alias("fraud_amount_max"),
        F.stddev_samp(fraud).alias("fraud_amount_std"),
        F.avg(legit).alias("legit_amount_mean"),
        F.max(legit).alias("legit_amount_max"),
        F.stddev_samp(legit).alias("legit_amount_std"),
    )
    medians = {
        f"{who}_amount_median": found[who]["median"] if who in found else None
        for who in ("fraud", "legit")
    }
    fixed = {
        "q1": q["q1"],
        "q3": q["q3"],
        "iqr": iqr,
        "lower_fence": lower,
        "upper_fence": upper,
        "p99": q["p99"],
        "p999": q["p999"],
        **medians,
    }
    return stats.withColumns({k: F.lit(v).cast("double") for k, v in fixed.items()})

