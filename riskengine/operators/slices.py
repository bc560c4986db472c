"""Confusion tables per amount band and per part of the day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskengine.functions.values import count_where, ratio
from riskengine.operators.curves import confusion_aggs, flagged
from riskengine.schema import LABEL

# Half-open bands [low, high) and their names.
AMOUNT_BANDS = [
    (0.0, 10.0, "$0-10"),
    (10.0, 50.0, "$10-50"),
    (50.0, 200.0, "$50-200"),
    (200.0, 1000.0, "$200-1K"),
    (1000.0, float("inf"), "$1K+"),
]
HOUR_BANDS = [
    (0.0, 6.0, "00:00-06:00"),
    (6.0, 12.0, "06:00-12:00"),
    (12.0, 18.0, "12:00-18:00"),
    (18.0, 24.0, "18:00-24:00"),
]


def band(col: str, bands: list[tuple[float, float, str]]) -> Column:
    """Name of the band a value falls in; NULL outside all of them."""
    c = F.col(col)
    out = F.lit(None).cast("string")
    for low, high, name in reversed(bands):
        out = F.when((c >= low) & (c < high), F.lit(name)).otherwise(out)
    return out


def _by_band(df, col, bands, threshold, score) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return (
        df.withColumn("band", band(col, bands))
        .where(F.col("band").isNotNull())
        .groupBy("band")
        .agg(
            F.count(F.lit(1)).alias("n_total"),
            count_where(F.col(LABEL) == 1).alias("n_fraud"),
            *confusion_aggs(flagged(score, threshold)),
        )
        .withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn)})
    )


def slice_by_amount(df: DataFrame, threshold: float, score: str = "p") -> DataFrame:
    return _by_band(df, "Amount", AMOUNT_BANDS, threshold, score)


def slice_by_hour(df: DataFrame, threshold: float, score: str = "p") -> DataFrame | None:
    """As by amount, over six-hour bands; None when the table has no hour_of_day."""
    if "hour_of_day" not in df.columns:
        return None
    return _by_band(df, "hour_of_day", HOUR_BANDS, threshold, score)
