"""Class balance and the cost of decisions."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskengine.functions.values import count_where, ratio
from riskengine.schema import LABEL


@dataclass(frozen=True)
class CostMatrix:
    """Unit cost of each outcome; a missed fraud costs the mean fraud amount once calibrated."""

    # Default unit costs.
    fn_cost: float | None = None
    fp_cost: float = 10.0
    tp_cost: float = 0.0
    tn_cost: float = 0.0
    avg_fraud_amount: float | None = None

    def calibrate(self, df: DataFrame) -> CostMatrix:
        """Take the mean fraud amount of `df` (one aggregate, one number back) as fn_cost."""
        mean = fraud_amount(df).first()["avg_fraud_amount"]
        mean = float("nan") if mean is None else mean
        return replace(self, fn_cost=mean, avg_fraud_amount=mean)

    def columns(self) -> dict[str, Column]:
        """Cost columns over a table with tp, fp, fn, tn."""
        if self.fn_cost is None:
            raise ValueError("fn_cost is unset: calibrate the matrix first")
        units = {
            "tp": self.tp_cost,
            "fp": self.fp_cost,
            "fn": self.fn_cost,
            "tn": self.tn_cost,
        }
        parts = {f"{k}_cost": F.col(k) * F.lit(float(u)) for k, u in units.items()}
        total = parts["tp_cost"] + parts["fp_cost"] + parts["fn_cost"] + parts["tn_cost"]
        return {**parts, "total_cost": total}


def fraud_amount(df: DataFrame) -> DataFrame:
    return df.agg(F.avg(F.when(F.col(LABEL) == 1, F.col("Amount"))).alias("avg_fraud_amount"))


def cost_calibration(df: DataFrame, base: CostMatrix = CostMatrix()) -> DataFrame:
    """The calibrated matrix of `df` as a one-row table."""
    mean = F.col("avg_fraud_amount")
    return fraud_amount(df).select(
        mean.alias("fn_cost"),
        F.lit(base.fp_cost).alias("fp_cost"),
        F.lit(base.tp_cost).alias("tp_cost"),
        F.lit(base.tn_cost).alias("tn_cost"),
        "avg_fraud_amount",
        ratio(mean, F.lit(base.fp_cost), None).alias("cost_ratio"),
    )


def expected_cost(confusion: DataFrame, costs: CostMatrix) -> DataFrame:
    """Add the four cost products and their total to rows of confusion counts."""
    return confusion.withColumns(costs.columns())


def class_counts(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_total"),
        count_where(F.col(LABEL) == 1).alias("n_fraud"),
        count_where(F.col(LABEL) == 0).alias("n_legit"),
    )


def imbalance(df: DataFrame) -> DataFrame:
    """Fraud rate and the legit:fraud ratio; infinite ratio and weight 1 without fraud."""
    fraud, legit, n = F.col("n_fraud"), F.col("n_legit"), F.col("n_total")
    rate = ratio(fraud, n, None)
    return class_counts(df).select(
        "n_fraud",
        "n_legit",
        "n_total",
        rate.alias("fraud_rate"),
        (rate * 100).alias("fraud_rate_pct"),
        ratio(legit, fraud, float("inf")).alias("imbalance_ratio"),
        ratio(legit, fraud, 1.0).alias("scale_pos_weight"),
    )


def naive_baseline(df: DataFrame) -> DataFrame:
    """Accuracy of calling every transaction legitimate."""
    accuracy = ratio(F.col("n_legit"), F.col("n_total"), None)
    return class_counts(df).select(
        accuracy.alias("accuracy"),
        (accuracy * 100).alias("accuracy_pct"),
        F.col("n_legit").alias("n_correct"),
        F.col("n_fraud").alias("n_wrong"),
    )


def scale_pos_weight(train: DataFrame) -> float:
    """Legit per fraud row of the training side; an error when it has no fraud."""
    row = class_counts(train).first()
    if not row["n_fraud"]:
        raise ValueError("the training rows hold no fraud, the class weight is undefined")
    return row["n_legit"] / row["n_fraud"]


def cost_scenario(
    df: DataFrame, costs: CostMatrix, recall: float = 0.80, fpr: float = 0.02
) -> DataFrame:
    """Cost of a detector with a given recall and false-positive rate; counts are truncated."""
    tp = F.floor(F.col("n_fraud") * F.lit(recall))
    fp = F.floor(F.col("n_legit") * F.lit(fpr))
    counts = class_counts(df).select(
        tp.alias("tp"),
        fp.alias("fp"),
        (F.col("n_fraud") - tp).alias("fn"),
        (F.col("n_legit") - fp).alias("tn"),
    )
    return expected_cost(counts, costs)
