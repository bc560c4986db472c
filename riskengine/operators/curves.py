"""Ordered-curve metrics and threshold choice over (label, score) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskengine.functions.values import count_where, is_missing, plain, ratio
from riskengine.operators.costs import CostMatrix
from riskengine.operators.ordered import BUCKET, bucketed, find_edges, running_totals
from riskengine.schema import LABEL

# Fixed values.
N_THRESHOLDS = 1000
CANDIDATE_THRESHOLDS = (0.10, 0.20, 0.30, 0.50, 0.70, 0.90)
DEFAULT_THRESHOLD = 0.5


def score_curve(
    df: DataFrame,
    score: str = "p",
    label: str = LABEL,
    weight: str | None = None,
    keys: list[str] | None = None,
    edges: list[float] | None = None,
) -> DataFrame:
    """One row per distinct score (and key), best score first: pos, neg, pos_cum, n_cum.

    Rows are collapsed to distinct scores on the map side, so ties are grouped exactly and the
    shuffle carries distinct scores only.
    """
    keys = keys or []
    edges = edges or find_edges(df, [score])[score]
    w = F.col(weight) if weight else F.lit(1)
    rows = df.where(~is_missing(score)).select(
        *keys,
        plain(score).alias("score"),
        F.when(F.col(label) == 1, w).otherwise(0).cast("long").alias("pos"),
        w.cast("long").alias("n"),
    )
    groups = (
        bucketed(rows, {"score": edges})
        .withColumnRenamed("score__b", BUCKET)
        .groupBy(*keys, BUCKET, "score")
        .agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    )
    return running_totals(groups, keys, "score", ["pos", "n"], descending=True)


def curve_areas(curve: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Average precision (0 without positives) and tie-corrected ROC area (NULL on one class)."""
    pos, n = F.col("pos").cast("double"), F.col("n").cast("double")
    neg = n - pos
    precision = F.col("pos_cum").cast("double") / F.col("n_cum").cast("double")
    before = F.col("pos_cum").cast("double") - pos
    return curve.groupBy(*(keys or [])).agg(
        F.sum("pos").alias("n_pos"),
        F.sum("n").alias("n_rows"),
        ratio(F.sum(pos * precision), F.sum(pos)).alias("auc_pr"),
        ratio(F.sum(neg * before + 0.5 * pos * neg), F.sum(pos) * F.sum(neg), None).alias(
            "auc_roc"
        ),
    )


def compute_metrics(df: DataFrame, score: str = "p", label: str = LABEL) -> DataFrame:
    """AUC-PR and AUC-ROC of one score column."""
    return curve_areas(score_curve(df, score, label))


def threshold_at(i: Column, n_thresholds: int = N_THRESHOLDS) -> Column:
    """The i-th of n + 1 evenly spaced thresholds, by the product i * (1 / n)."""
    return i.cast("double") * F.lit(1.0 / n_thresholds)


def _highest_passing(p: Column, n: int) -> Column:
    """Index of the highest threshold <= p; -1 when even the first one fails."""
    guess = F.floor(p * n).cast("long")
    fixed = (
        F.when(threshold_at(guess + 1, n) <= p, guess + 1)
        .when(threshold_at(guess, n) > p, guess - 1)
        .otherwise(guess)
    )
    return F.when(is_missing(p) | (p < 0), F.lit(-1)).when(p >= 1, F.lit(n)).otherwise(fixed)


def threshold_sweep(
    df: DataFrame,
    costs: CostMatrix,
    score: str = "p",
    label: str = LABEL,
    n_thresholds: int = N_THRESHOLDS,
) -> DataFrame:
    """Confusion counts and cost at every threshold, from one histogram of the scores.

    Each row is counted once, at its highest passing threshold; a reverse running sum over the
    n + 2 histogram cells then gives all counts. Only the histogram is ordered in one task.
    """
    spark = df.sparkSession
    cells = (
        df.select(
            _highest_passing(F.col(score), n_thresholds).cast("long").alias("i"),
            F.col(label).alias("y"),
        )
        .groupBy("i")
        .agg(count_where(F.col("y") == 1).alias("pos"), count_where(F.col("y") == 0).alias("neg"))
    )
    grid = spark.range(-1, n_thresholds + 1, numPartitions=1).withColumnRenamed("id", "i")
    down = Window.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    counts = (
        grid.join(cells, "i", "left")
        .na.fill(0, ["pos", "neg"])
        .select(
            "i",
            F.sum("pos").over(down).alias("tp"),
            F.sum("neg").over(down).alias("fp"),
            F.sum("pos").over(everything).alias("n_pos"),
            F.sum("neg").over(everything).alias("n_neg"),
        )
        .where("i >= 0")
        .select(
            "i",
            threshold_at(F.col("i"), n_thresholds).alias("threshold"),
            "tp",
            "fp",
            (F.col("n_pos") - F.col("tp")).alias("fn"),
            (F.col("n_neg") - F.col("fp")).alias("tn"),
        )
    )
    return counts.withColumn("total_cost", costs.columns()["total_cost"])


def _quality() -> dict[str, Column]:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return {"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn)}


def optimal_threshold(sweep: DataFrame, n_thresholds: int = N_THRESHOLDS) -> DataFrame:
    """The cheapest threshold of a sweep (the lowest one on ties) and the cost at 0.5."""
    fields = ["total_cost", "i", "threshold", "tp", "fp", "fn", "tn"]
    default = int(n_thresholds * DEFAULT_THRESHOLD)
    best = sweep.agg(
        F.min(F.struct(*fields)).alias("best"),
        F.max(F.when(F.col("i") == default, F.col("total_cost"))).alias("cost_at_default"),
    )
    return (
        best.select(
            F.col("best.threshold").alias("optimal_threshold"),
            F.col("best.total_cost").alias("min_cost"),
            *[f"best.{c}" for c in ("tp", "fp", "fn", "tn")],
            "cost_at_default",
        )
        .withColumns(_quality())
        .select(
            "optimal_threshold", "min_cost", "tp", "fp", "fn", "tn", "precision", "recall",
            "cost_at_default",
        )
    )


def confusion_aggs(flag: Column, label: str = LABEL) -> list[Column]:
    """tp, fp, fn, tn aggregates of a boolean flag; rows without a score count as not flagged."""
    flag = F.coalesce(flag, F.lit(False))
    y = F.col(label)
    return [
        count_where(flag & (y == 1)).alias("tp"),
        count_where(flag & (y == 0)).alias("fp"),
        count_where(~flag & (y == 1)).alias("fn"),
        count_where(~flag & (y == 0)).alias("tn"),
    ]


def flagged(score: str, threshold: float) -> Column:
    """score >= threshold; a NaN score, which Spark orders above every number, never passes."""
    return (F.col(score) >= F.lit(float(threshold))) & ~F.isnan(score)


def confusion_at(
    df: DataFrame, threshold: float, costs: CostMatrix, score: str = "p", label: str = LABEL
) -> DataFrame:
    """Confusion counts, precision, recall, F1 and costs at one threshold."""
    return candidate_thresholds(df, costs, (threshold,), score, label)


def candidate_thresholds(
    df: DataFrame,
    costs: CostMatrix,
    thresholds: tuple[float, ...] = CANDIDATE_THRESHOLDS,
    score: str = "p",
    label: str = LABEL,
) -> DataFrame:
    """confusion_at for several thresholds, all in one pass over the rows."""
    y = F.col(label)
    aggs = [count_where(y == 1).alias("n_pos"), count_where(y == 0).alias("n_neg")]
    for i, t in enumerate(thresholds):
        hit = F.coalesce(flagged(score, t), F.lit(False))
        aggs.append(count_where(hit & (y == 1)).alias(f"tp{i}"))
        aggs.append(count_where(hit & (y == 0)).alias(f"fp{i}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("threshold"),
                F.col(f"tp{i}").alias("tp"),
                F.col(f"fp{i}").alias("fp"),
                (F.col("n_pos") - F.col(f"tp{i}")).alias("fn"),
                (F.col("n_neg") - F.col(f"fp{i}")).alias("tn"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    p, r = F.col("precision"), F.col("recall")
    return (
        df.agg(*aggs)
        .select(F.inline(rows))
        .withColumns(_quality())
        .withColumn("f1", ratio(2 * p * r, p + r))
        .withColumns(costs.columns())
    )
