"""Turning probabilities into published decisions, and statistics over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskengine.functions.values import count_where, ratio
from riskengine.operators.curves import flagged
from riskengine.operators.summaries import exact_quantiles
from riskengine.schema import LABEL

# Fixed values.
PROBABILITY_PLACES = 6
LATENCY_PLACES = 3
RECENT_LIMIT = 100
LATENCY_QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def score_payload(
    df: DataFrame, threshold: float, score: str = "p", latency: Column | None = None,
    scored_at: Column | None = None,
) -> DataFrame:
    """The published record: the input without its label plus five scoring fields.

    The flag compares the unrounded score; only the published probability is rounded.
    """
    latency = F.lit(None).cast("double") if latency is None else latency
    scored_at = F.current_timestamp() if scored_at is None else scored_at
    replaced = (LABEL, score, "scoring_latency_ms", "scored_at")
    kept = [c for c in df.columns if c not in replaced]
    return df.select(
        *kept,
        F.round(score, PROBABILITY_PLACES).alias("fraud_probability"),
        flagged(score, threshold).alias("is_fraud"),
        F.lit(float(threshold)).alias("threshold_used"),
        F.round(latency, LATENCY_PLACES).alias("scoring_latency_ms"),
        scored_at.alias("scored_at"),
    )


def scoring_stats(payload: DataFrame) -> DataFrame:
    """Totals, flag rate and latency statistics; zeros for no rows."""
    latency = "scoring_latency_ms"
    q = exact_quantiles(payload, [latency], LATENCY_QUANTILES).first()
    zero = F.lit(0.0)
    flags = count_where(F.col("is_fraud"))
    out = payload.agg(
        F.count(F.lit(1)).alias("total_scored"),
        flags.alias("total_flagged"),
        ratio(flags, F.count(F.lit(1))).alias("flag_rate"),
        F.coalesce(F.avg(latency), zero).alias("latency_mean"),
        F.coalesce(F.min(latency), zero).alias("latency_min"),
        F.coalesce(F.max(latency), zero).alias("latency_max"),
    )
    return out.withColumns(
        {f"latency_{k}": F.lit(float(q[k]) if q else 0.0) for k in LATENCY_QUANTILES}
    )


def stats_from_histogram(cells: DataFrame) -> DataFrame:
    """The same statistics from (scoring_latency_ms, n, n_flagged) cells."""
    latency, n = "scoring_latency_ms", F.col("n")
    zero = F.lit(0.0)
    total = F.coalesce(F.sum(n), F.lit(0))
    hits = F.coalesce(F.sum("n_flagged"), F.lit(0))

    def pct(q):
        return F.coalesce(F.percentile(F.col(latency), F.lit(q), n), zero)

    return cells.agg(
        total.alias("total_scored"),
        hits.alias("total_flagged"),
        ratio(hits, total).alias("flag_rate"),
        F.coalesce(ratio(F.sum(F.col(latency) * n), F.sum(n), None), zero).alias("latency_mean"),
        F.coalesce(F.min(latency), zero).alias("latency_min"),
        F.coalesce(F.max(latency), zero).alias("latency_max"),
        *[pct(q).alias(f"latency_{k}") for k, q in LATENCY_QUANTILES.items()],
    )


def recent(payload: DataFrame, n: int = 20, limit: int = RECENT_LIMIT) -> DataFrame:
    """The last min(n, limit) scored records, oldest first; nothing for n <= 0."""
    n = max(0, min(n, limit))
    newest = payload.orderBy(F.desc("scored_at"), F.desc("txn_id")).limit(n)
    return newest.orderBy("scored_at", "txn_id")
