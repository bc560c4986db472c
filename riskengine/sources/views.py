"""The views of FIXTURES.md over the given tables: transactions, scores, registry history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskengine.functions.values import ratio
from riskengine.schema import LABEL, PCA_FEATURES

# Fixed values of the test views.
EPOCH_START = 1704067200
POSITIVE_LABEL = 3
AUC_DIVISOR = 500000.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per event; its V columns and label come from the embedding it maps to."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    vectors = table(spark, sf_dir, "embeddings")
    n_vectors = vectors.count()  # from the Parquet footers, no column is read
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("txn_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("Amount"),
        F.pmod(F.col("event_id"), F.lit(n_vectors)).alias("vec_id"),
    )
    return events.join(vectors, "vec_id").select(
        "txn_id",
        "ts",
        (F.unix_seconds("ts") - EPOCH_START).cast("double").alias("Time"),
        *[
            F.element_at("embedding", i).cast("double").alias(c)
            for i, c in enumerate(PCA_FEATURES, start=1)
        ],
        "Amount",
        F.when(F.col("label") == POSITIVE_LABEL, 1).otherwise(0).cast("int").alias(LABEL),
    )


def add_formula_score(txn: DataFrame) -> DataFrame:
    """Two deterministic stand-in model scores, with ties, and a latency per row."""
    def squash(z: str):
        return F.lit(0.5) + F.lit(0.5) * F.col(z) / (1 + F.abs(F.col(z)))

    return (
        txn.withColumns(
            {
                "za": F.round(10 * (F.col("V6") + F.col("V21")) - 1, 2),
                "zb": F.round(10 * F.col("V6") - 1, 2),
            }
        )
        .withColumns(
            {
                "p": squash("za"),
                "p_b": squash("zb"),
                "scoring_latency_ms": 5 + F.pmod(F.col("txn_id"), F.lit(97)) / 10.0,
            }
        )
        .drop("za", "zb")
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_formula_score(transactions(spark, sf_dir)).select(
        "txn_id",
        F.col("ts").alias("scored_at"),
        "Time",
        "Amount",
        LABEL,
        "p",
        "p_b",
        "scoring_latency_ms",
    )


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry history: one model per customer, one version per order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("model_name"),
        F.col("o_orderkey").alias("version"),
        ratio(F.col("o_totalprice"), F.lit(AUC_DIVISOR)).alias("auc_pr"),
    )
