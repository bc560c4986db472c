"""Registry tables: which runs get a version, which version serves, when to retrain."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.operators.ordered import hot_key_buckets, running_count, running_max
from riskengine.session import materialize

# Fixed values.
MIN_IMPROVEMENT = 1e-4
RETRAIN = "retrain_model_task"
SKIP = "skip_retrain_task"
WEEKLY_RUN_DAY = 1  # Sunday in dayofweek()

# A model with more runs than this is worked on in several version ranges.
HOT_MODEL_RUNS = 1_000_000


def register_versions(
    runs: DataFrame, registry: DataFrame, hot_rows: int = HOT_MODEL_RUNS
) -> DataFrame:
    """New registry rows: one Staging version per run id that the registry does not know yet.

    runs (model_name, run_id, auc_pr), registry (model_name, run_id, version). Versions go on
    from the highest of the model, in run id order.
    """
    fresh = (
        runs.groupBy("model_name", "run_id")
        .agg(F.max("auc_pr").alias("auc_pr"))  # a run offered twice is one run
        .join(registry.select("model_name", "run_id"), ["model_name", "run_id"], "left_anti")
    )
    latest = registry.groupBy("model_name").agg(F.max("version").alias("latest"))
    parts, split = hot_key_buckets(fresh, ["model_name"], "run_id", hot_rows)
    numbered = running_count(parts, ["model_name"], "run_id", "nth", split)
    return numbered.join(latest, "model_name", "left").select(
        "model_name",
        "run_id",
        (F.coalesce("latest", F.lit(0)) + F.col("nth")).cast("long").alias("version"),
        F.lit("Staging").alias("stage"),
        F.col("auc_pr").alias("tag_auc_pr"),
    )


def _promotions(margin: float):
    """Find the promoted runs among strict running records, model by model, in version order.

    Scores rise within a model, so the next promotion is one binary search away.
    """

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, serving = None, None
        for batch in batches:
            names, scores = batch["model_name"].to_numpy(), batch["score"].to_numpy()
            starts = np.flatnonzero(np.r_[True, names[1:] != names[:-1]]) if len(names) else []
            keep = []
            for start, end in zip(starts, [*starts[1:], len(names)]):
                at = start
                if names[start] == model:  # goes on from the batch before
                    at += np.searchsorted(scores[start:end], serving + margin, side="right")
                while at < end:
                    keep.append(at)
                    model, serving = names[at], scores[at]
                    at += np.searchsorted(scores[at:end], serving + margin, side="right")
            yield batch.iloc[keep][["model_name", "version"]]

    return walk


def promotion_gate(
    runs: DataFrame, min_improvement: float = MIN_IMPROVEMENT, hot_rows: int = HOT_MODEL_RUNS
) -> DataFrame:
    """Decide every run of a registry history in version order.

    runs (model_name, version, auc_pr[, tag_auc_pr]). The first run of a model is promoted; a
    later one only when it beats the serving score by more than the margin. A promoted run
    therefore beats every run before it, so only strict running records can be promoted: those
    are found in parallel and only they are read in order, batch by batch, holding one number. The
    bucketed runs are read three times and therefore written once.
    """
    tag = F.col("tag_auc_pr") if "tag_auc_pr" in runs.columns else F.lit(None).cast("double")
    scored = runs.select(
        "model_name", "version", F.coalesce("auc_pr", tag, F.lit(0.0)).alias("score")
    )
    parts, split = hot_key_buckets(scored, ["model_name"], "version", hot_rows)
    parts = materialize(parts, "runs")
    keys = ["model_name"]
    records = running_max(parts, keys, "version", F.col("score"), "best", split).where(
        F.col("best").isNull() | (F.col("score") > F.col("best"))
    )
    promoted = (
        records.select("model_name", "version", "score")
        .repartition("model_name")
        .sortWithinPartitions("model_name", "version")
        .mapInPandas(
            _promotions(min_improvement),
            schema=records.select("model_name", "version").schema,
        )
        .withColumn("promoted", F.lit(True))
    )
    marked = parts.join(promoted, ["model_name", "version"], "left").withColumn(
        "promoted", F.coalesce("promoted", F.lit(False))
    )
    serving = F.when(F.col("promoted"), F.struct("version", "score"))
    judged = running_max(marked, keys, "version", serving, "serving", split)
    first = F.col("serving").isNull()
    return judged.select(
        "model_name",
        "version",
        F.col("score").alias("auc_pr"),
        F.when(F.col("promoted"), "promoted").otherwise("rejected").alias("action"),
        F.when(first, "initial_deployment")
        .when(F.col("promoted"), "strictly_superior")
        .otherwise("not_strictly_superior")
        .alias("reason"),
        F.col("serving.version").alias("previous_version"),
        F.col("serving.score").alias("previous_auc_pr"),
    )


def registry_stages(decisions: DataFrame) -> DataFrame:
    """Stage of every version after the last decision: one Production version per model."""
    top = decisions.groupBy("model_name").agg(
        F.max(F.when(F.col("action") == "promoted", F.col("version"))).alias("serving")
    )
    return decisions.join(top, "model_name").select(
        "model_name",
        "version",
        "auc_pr",
        F.when(F.col("version") == F.col("serving"), "Production")
        .when(F.col("action") == "promoted", "Archived")
        .otherwise("Staging")
        .alias("stage"),
    )


def retrain_decision(decisions: DataFrame, window_start: str = "window_start") -> DataFrame:
    """Retrain on drift or on the weekly schedule, else skip; one row per window."""
    scheduled = F.dayofweek(window_start) == WEEKLY_RUN_DAY
    return decisions.select(
        window_start,
        "drift_detected",
        scheduled.alias("is_scheduled"),
        F.when(F.col("drift_detected") | scheduled, RETRAIN).otherwise(SKIP).alias("branch"),
    )
