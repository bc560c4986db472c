"""Drift check, branch, retrain, register, gate: the scheduled retraining run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.operators.drift import (
    both_sides,
    drift_decision,
    drift_report,
    reference_sample,
)
from riskengine.operators.governance import RETRAIN, SKIP, promotion_gate, register_versions


@dataclass(frozen=True)
class RetrainOutcome:
    """What the check decided and, after a retrain, the verdict on the candidate."""

    branch: str
    decision: DataFrame
    registered: DataFrame | None = None
    verdict: DataFrame | None = None


def decide_branch(drift_detected: bool, is_scheduled: bool = False) -> str:
    return RETRAIN if drift_detected or is_scheduled else SKIP


def check_drift(reference: DataFrame, current: DataFrame, **limits) -> DataFrame:
    """Current rows against all training rows of the reference: one decision row."""
    ref = reference_sample(reference)
    return drift_decision(drift_report(both_sides(ref, current)), **limits)


def run_retraining(
    reference: DataFrame,
    current: DataFrame,
    registry: DataFrame,
    retrain: Callable[[], tuple[str, int, float]],
    model_name: str,
    is_scheduled: bool = False,
) -> RetrainOutcome:
    """registry (model_name, run_id, version, auc_pr); `retrain` returns (name, run id, AUC-PR)."""
    decision = check_drift(reference, current)
    drifted = bool(decision.first()["drift_detected"])
    branch = decide_branch(drifted, is_scheduled)
    if branch == SKIP:
        return RetrainOutcome(branch, decision)
    name, run_id, auc_pr = retrain()
    run = reference.sparkSession.range(1).select(
        F.lit(name or model_name).alias("model_name"),
        F.lit(run_id).cast(registry.schema["run_id"].dataType).alias("run_id"),
        F.lit(float(auc_pr)).alias("auc_pr"),
    )
    registered = register_versions(run, registry)
    history = registry.select("model_name", "version", "auc_pr").unionByName(
        registered.select("model_name", "version", F.col("tag_auc_pr").alias("auc_pr"))
    )
    verdict = promotion_gate(history).join(
        registered.select("model_name", "version"), ["model_name", "version"], "left_semi"
    )
    return RetrainOutcome(branch, decision, registered, verdict)
