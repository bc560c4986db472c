"""Train, compare, choose a threshold, register and gate: the batch training run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.operators.bootstrap import bootstrap_samples, bootstrap_summary, model_choice
from riskengine.operators.costs import CostMatrix, scale_pos_weight
from riskengine.operators.curves import (
    candidate_thresholds,
    compute_metrics,
    optimal_threshold,
    threshold_sweep,
)
from riskengine.operators.learners import (
    predict,
    reconstruction_error,
    train_autoencoder,
    train_ensemble,
    train_gbt,
)
from riskengine.operators.quality import prepare_features
from riskengine.operators.slices import slice_by_amount, slice_by_hour
from riskengine.operators.split import time_split
from riskengine.schema import LABEL
from riskengine.session import materialize
from riskengine.sources.files import save_csv, save_threshold

BASELINE = "baseline"
ENSEMBLE = "ensemble"


@dataclass(frozen=True)
class TrainingResult:
    """Models, scored hold-out rows and the small result tables."""

    chosen: str
    model: PipelineModel
    costs: CostMatrix
    auc_pr: float
    threshold: float
    holdout: DataFrame
    metrics: DataFrame
    samples: DataFrame
    bootstrap: DataFrame
    choice: DataFrame
    best_threshold: DataFrame
    candidates: DataFrame
    by_amount: DataFrame
    by_hour: DataFrame | None


def train_and_evaluate(
    txn: DataFrame, n_bootstraps: int = 1000, encoding_dim: int = 14, **tree_settings
) -> TrainingResult:
    """The whole training run on one table of transactions."""
    prepared = materialize(prepare_features(txn), "prepared")
    train, test = time_split(prepared)
    weight = scale_pos_weight(train)
    encoder = train_autoencoder(train.where(F.col(LABEL) == 0), encoding_dim)
    train = reconstruction_error(train, encoder)
    test = reconstruction_error(test, encoder)
    models = {
        BASELINE: train_gbt(train, weight, **tree_settings),
        ENSEMBLE: train_ensemble(train, weight, **tree_settings),
    }
    both = predict(models[ENSEMBLE], predict(models[BASELINE], test, "p"), "p_b")
    holdout = materialize(both, "holdout")
    costs = CostMatrix().calibrate(prepared)

    samples = materialize(bootstrap_samples(holdout, n_bootstraps=n_bootstraps), "samples")
    summary = materialize(bootstrap_summary(samples), "bootstrap")
    choice = model_choice(summary, BASELINE, ENSEMBLE)
    chosen = choice.first()["chosen"]
    score = "p" if chosen == BASELINE else "p_b"
    metrics = materialize(
        compute_metrics(holdout, "p")
        .withColumn("model", F.lit(BASELINE))
        .unionByName(compute_metrics(holdout, "p_b").withColumn("model", F.lit(ENSEMBLE))),
        "metrics",
    )
    best = materialize(optimal_threshold(threshold_sweep(holdout, costs, score)), "threshold")
    threshold = best.first()["optimal_threshold"]
    return TrainingResult(
        chosen=chosen,
        model=models[chosen],
        costs=costs,
        auc_pr=metrics.where(F.col("model") == chosen).first()["auc_pr"],
        threshold=threshold,
        holdout=holdout,
        metrics=metrics,
        samples=samples,
        bootstrap=summary,
        choice=choice,
        best_threshold=best,
        candidates=candidate_thresholds(holdout, costs, score=score),
        by_amount=slice_by_amount(holdout, threshold, score),
        by_hour=slice_by_hour(holdout, threshold, score),
    )


def save_result(result: TrainingResult, folder: str) -> None:
    """Persist the model, the threshold config, the hold-out predictions and the resamples."""
    spark = result.holdout.sparkSession
    result.model.write().overwrite().save(f"{folder}/model")
    save_threshold(
        f"{folder}/threshold_config", spark, result.best_threshold, result.auc_pr, result.chosen
    )
    save_csv(
        result.holdout.select(
            F.col(LABEL).alias("y_true"),
            F.col("p").alias("baseline_prob"),
            F.col("p_b").alias("ensemble_prob"),
        ),
        f"{folder}/test_predictions",
    )
    save_csv(result.samples, f"{folder}/bootstrap_samples")


def load_serving_model(
    stages: DataFrame | None, registry_root: str, fallback: str, model_name: str
) -> tuple[PipelineModel, str]:
    """The Production version of `model_name` in a registry_stages table, else the local copy with a warning.

    A registered model lives under `registry_root`/<model_name>/<version>.
    """
    import logging

    log = logging.getLogger(__name__)
    if stages is not None:
        row = stages.where(
            (F.col("stage") == "Production") & (F.col("model_name") == model_name)
        ).first()
        if row is not None:
            path = f"{registry_root}/{row['model_name']}/{row['version']}"
            try:
                return PipelineModel.load(path), "registry"
            except Exception as error:  # any storage failure leads to the fallback
                log.warning("registered model at %s not usable: %s", path, error)
        else:
            log.warning("no version of %s is in Production", model_name)
    log.warning("using the local model at %s", fallback)
    return PipelineModel.load(fallback), "local_fallback"
