"""Boosted trees, a linear autoencoder, and the ensemble that uses its error."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.operators.boosting import fit_trees
from riskengine.schema import FEATURES, LABEL

# Learner settings.
N_TREES = 200
MAX_DEPTH = 6
LEARNING_RATE = 0.1
SEED = 42
ENCODING_DIM = 14


def train_gbt(
    train: DataFrame,
    pos_weight: float,
    features: list[str] = FEATURES,
    n_trees: int = N_TREES,
    max_depth: int = MAX_DEPTH,
    learning_rate: float = LEARNING_RATE,
    seed: int = SEED,
) -> PipelineModel:
    """Boosted trees on logistic loss, with positives weighted by `pos_weight`."""
    trees = GBTClassifier(
        featuresCol="inputs",
        labelCol=LABEL,
        weightCol="w",
        maxIter=n_trees,
        maxDepth=max_depth,
        stepSize=learning_rate,
        seed=seed,
        checkpointInterval=10,
    )
    assemble = VectorAssembler(inputCols=features, outputCol="inputs", handleInvalid="error")
    return PipelineModel([assemble, fit_trees(train, features, LABEL, pos_weight, trees)])


def predict(model: PipelineModel, df: DataFrame, out: str = "p") -> DataFrame:
    """Add the probability of fraud; works on tables and on streams."""
    return model.transform(df).withColumn(out, vector_to_array("probability")[1]).drop(
        "inputs", "rawPrediction", "probability", "prediction"
    )


@dataclass(frozen=True)
class LinearAutoencoder:
    """Centre, scale and an orthonormal basis: the best linear encoder of its training rows."""

    features: list[str]
    mean: list[float]
    std: list[float]
    basis: list[list[float]]  # one row per feature, one column per component


def train_autoencoder(
    legit: DataFrame, encoding_dim: int = ENCODING_DIM, features: list[str] = FEATURES
) -> LinearAutoencoder:
    """Fit on legitimate training rows only. Spark computes the moments and the covariance."""
    stages = [
        VectorAssembler(inputCols=features, outputCol="raw", handleInvalid="error"),
        StandardScaler(inputCol="raw", outputCol="z", withMean=True, withStd=True),
        PCA(k=encoding_dim, inputCol="z", outputCol="code"),
    ]
    _, scaler, pca = Pipeline(stages=stages).fit(legit.select(*features)).stages
    return LinearAutoencoder(
        list(features),
        [float(v) for v in scaler.mean],
        [float(v) for v in scaler.std],
        pca.pc.toArray().tolist(),
    )


def reconstruction_error(
    df: DataFrame, model: LinearAutoencoder | None, out: str = "recon_error"
) -> DataFrame:
    """Mean squared residual per row: |z|^2 less the part the basis explains (0 without a model)."""
    if model is None:
        return df.withColumn(out, F.lit(0.0))
    z_names = [f"z{i}__" for i in range(len(model.features))]
    # A constant training column scales to 0, as the scaler does.
    scaled = df.withColumns(
        {
            z: (F.col(c) - F.lit(m)) / F.lit(s) if s > 0 else F.lit(0.0)
            for z, c, m, s in zip(z_names, model.features, model.mean, model.std)
        }
    )
    total = sum((F.col(z) * F.col(z) for z in z_names[1:]), F.col(z_names[0]) * F.col(z_names[0]))
    code_names = [f"c{j}__" for j in range(len(model.basis[0]))]
    coded = scaled.withColumns(
        {
            c: sum((F.col(z) * row[j] for z, row in zip(z_names, model.basis)), F.lit(0.0))
            for j, c in enumerate(code_names)
        }
    )
    explained = sum((F.col(c) * F.col(c) for c in code_names), F.lit(0.0))
    error = F.greatest(total - explained, F.lit(0.0)) / len(z_names)
    return coded.withColumn(out, error).drop(*z_names, *code_names)


def error_by_class(df: DataFrame, error: str = "recon_error") -> DataFrame:
    """Mean reconstruction error by split and class, with the fraud:legit ratio of the split."""
    fraud, legit = F.col("fraud_error"), F.col("legit_error")
    return (
        df.groupBy("split")
        .agg(
            F.avg(F.when(F.col(LABEL) == 1, F.col(error))).alias("fraud_error"),
            F.avg(F.when(F.col(LABEL) == 0, F.col(error))).alias("legit_error"),
        )
        .withColumn("fraud_to_legit", F.when(legit > 0, fraud / legit))
    )


def train_ensemble(train: DataFrame, pos_weight: float, **settings) -> PipelineModel:
    """Boosted trees on the features plus the reconstruction error."""
    return train_gbt(train, pos_weight, features=[*FEATURES, "recon_error"], **settings)
