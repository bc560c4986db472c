"""Training-data pipeline: each stage applies one corpus operator to what the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskengine.llm import decontaminate, mixing, neardup, pii, quality
from riskengine.llm.common import table
from riskengine.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs.select(COLUMNS), table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.keep_one_of_each(docs.select(COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.drop_contaminated(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by placeholders; n_chars stays the original length."""
    return pii.redact(docs.select(COLUMNS))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their places in the mix of sources; read them by slot, then in_block."""
    return mixing.pfair_mix(docs.select(COLUMNS))


STAGES = [
    ("quality classifier", quality_stage),
    ("minhash near-dedup", dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
]

# The classifier and the boosted trees have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(COLUMNS)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{k}")
    return docs
