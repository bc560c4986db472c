"""Exploratory report: every profile table of a dataset, saved as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskengine.operators.costs import (
    CostMatrix,
    cost_calibration,
    cost_scenario,
    imbalance,
    naive_baseline,
)
from riskengine.operators.profile import (
    amount_outliers,
    class_comparison,
    column_summary,
    dataset_summary,
    statistical_profile,
)
from riskengine.operators.split import top_effects
from riskengine.session import materialize
from riskengine.sources.files import save_json


def run_eda(df: DataFrame, folder: str | None = None) -> dict[str, DataFrame]:
    """All tables of the report by name; each is one JSON folder when `folder` is given."""
    df = materialize(df, "eda")
    costs = CostMatrix().calibrate(df)
    effects = class_comparison(df)
    tables = {
        "summary": dataset_summary(df),
        "columns": column_summary(df),
        "profile": statistical_profile(df),
        "effects": effects,
        "top_effects": top_effects(effects, 10),
        "weakest_effects": top_effects(effects, 5, weakest=True),
        "amount_outliers": amount_outliers(df),
        "cost_matrix": cost_calibration(df),
        "cost_scenario": cost_scenario(df, costs),
        "imbalance": imbalance(df),
        "naive_baseline": naive_baseline(df),
    }
    if folder:
        for name, table in tables.items():
            save_json(table, f"{folder}/{name}")
    return tables
