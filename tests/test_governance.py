import numpy as np
import pandas as pd
import pytest

from riskengine.operators import governance as g
from riskengine.operators.ordered import hot_key_buckets
from riskengine.plans.retraining import run_retraining


def fold(frame, margin=1e-4):
    out = {}
    for name, part in frame.sort_values(["model_name", "version"]).groupby("model_name"):
        serving = None
        for r in part.itertuples():
            if serving is None:
                out[name, r.version] = ("promoted", "initial_deployment", None)
                serving = r
            elif r.auc_pr > serving.auc_pr + margin:
                out[name, r.version] = ("promoted", "strictly_superior", serving.version)
                serving = r
            else:
                out[name, r.version] = ("rejected", "not_strictly_superior", serving.version)
    return out


@pytest.mark.parametrize("candidate,action", [(0.8125, "promoted"), (0.75, "rejected"), (0.799586, "rejected"), (0.799586 + 3e-16, "rejected"), (0.799586 + 5e-5, "rejected")])
def test_gate_truth_table(spark, candidate, action):
    runs = spark.createDataFrame([("m", 1, 0.799586), ("m", 2, candidate)], "model_name string, version long, auc_pr double")
    first, second = g.promotion_gate(runs).orderBy("version").collect()
    assert (first["action"], first["reason"], first["previous_version"]) == ("promoted", "initial_deployment", None)
    assert (second["action"], second["previous_version"], second["previous_auc_pr"]) == (action, 1, 0.799586)


def test_missing_metric_falls_back_to_tag_then_zero(spark):
    rows = [("m", 1, None, 0.7), ("m", 2, 0.69, None), ("n", 1, None, None), ("n", 2, 0.1, None)]
    runs = spark.createDataFrame(rows, "model_name string, version long, auc_pr double, tag_auc_pr double")
    got = {(r["model_name"], r["version"]): r["action"] for r in g.promotion_gate(runs).collect()}
    assert got == {("m", 1): "promoted", ("m", 2): "rejected", ("n", 1): "promoted", ("n", 2): "promoted"}


@pytest.mark.parametrize("hot_rows", [20, 10**6])
def test_gate_equals_a_sequential_walk(spark, hot_rows):
    rng = np.random.default_rng(2)
    names = ["hot"] * 500 + [f"m{i % 60}" for i in range(600)]
    score = rng.random(1100)
    score[:500] = np.linspace(0.5, 0.52, 500)  # steps below the margin
    frame = pd.DataFrame({"model_name": names, "version": rng.permutation(1100), "auc_pr": score})
    frame.loc[:499, "version"] = np.arange(500)
    decided = g.promotion_gate(spark.createDataFrame(frame), hot_rows=hot_rows)
    got = {(r["model_name"], r["version"]): (r["action"], r["reason"], r["previous_version"]) for r in decided.collect()}
    assert got == fold(frame)
    stages = g.registry_stages(decided).toPandas()
    assert (stages[stages["stage"] == "Production"].groupby("model_name").size() == 1).all()
    assert stages["model_name"].nunique() == (stages["stage"] == "Production").sum()


def test_gate_jumps_over_records_below_the_margin_across_batches(spark):
    """A strictly improving model, read in small batches next to others."""
    rising = np.cumsum(np.random.default_rng(4).random(3000) * 8e-5)
    frame = pd.DataFrame({"model_name": "m1", "version": np.arange(3000), "auc_pr": rising})
    other = pd.DataFrame({"model_name": [f"m{i % 7}x" for i in range(70)], "version": np.arange(70), "auc_pr": rising[:70]})
    frame = pd.concat([frame, other], ignore_index=True)
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = {(r["model_name"], r["version"]): (r["action"], r["reason"], r["previous_version"]) for r in g.promotion_gate(spark.createDataFrame(frame)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    assert got == fold(frame)


def test_one_hot_model_among_many_small_ones_is_spread_evenly(spark):
    small = spark.range(200_000).selectExpr("concat('m', id % 20000) AS model_name", "id div 20000 AS version")
    hot = spark.range(4000).selectExpr("'hot' AS model_name", "id + 1000000 AS version")
    parts, split = hot_key_buckets(small.unionByName(hot), ["model_name"], "version", 1000, n_buckets=16)
    sizes = [r["count"] for r in parts.where("model_name = 'hot'").groupBy("bucket").count().collect()]
    assert split and sum(sizes) == 4000 and max(sizes) <= 2 * 4000 / 16


@pytest.mark.parametrize("hot_rows", [3, 10**6])
def test_registration_is_idempotent(spark, hot_rows):
    empty = spark.createDataFrame([], "model_name string, run_id long, version long")
    runs = spark.createDataFrame([("m", 5, 0.1), ("m", 3, 0.2), ("n", 1, 0.3), ("m", 9, 0.4), ("m", 7, 0.4)], "model_name string, run_id long, auc_pr double")
    first = g.register_versions(runs, empty, hot_rows)
    got = {(r["model_name"], r["run_id"]): (r["version"], r["stage"], r["tag_auc_pr"]) for r in first.collect()}
    assert got == {("m", 3): (1, "Staging", 0.2), ("m", 5): (2, "Staging", 0.1), ("m", 7): (3, "Staging", 0.4), ("m", 9): (4, "Staging", 0.4), ("n", 1): (1, "Staging", 0.3)}
    assert g.register_versions(runs, first, hot_rows).count() == 0
    more = runs.union(spark.createDataFrame([("m", 2, 0.9), ("m", 2, 0.9)], runs.schema))
    assert [(r["run_id"], r["version"]) for r in g.register_versions(more, first, hot_rows).collect()] == [(2, 5)]


def test_retrain_decision_follows_drift_and_schedule(spark):
    rows = [("2024-01-07", False), ("2024-01-08", False), ("2024-01-09", True)]
    df = spark.createDataFrame(rows, "d string, drift_detected boolean").selectExpr("to_date(d) AS window_start", "drift_detected")
    got = [(r["is_scheduled"], r["branch"]) for r in g.retrain_decision(df).orderBy("window_start").collect()]
    assert got == [(True, "retrain_model_task"), (False, "skip_retrain_task"), (False, "retrain_model_task")]


def test_retraining_run(spark):
    from test_drift import features
    from riskengine.operators.drift import synthetic_drift

    _, ref = features(spark, 400, 1)
    _, cur = features(spark, 300, 2)
    registry = spark.createDataFrame([("m", 1, 1, 0.8)], "model_name string, run_id long, version long, auc_pr double")
    calls = []

    def retrain():
        calls.append(1)
        return "m", 2, 0.9

    quiet = run_retraining(ref, cur, registry, retrain, "m")
    assert quiet.branch == "skip_retrain_task" and not calls and quiet.verdict is None
    loud = run_retraining(ref, synthetic_drift(cur), registry, retrain, "m")
    assert loud.branch == "retrain_model_task" and calls == [1]
    verdict = loud.verdict.first()
    assert (verdict["version"], verdict["action"], verdict["previous_version"]) == (2, "promoted", 1)
