import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskengine.functions.kstest import ks_pvalue
from riskengine.operators import drift as d
from riskengine.plans.retraining import check_drift, decide_branch
from riskengine.schema import FEATURES


def features(spark, n, seed, shift=None):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame({"txn_id": np.arange(n), "Time": np.arange(n, dtype=float)})
    for f in FEATURES:
        frame[f] = np.round(rng.normal(size=n) + (shift or {}).get(f, 0.0), 2)
    return frame, spark.createDataFrame(frame)


def brute(a, b):
    xs = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), xs, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), xs, side="right") / len(b)
    gap = abs(fa - fb)
    return gap.max(), (gap[:-1] * np.diff(xs)).sum()


@pytest.fixture(scope="module")
def pair(spark):
    return features(spark, 500, 42), features(spark, 400, 999)


def test_distances_match_brute_force(pair):
    (a, ref), (b, cur) = pair
    got = {r["feature"]: r for r in d.distances(d.both_sides(ref, cur)).collect()}
    assert set(got) == set(FEATURES)
    for f in ("V1", "V14", "log_amount"):
        ks, w = brute(a[f].to_numpy(), b[f].to_numpy())
        assert got[f]["ks"] == pytest.approx(ks, abs=1e-12)
        assert got[f]["wasserstein"] == pytest.approx(w, abs=1e-12)
        assert (got[f]["n_ref"], got[f]["n_cur"]) == (500, 400)


def test_a_hot_value_is_counted_whole(spark, pair):
    """A third of all rows share one value on both sides; others share smaller ones."""
    (a, _), (b, _) = pair
    a, b = a.copy(), b.copy()
    a.loc[: len(a) // 3, "V1"] = 0.5
    b.loc[: len(b) // 3, "V1"] = 0.5
    got = d.distances(d.both_sides(spark.createDataFrame(a), spark.createDataFrame(b)), cols=["V1"]).first()
    ks, w = brute(a["V1"].to_numpy(), b["V1"].to_numpy())
    assert got["ks"] == pytest.approx(ks, abs=1e-12) and got["wasserstein"] == pytest.approx(w, abs=1e-12)
    assert (got["feature"], got["n_ref"], got["n_cur"]) == ("V1", 500, 400)


def test_a_table_does_not_drift_from_itself(pair):
    (_, ref), _ = pair
    rows = d.with_pvalue(d.distances(d.both_sides(ref, ref))).collect()
    assert all(r["ks"] == 0 and r["wasserstein"] == 0 and r["p_value"] == 1.0 for r in rows)


def test_moments_are_population_moments(pair):
    (a, ref), (b, cur) = pair
    r = d.moments(d.both_sides(ref, cur)).where("feature = 'V3'").first()
    assert r["ref_std"] == pytest.approx(np.std(a["V3"])) and r["cur_mean"] == pytest.approx(b["V3"].mean())


@pytest.mark.parametrize("lam,p", [(0.2, 1.0), (0.8276, 0.5), (1.2238, 0.1), (1.3581, 0.05), (1.6276, 0.01)])
def test_pvalue_known_points(spark, lam, p):
    # With n = m = 2 the argument is the distance itself.
    row = spark.createDataFrame([(lam,)], "ks double").select(ks_pvalue(F.col("ks"), F.lit(2), F.lit(2)).alias("p")).first()
    assert row["p"] == pytest.approx(p, abs=2e-4)


def test_same_distribution_is_not_drift(pair):
    (_, ref), (_, cur) = pair
    r = d.drift_decision(d.drift_report(d.both_sides(ref, cur))).first()
    assert not r["drift_detected"] and r["total_features_count"] == 30


def test_synthetic_drift_is_detected(pair):
    (_, ref), (_, cur) = pair
    r = d.drift_decision(d.drift_report(d.both_sides(ref, d.synthetic_drift(cur)))).first()
    assert r["drift_detected"] and r["drift_by_key_features"]
    assert r["key_features_drifted"] == ["V17", "V14", "V12", "V10", "V16"]
    assert "log_amount" in r["drifted_features"]


def test_decision_rules(spark):
    def decide(moved):
        rows = [(f, f in moved) for f in FEATURES]
        return d.drift_decision(spark.createDataFrame(rows, "feature string, drifted boolean")).first()

    assert not decide([])["drift_detected"]
    assert not decide(["V17"])["drift_detected"]
    assert decide(["V17", "V16"])["drift_by_key_features"]
    assert not decide(["V1", "V2", "V3", "V4", "V5"])["drift_detected"]
    six = decide(["V6", "V5", "V4", "V3", "V2", "V1"])
    assert six["drift_by_share"] and six["drifted_features"] == ["V1", "V2", "V3", "V4", "V5", "V6"]


def test_synthetic_drift_shifts_by_the_mean(pair):
    _, (b, cur) = pair
    out = d.synthetic_drift(cur, amount_log_shift=3.0, v_mean_shift=2.0, features=["V1"]).toPandas().sort_values("txn_id")
    assert np.allclose(out["log_amount"], b["log_amount"] + 3.0)
    noise = out["V1"].to_numpy() - b["V1"].to_numpy()
    assert noise.mean() == pytest.approx(2.0, abs=0.2) and noise.std() == pytest.approx(1.0, abs=0.15)
    assert np.array_equal(out["V17"], b["V17"])


def test_missing_features_are_reported(pair):
    (_, ref), (_, cur) = pair
    with pytest.raises(ValueError, match="V5"):
        d.distances(d.both_sides(ref, cur.drop("V5")))


def test_reference_sample(pair):
    (_, ref), _ = pair
    # By default the training share, whatever the length of the table.
    assert {r["txn_id"] for r in d.reference_sample(ref).collect()} == set(range(400))
    assert {r["txn_id"] for r in d.reference_sample(ref, reference_rows=300).collect()} == set(range(300))
    assert d.reference_sample(ref, reference_rows=300, sample_size=50).where("txn_id < 300").count() == 50
    assert d.reference_sample(ref, split_only=False, reference_rows=300).count() == 500


def test_each_window_equals_its_own_comparison(pair):
    (_, ref), (b, cur) = pair
    daily = cur.withColumn("window_start", F.when(F.col("txn_id") < 150, F.lit("a")).otherwise("b"))
    got = d.drift_by_window(ref, daily).where("window_start = 'a'").orderBy("feature").collect()
    want = d.drift_report(d.both_sides(ref, cur.where("txn_id < 150"))).orderBy("feature").collect()
    for g, w in zip(got, want):
        assert g["ks"] == w["ks"] and g["n_cur"] == 150 and g["p_value"] == w["p_value"]
        assert math.isclose(g["wasserstein"], w["wasserstein"])


def test_windows_match_brute_force(spark):
    """Hot values, windows that lie aside of the reference, and missing values."""
    rng = np.random.default_rng(8)
    a = np.round(rng.normal(size=900), 3)
    a[:300] = 0.25
    b = {"w1": rng.normal(1, 2, 300), "w2": np.full(4, 0.25), "w3": np.array([-9.0, -8.5]), "w4": np.r_[7.5, 9.0], "w5": a[250:500]}
    ref = spark.createDataFrame(pd.DataFrame({"V1": a}))
    rows = pd.concat([pd.DataFrame({"day": w, "V1": v}) for w, v in b.items()] + [pd.DataFrame({"day": "w6", "V1": [np.nan]})])
    got = {r["day"]: r for r in d.window_distances(ref, spark.createDataFrame(rows), "day", ["V1"]).collect()}
    assert set(got) >= set(b)
    for w, v in b.items():
        ks, area = brute(a, v)
        assert got[w]["ks"] == pytest.approx(ks, abs=1e-12) and got[w]["wasserstein"] == pytest.approx(area, abs=1e-9)
        assert (got[w]["n_ref"], got[w]["n_cur"]) == (900, len(v))


def test_branching():
    assert decide_branch(True) == decide_branch(False, True) == "retrain_model_task"
    assert decide_branch(False) == "skip_retrain_task"


def test_check_drift(pair):
    (_, ref), (_, cur) = pair
    assert check_drift(ref, d.synthetic_drift(cur)).first()["drift_detected"]
