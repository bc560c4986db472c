"""Curves, thresholds, slices and the bootstrap against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskengine.functions import resampling as rs
from riskengine.operators import bootstrap as b
from riskengine.operators import curves as cv
from riskengine.operators import slices as sl
from riskengine.operators.costs import CostMatrix

COSTS = CostMatrix(fn_cost=122.21)


def average_precision(y, p, w=None):
    w = np.ones(len(y)) if w is None else w
    total, area, tp, n = (w * y).sum(), 0.0, 0.0, 0.0
    for s in sorted(set(p), reverse=True):
        at = p == s
        tp, n = tp + (w * y)[at].sum(), n + w[at].sum()
        area += (w * y)[at].sum() * tp / n
    return area / total


def roc_area(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return np.mean([(a > neg).mean() + 0.5 * (a == neg).mean() for a in pos])


@pytest.fixture(scope="module")
def scores():
    rng = np.random.default_rng(5)
    n = 600
    y = (rng.random(n) < 0.15).astype(int)
    p = np.clip(np.round(rng.normal(0.4 + 0.15 * y, 0.2), 2), 0, 1)
    p[: n // 3] = 0.31  # a hot score
    q = np.clip(np.round(rng.normal(0.4 + 0.05 * y, 0.2), 3), 0, 1)
    return pd.DataFrame({"txn_id": np.arange(n), "Class": y.astype("int32"), "p": p, "p_b": q, "Amount": rng.exponential(90, n)})


@pytest.fixture(scope="module")
def scored(spark, scores):
    return spark.createDataFrame(scores).cache()


def test_areas_match_brute_force(scored, scores):
    r = cv.compute_metrics(scored).first()
    y, p = scores["Class"].to_numpy(), scores["p"].to_numpy()
    assert r["auc_pr"] == pytest.approx(average_precision(y, p), abs=1e-12)
    assert r["auc_roc"] == pytest.approx(roc_area(y, p), abs=1e-12)


def test_perfect_and_one_class_scores(spark):
    perfect = spark.createDataFrame([(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)], "Class int, p double")
    r = cv.compute_metrics(perfect).first()
    assert (r["auc_pr"], r["auc_roc"]) == (1.0, 1.0)
    r = cv.compute_metrics(perfect.withColumn("Class", F.lit(0))).first()
    assert r["auc_pr"] == 0.0 and r["auc_roc"] is None


def brute_sweep(scores, n=1000):
    y, p = scores["Class"].to_numpy(), scores["p"].to_numpy()
    out = []
    for i in range(n + 1):
        t = i * (1.0 / n)
        hit = p >= t
        out.append((t, (hit & (y == 1)).sum(), (hit & (y == 0)).sum(), (~hit & (y == 1)).sum(), (~hit & (y == 0)).sum()))
    return out


@pytest.mark.parametrize("n", [1000, 7])
def test_sweep_matches_brute_force(scored, scores, n):
    got = cv.threshold_sweep(scored, COSTS, n_thresholds=n).orderBy("i").collect()
    want = brute_sweep(scores, n)
    assert [(r["threshold"], r["tp"], r["fp"], r["fn"], r["tn"]) for r in got] == want
    assert got[3]["total_cost"] == pytest.approx(want[3][2] * 10 + want[3][3] * 122.21)


def test_sweep_takes_scores_on_and_outside_the_grid(spark):
    ps = [0.0, 1.0, 0.3, 0.1 + 0.2, 0.999, -0.5, 1.5, float("nan")]
    df = spark.createDataFrame([(1, p) for p in ps], "Class int, p double")
    for r in cv.threshold_sweep(df, COSTS).collect():
        assert r["tp"] == sum(p >= r["threshold"] for p in ps)
        assert r["tp"] + r["fn"] == len(ps)


def test_optimal_threshold_is_the_first_cheapest(scored, scores):
    best = cv.optimal_threshold(cv.threshold_sweep(scored, COSTS)).first()
    costs = [fp * 10.0 + fn * 122.21 for _, _, fp, fn, _ in brute_sweep(scores)]
    i = int(np.argmin(costs))
    assert best["optimal_threshold"] == i * 0.001 and best["min_cost"] == pytest.approx(costs[i])
    assert best["cost_at_default"] == pytest.approx(costs[500])
    for t in (0.1, 0.5, 0.9):
        assert best["min_cost"] <= cv.confusion_at(scored, t, COSTS).first()["total_cost"]


def test_confusion_at_extremes(scored, scores):
    n, pos = len(scores), int(scores["Class"].sum())
    everything = cv.confusion_at(scored, 0.0, COSTS).first()
    assert (everything["tp"], everything["fn"], everything["recall"]) == (pos, 0, 1.0)
    nothing = cv.confusion_at(scored, 1.01, COSTS).first()
    assert (nothing["tp"], nothing["tn"], nothing["precision"], nothing["f1"]) == (0, n - pos, 0.0, 0.0)


def test_candidates_sum_to_all_rows(scored, scores):
    rows = cv.candidate_thresholds(scored, COSTS).collect()
    assert [r["threshold"] for r in rows] == list(cv.CANDIDATE_THRESHOLDS)
    for r in rows:
        assert r["tp"] + r["fp"] + r["fn"] + r["tn"] == len(scores)
        assert r["tp"] == ((scores["p"] >= r["threshold"]) & (scores["Class"] == 1)).sum()


def test_slices_cover_the_bands(scored, scores):
    rows = {r["band"]: r for r in sl.slice_by_amount(scored, 0.5).collect()}
    assert sum(r["n_total"] for r in rows.values()) == len(scores)
    inside = scores[(scores["Amount"] >= 10) & (scores["Amount"] < 50)]
    assert rows["$10-50"]["n_total"] == len(inside)
    assert rows["$10-50"]["tp"] == ((inside["p"] >= 0.5) & (inside["Class"] == 1)).sum()


def test_band_edges_are_half_open(spark):
    df = spark.createDataFrame([(a, 0, 0.9) for a in (-1.0, 0.0, 10.0, 49.99, 50.0, 1000.0)], "Amount double, Class int, p double")
    got = {r["band"]: r["n_total"] for r in sl.slice_by_amount(df, 0.5).collect()}
    assert got == {"$0-10": 1, "$10-50": 2, "$50-200": 1, "$1K+": 1}


def test_hour_slices_need_the_column(scored):
    assert sl.slice_by_hour(scored, 0.5) is None
    hourly = scored.withColumn("hour_of_day", F.pmod("txn_id", F.lit(24)).cast("double"))
    assert {r["band"]: r["n_total"] for r in sl.slice_by_hour(hourly, 0.5).collect()} == {
        "00:00-06:00": 150, "06:00-12:00": 150, "12:00-18:00": 150, "18:00-24:00": 150,
    }


def drawn_weights(pieces, n_bootstraps, seed=42, attempt=0):
    """Each rank's weight in each resample, from the published generator alone."""
    n = int(pieces["rows"].sum())
    reps, cdf = np.arange(n_bootstraps), np.array(rs.poisson_cdf(rs.mean_of(n)))
    w = rs.counts(rs.stream(seed, 0, attempt), cdf, reps, np.arange(n))
    for r in reps:
        k = np.arange(max(0, n - w[r].sum()))
        late = np.floor(rs.uniforms(rs.stream(seed, 1, attempt), np.array([r]), k)[0] * n).astype(int)
        np.add.at(w[r], late, 1)
    return w


def pieces_of(df):
    return b.ranked_pieces(b._cells(df, "p", "p_b", "Class"), 42).toPandas().sort_values("first").reset_index(drop=True)


def check_samples(df, n_bootstraps=8):
    pieces = pieces_of(df)
    starts = pieces["first"].to_numpy()
    assert starts[0] == 0 and (starts[1:] == (starts + pieces["rows"])[:-1]).all()
    w = np.add.reduceat(drawn_weights(pieces, n_bootstraps), starts, axis=1)
    assert (w.sum(1) == pieces["rows"].sum()).all()
    y = (pieces["y"] == 1).to_numpy().astype(float)
    samples = b.bootstrap_samples(df, n_bootstraps=n_bootstraps).orderBy("iteration").toPandas()
    for r in range(n_bootstraps):
        for col, out in (("a", "auc_pr_a"), ("b", "auc_pr_b")):
            held = (w[r] > 0) & pieces[col].notna().to_numpy()
            want = average_precision(y[held], pieces[col].to_numpy()[held], w[r][held])
            assert samples.loc[r, out] == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("continuous", [False, True])
def test_bootstrap_curves_follow_the_drawn_weights(spark, scored, scores, continuous):
    check_samples(spark.createDataFrame(scores.assign(p=np.random.default_rng(1).random(len(scores)))) if continuous else scored)


def test_bootstrap_of_hot_scores_and_missing_ones(spark, scores, monkeypatch):
    """A third of all rows share a score, some have none, and cells are longer than a piece."""
    monkeypatch.setattr(b, "HOT_ROWS", 40)
    monkeypatch.setattr(b, "PIECE_BITS", 4)
    monkeypatch.setattr(b, "CHUNK", 64)
    rng = np.random.default_rng(2)
    frame = scores.assign(p_b=np.round(rng.random(len(scores)), 2))
    frame.loc[frame.index % 3 == 0, "p"] = 0.5
    frame.loc[frame.index % 50 == 7, "p_b"] = np.nan
    check_samples(spark.createDataFrame(frame))


@pytest.mark.parametrize("n", [5, 30, 2_000, 50_000])
def test_weights_are_n_draws_with_replacement(n):
    w = drawn_weights(pd.DataFrame({"rows": [n]}), 200)
    assert (w.sum(1) == n).all()
    # Multinomial: mean 1, variance 1 - 1 / n, covariance -1 / n.
    assert w.var() == pytest.approx(1 - 1 / n, rel=0.05)
    assert (w == 0).mean() == pytest.approx((1 - 1 / n) ** n, rel=0.05)
    halves = w[:, : n // 2].sum(1)
    share = (n // 2) / n
    assert halves.var() == pytest.approx(n * share * (1 - share), rel=0.35)
    assert abs(np.corrcoef(w[0], w[1])[0, 1]) < 5 / np.sqrt(n) or n < 100


def test_samples_do_not_depend_on_partitions_or_size(spark, scored):
    """The same draws at 4 and 40 shuffle partitions, and however many resamples stand beside them."""
    base = np.array(sorted(b.bootstrap_samples(scored, n_bootstraps=6).collect()))
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        # Sums of doubles may differ in their last digit.
        again = np.array(sorted(b.bootstrap_samples(scored, n_bootstraps=9).collect()))
        assert np.allclose(again[:6], base, rtol=0, atol=1e-14)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_close_scores_are_different_cells(spark):
    rows = [(0.5, 0.5, 1), (0.5 + 2**-53, 0.5, 1), (2.0**-60, 0.5, 1), (2.0**-61, 0.5, 1), (-3.25, 0.5, 1)]
    cells = b._cells(spark.createDataFrame(rows, "p double, p_b double, Class int"), "p", "p_b", "Class")
    assert cells.select("cell").distinct().count() == 5


def test_identical_scores_tie_and_resamples_repeat(scored):
    same = b.bootstrap_samples(scored.withColumn("p_b", F.col("p")), n_bootstraps=5).collect()
    assert all(r["diff"] == 0.0 for r in same)
    s = b.bootstrap_summary(b.bootstrap_samples(scored.withColumn("p_b", F.col("p")), n_bootstraps=5)).first()
    assert s["prob_tie"] == 1.0 and not s["significant"]
    assert sorted(b.bootstrap_samples(scored, n_bootstraps=5).collect()) == sorted(b.bootstrap_samples(scored.repartition(5), n_bootstraps=5).collect())


def test_resamples_without_a_positive_are_redrawn(spark):
    rows = [(1, 0.9, 0.2)] + [(0, 0.1 * i, 0.05 * i) for i in range(4)]
    df = spark.createDataFrame(rows, "Class int, p double, p_b double")
    out = b.bootstrap_samples(df, n_bootstraps=40).collect()
    assert sorted(r["iteration"] for r in out) == list(range(1, 41))
    assert all(r["auc_pr_a"] == 1.0 for r in out)
    with pytest.raises(ValueError, match="no positive"):
        b.bootstrap_samples(df.withColumn("Class", F.lit(0)))


def test_summary_percentiles_and_choice(spark):
    diffs = np.linspace(0.01, 0.02, 41)
    df = spark.createDataFrame(pd.DataFrame({"iteration": range(41), "auc_pr_a": 0.8 + diffs, "auc_pr_b": 0.8 + 0 * diffs, "diff": diffs}))
    s = b.bootstrap_summary(df)
    r = s.first()
    assert r["diff_std"] == pytest.approx(np.std(diffs)) and r["diff_ci_lower"] == pytest.approx(np.percentile(diffs, 2.5))
    assert r["significant"] and r["prob_a_superior"] == 1.0
    assert b.model_choice(s).first()["chosen"] == "baseline"
    flip = df.withColumn("diff", -F.col("diff"))
    assert b.model_choice(b.bootstrap_summary(flip)).first()["chosen"] == "ensemble"
    mixed = df.withColumn("diff", F.col("diff") - 0.015)
    assert b.model_choice(b.bootstrap_summary(mixed)).first()["reason"] == "indistinguishable"
    table = b.bootstrap_percentiles(df).orderBy("percentile").collect()
    assert len(table) == 11 and table[5]["diff"] == pytest.approx(np.median(diffs))
