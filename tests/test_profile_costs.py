import math

import pytest
from pyspark.sql import functions as F

from riskengine.operators import costs as c
from riskengine.operators import profile as p
from riskengine.schema import RAW_COLUMNS


def classes(spark, legit, fraud):
    return spark.range(legit + fraud).select((F.col("id") >= legit).cast("int").alias("Class"))


def test_imbalance_known_answers(spark):
    r = c.imbalance(classes(spark, 1000, 5)).first()
    assert (r["n_fraud"], r["n_legit"], r["n_total"]) == (5, 1000, 1005)
    assert r["imbalance_ratio"] == r["scale_pos_weight"] == 200.0
    assert r["fraud_rate_pct"] == pytest.approx(5 / 1005 * 100)


def test_imbalance_without_fraud_and_without_rows(spark):
    r = c.imbalance(classes(spark, 10, 0)).first()
    assert r["imbalance_ratio"] == math.inf and r["scale_pos_weight"] == 1.0 and r["fraud_rate"] == 0.0
    assert c.imbalance(classes(spark, 0, 0)).first()["fraud_rate"] is None


def test_naive_baseline(spark):
    r = c.naive_baseline(classes(spark, 1000, 5)).first()
    assert r["accuracy"] == pytest.approx(1000 / 1005) and (r["n_correct"], r["n_wrong"]) == (1000, 5)


def test_scale_pos_weight_needs_fraud(spark):
    assert c.scale_pos_weight(classes(spark, 1000, 5)) == 200.0
    with pytest.raises(ValueError, match="no fraud"):
        c.scale_pos_weight(classes(spark, 10, 0))


def test_cost_matrix(txn, frame):
    m = c.CostMatrix()
    assert m.fn_cost is None and m.fp_cost == 10.0
    with pytest.raises(ValueError):
        m.columns()
    m = m.calibrate(txn)
    mean = frame.loc[frame["Class"] == 1, "Amount"].mean()
    assert m.fn_cost == m.avg_fraud_amount == pytest.approx(mean)
    assert c.cost_calibration(txn).first()["cost_ratio"] == pytest.approx(mean / 10)
    assert c.cost_calibration(txn, c.CostMatrix(fp_cost=0.0)).first()["cost_ratio"] is None


def test_expected_cost_identities(spark):
    rows = spark.createDataFrame([(61, 47, 14, 56840), (0, 0, 0, 0)], "tp long, fp long, fn long, tn long")
    a, b = c.expected_cost(rows, c.CostMatrix(fn_cost=122.0, tp_cost=1.0, tn_cost=0.5)).collect()
    assert a["total_cost"] == 61 * 1.0 + 47 * 10 + 14 * 122 + 56840 * 0.5
    assert (a["fn_cost"], a["fp_cost"]) == (14 * 122, 470)
    assert b["total_cost"] == 0


def test_cost_scenario_truncates(spark):
    df = classes(spark, 284315, 492)
    r = c.cost_scenario(df, c.CostMatrix(fn_cost=122.21132113821139)).first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (393, 5686, 99, 278629)
    assert r["total_cost"] == pytest.approx(68958.92079268293)


def test_summary_counts(txn):
    r = p.dataset_summary(txn).first()
    assert (r["n_rows"], r["n_cols"], r["n_fraud"], r["n_legit"], r["n_missing"]) == (200, 31, 12, 188, 0)
    cols = p.column_summary(txn).orderBy("position").collect()
    assert [x["feature"] for x in cols] == [*RAW_COLUMNS, "Class"]
    assert {x["dtype"] for x in cols} == {"double", "int"}


def test_profile_matches_pandas(txn, frame):
    got = p.statistical_profile(txn).toPandas().set_index("feature")
    assert set(got.index) == set(RAW_COLUMNS)
    for col in ("Time", "Amount", "V14"):
        v, r = frame[col], got.loc[col]
        assert r["mean"] == pytest.approx(v.mean()) and r["std"] == pytest.approx(v.std())
        assert r["skewness"] == pytest.approx(v.skew()) and r["kurtosis"] == pytest.approx(v.kurtosis())
        assert (r["min"], r["max"]) == (v.min(), v.max())
        for tag, q in p.PROFILE_QUANTILES.items():
            assert r[tag] == pytest.approx(v.quantile(q))


def test_profile_of_short_and_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 5.0), (1.0, 9.0)], "x double, y double")
    r = {x["feature"]: x for x in p.statistical_profile(df, ["x", "y"]).collect()}
    assert r["x"]["skewness"] == 0.0 and r["x"]["kurtosis"] is None
    assert r["y"]["skewness"] == pytest.approx(0.423, abs=0.001) and r["y"]["kurtosis"] is None
    assert r["x"]["std"] == 0.0


def test_class_comparison_matches_pandas(txn, frame):
    got = p.class_comparison(txn).toPandas().set_index("feature")
    f, l = frame[frame["Class"] == 1], frame[frame["Class"] == 0]
    for col in ("Amount", "V17"):
        r = got.loc[col]
        assert r["mean_diff"] == pytest.approx(f[col].mean() - l[col].mean())
        assert r["effect_size"] == pytest.approx((f[col].mean() - l[col].mean()) / l[col].std())


def test_effect_size_is_undefined_without_spread(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 0), (3.0, 1), (5.0, 1)], "x double, Class int")
    assert math.isnan(p.class_comparison(df, ["x"]).first()["effect_size"])


def test_class_profiles(txn, frame):
    fraud, legit = p.class_profiles(txn, ["Amount"])
    assert fraud.first()["mean"] == pytest.approx(frame.loc[frame["Class"] == 1, "Amount"].mean())
    assert legit.first()["median"] == pytest.approx(frame.loc[frame["Class"] == 0, "Amount"].median())


def test_amount_outliers_match_pandas(txn, frame):
    r = p.amount_outliers(txn).first()
    a = frame["Amount"]
    q1, q3 = a.quantile(0.25), a.quantile(0.75)
    upper = q3 + 1.5 * (q3 - q1)
    assert r["upper_fence"] == pytest.approx(upper) and r["p999"] == pytest.approx(a.quantile(0.999))
    assert r["n_outlier_iqr"] == (a > upper).sum() and r["n_extreme_p99"] == (a > a.quantile(0.99)).sum()
    assert r["fraud_rate_normal"] == pytest.approx(frame.loc[~(a > upper), "Class"].mean())
    assert r["fraud_amount_median"] == pytest.approx(a[frame["Class"] == 1].median())
    assert r["legit_amount_std"] == pytest.approx(a[frame["Class"] == 0].std())


def test_amount_outliers_without_outliers(spark):
    df = spark.createDataFrame([(5.0, 0)] * 8, "Amount double, Class int")
    r = p.amount_outliers(df).first()
    assert r["n_outlier_iqr"] == 0 and r["fraud_rate_outlier_iqr"] == 0.0 and r["fraud_amount_mean"] is None
