"""Quantiles by group against numpy, with hot values, small groups, many pieces and a sketch that is off."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskengine.operators import profile as p
from riskengine.operators import summaries as s

PROBS = {"a": 0.01, "b": 0.5, "c": 0.777, "d": 1.0, "e": 0.0, "f": 0.999}


@pytest.fixture(scope="module")
def hot(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=9000)
    v[:3000] = 0.25  # one value holds a third of all rows
    v[-1] = -0.0
    v = rng.permutation(v)
    frame = pd.DataFrame({"x": v, "y": np.round(v, 1), "k": rng.choice(["u", "v", "w"], 9000, p=[0.5, 0.497, 0.003])})
    return frame, spark.createDataFrame(frame).cache()


def check(frame, rows, by=None):
    for r in rows:
        col = frame[r["feature"]] if by is None else frame.loc[frame[by] == r[by], r["feature"]]
        for tag, q in PROBS.items():
            assert r[tag] == pytest.approx(np.percentile(col, q * 100), abs=1e-12)


@pytest.mark.parametrize("reach", [0.0005, 0.02])
def test_quantiles_interpolate_like_numpy(hot, monkeypatch, reach):
    """Both kept whole and in brackets."""
    monkeypatch.setattr(s, "REACH", reach)
    frame, df = hot
    rows = s.exact_quantiles(df, ["x", "y"], PROBS).collect()
    assert len(rows) == 2
    check(frame, rows)


def test_quantiles_by_group(hot):
    frame, df = hot
    rows = s.summarize(df, ["x", "y"], PROBS, ["k"], {"top": F.max("value")}).collect()
    assert len(rows) == 6 and {r["k"]: r["n"] for r in rows} == frame["k"].value_counts().to_dict()
    check(frame, rows, "k")
    assert all(r["top"] == frame.loc[frame["k"] == r["k"], r["feature"]].max() for r in rows)


def test_brackets_of_many_pieces_keep_little(hot, monkeypatch):
    monkeypatch.setattr(s, "REACH", 0.01)
    monkeypatch.setattr(s, "PIECE_ROWS", 20)
    kept = []
    monkeypatch.setattr(s, "materialize", lambda df, tag: kept.append(df.cache()) or kept[-1])
    frame, df = hot
    check(frame, s.exact_quantiles(df, ["x"], PROBS).collect())
    assert len(kept) == 1 and kept[0].where("value is not null").count() < 0.13 * 6000
    assert kept[0].select("piece").distinct().count() > 3


def test_a_wrong_sketch_only_costs_a_pass(hot, monkeypatch):
    frame, df = hot
    monkeypatch.setattr(s, "REACH", 0.01)
    right = s._Column.bracket

    def off(c, points):
        c.around = [(points[2], points[3])]
        right(c, points)

    monkeypatch.setattr(s._Column, "bracket", off)
    check(frame, s.exact_quantiles(df, ["x", "y"], PROBS).collect())


def test_missing_values_constant_columns_and_no_rows(spark):
    rows = [(1.0, 5.0, None), (None, 5.0, None), (float("nan"), 5.0, None), (3.0, 5.0, None), (float("inf"), 5.0, None)]
    df = spark.createDataFrame(rows, "x double, y double, z double")
    got = {r["feature"]: (r["m"], r["hi"]) for r in s.exact_quantiles(df, ["x", "y", "z"], {"m": 0.5, "hi": 1.0}).collect()}
    assert got == {"x": (3.0, float("inf")), "y": (5.0, 5.0)}
    assert s.exact_quantiles(df.limit(0), ["x"], {"m": 0.5}).collect() == []


def test_class_profiles_are_the_profiles_of_the_classes(txn):
    fraud, legit = p.class_profiles(txn, ["V1", "Amount"])
    for got, y in ((fraud, 1), (legit, 0)):
        want = p.statistical_profile(txn.where(F.col("Class") == y), ["V1", "Amount"])
        pairs = list(zip(sorted(map(tuple, got.collect())), sorted(map(tuple, want.collect()))))
        assert len(pairs) == 2 and all(a[0] == b[0] and a[1:] == pytest.approx(b[1:], abs=1e-12) for a, b in pairs)


def test_profiles_take_few_jobs(spark, txn):
    spark.sparkContext.setJobGroup("profiles", "profiles")
    for side in p.class_profiles(txn):
        assert side.count() == 30
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("profiles")) <= 24
