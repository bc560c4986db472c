"""Ranks, quantiles and running totals against sorting everything in one place."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskengine.operators import ordered as o


def values_with_hot_key(n=3000, seed=1):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=n)
    v[: n // 3] = 0.25  # one value holds a third of all rows
    v[-1] = -0.0
    return rng.permutation(v)


@pytest.fixture(scope="module")
def hot(spark):
    v = values_with_hot_key()
    return v, spark.createDataFrame(pd.DataFrame({"txn_id": np.arange(len(v)), "x": v, "y": np.round(v, 1)}))


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_match_a_global_window(hot, descending):
    v, df = hot
    edges = o.find_edges(df, ["x"], 8)
    groups = (
        o.bucketed(df.select("x"), edges)
        .withColumnRenamed("x__b", "bucket")
        .groupBy("bucket", "x")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    got = o.running_totals(groups, [], "x", ["n"], descending, next_value=True).toPandas()
    want = pd.Series(v).value_counts().sort_index(ascending=not descending)
    got = got.sort_values("x", ascending=not descending)
    assert list(got["x"]) == list(want.index)
    assert list(got["n_cum"]) == list(want.cumsum())
    assert set(got["n_all"]) == {len(v)}
    assert list(got["next_value"])[:-1] == list(want.index)[1:]
    assert math.isnan(list(got["next_value"])[-1])


def test_running_totals_by_key_keep_keys_apart(spark):
    df = spark.createDataFrame([("a", 1.0, 2), ("a", 2.0, 3), ("b", 1.0, 5)], "k string, v double, n long")
    got = o.running_totals(df.withColumn("bucket", F.col("v").cast("int")), ["k"], "v", ["n"])
    assert {(r["k"], r["v"]): (r["n_cum"], r["n_all"]) for r in got.collect()} == {
        ("a", 1.0): (2, 5), ("a", 2.0): (5, 5), ("b", 1.0): (5, 5),
    }


@pytest.mark.parametrize("hot_rows", [10, 10_000])
def test_running_max_and_count_split_hot_keys(spark, hot_rows):
    rng = np.random.default_rng(3)
    keys = ["hot"] * 400 + [f"k{i % 50}" for i in range(400)]
    frame = pd.DataFrame({"k": keys, "i": rng.permutation(800), "s": rng.normal(size=800)})
    df, split = o.hot_key_buckets(spark.createDataFrame(frame), ["k"], "i", hot_rows, n_buckets=8)
    assert split == (hot_rows == 10)
    best = o.running_max(df, ["k"], "i", F.col("s"), "best", split)
    got = o.running_count(best, ["k"], "i", "nth", split).toPandas().sort_values(["k", "i"])
    want = frame.sort_values(["k", "i"])
    shifted = want.groupby("k")["s"].cummax().groupby(want["k"]).shift()
    assert np.array_equal(got["best"].to_numpy(), shifted.to_numpy(), equal_nan=True)
    assert list(got["nth"]) == list(want.groupby("k").cumcount() + 1)


def test_no_row_level_single_partition_exchange(hot):
    """Only tables of bucket totals may be ordered in one task."""
    _, df = hot
    edges = o.find_edges(df, ["x"], 8)
    groups = (
        o.bucketed(df.select("x"), edges)
        .withColumnRenamed("x__b", "bucket")
        .groupBy("bucket", "x")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    plan = o.running_totals(groups, ["bucket"], "x", ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_more_rows_mean_more_buckets(spark):
    assert o.bucket_number(spark, 0) == 16
    assert o.bucket_number(spark, 10**10) == 1000
    assert o.bucket_number(spark, 10**13) == o.MAX_BUCKETS
