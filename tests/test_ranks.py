"""Cuts at ranks against sorting everything, with ties, missing values, hot values and bad brackets."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskengine.operators import ranks as r
from riskengine.operators import split as s

@pytest.fixture(scope="module")
def hot(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=300)
    v[:100] = 0.25  # one value holds a third of all rows
    v[-1] = -0.0
    v = rng.permutation(v)
    return v, spark.createDataFrame(pd.DataFrame({"txn_id": np.arange(len(v)), "x": v})).cache()


def taken(df, conds):
    """The ids for which each condition holds; a condition must never be null."""
    rows = df.select("txn_id", *[c.alias(f"c{i}") for i, c in enumerate(conds)]).collect()
    assert all(x is not None for row in rows for x in row)
    return [{row["txn_id"] for row in rows if row[f"c{i}"]} for i in range(len(conds))]


def first_of(v, ranks):
    order = sorted(range(len(v)), key=lambda i: (v[i], i))
    return [set(order[:rank]) for rank in ranks]


@pytest.mark.parametrize(
    "grid,select_rows,ranks",
    [(1000, 100_000, [0, 1, 70, 100, 150, 199, 201, 298, 299, 300, 500]), (1000, 5, [70, 215]), (4, 5, [70, 215])],
)
def test_all_ranks_at_once_take_exactly_the_first_rows(hot, monkeypatch, grid, select_rows, ranks):
    """Few points and few rows to order make the search go several rounds, into the hot value too."""
    monkeypatch.setattr(r, "GRID", grid)
    monkeypatch.setattr(r, "SELECT_ROWS", select_rows)
    v, df = hot
    assert taken(df, r.before_ranks(df, ranks, ("x", "txn_id"))) == first_of(v, ranks)


def test_a_wrong_sketch_only_costs_a_pass(hot, monkeypatch):
    v, df = hot

    def off(search, seen):
        search.lo, search.hi = (0.3, 0.4) if search.rank < 150 else (-0.4, -0.3)

    monkeypatch.setattr(r._Cutter, "bracket", staticmethod(off))
    ranks = [3, 290]
    assert taken(df, r.before_ranks(df, ranks, ("x", "txn_id"))) == first_of(v, ranks)


@pytest.mark.parametrize("select_rows", [0, 100])
def test_missing_values_come_last(spark, monkeypatch, select_rows):
    monkeypatch.setattr(r, "SELECT_ROWS", select_rows)
    rows = [(0, 2.0), (1, None), (2, 1.0), (3, float("nan")), (4, 2.0), (5, float("inf")), (6, -math.inf)]
    df = spark.createDataFrame(rows, "txn_id long, x double")
    got = taken(df, r.before_ranks(df, list(range(8)), ("x", "txn_id")))
    assert got == [set([6, 2, 0, 4, 5, 1, 3][:rank]) for rank in range(8)]


def test_large_integers_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(r, "SELECT_ROWS", 3)
    ids = [s * (2**60 + i) for i in range(50) for s in (1, -1)]
    df = spark.createDataFrame([(i, 1.0) for i in ids], "txn_id long, Time double")
    ranks = [1, 50, 73, 100]
    assert taken(df, r.before_ranks(df, ranks)) == [set(sorted(ids)[:rank]) for rank in ranks]


def test_rank_as_a_function_of_the_row_count(hot):
    _, df = hot
    assert df.where(r.before_rank(df, lambda n: int(n * 0.8), ("x", "txn_id"))).count() == 240


def test_empty_table_and_table_without_values(spark):
    empty = spark.createDataFrame([], "txn_id long, Time double")
    assert empty.where(r.before_rank(empty, 5)).count() == 0
    bare = spark.createDataFrame([(i, None) for i in range(9)], "txn_id long, Time double")
    assert taken(bare, [r.before_rank(bare, 4)]) == [{0, 1, 2, 3}]


def jobs_of(spark, work):
    spark.sparkContext.setJobGroup("counted", "counted")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    work()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before


def test_a_split_takes_few_jobs(spark, txn):
    assert jobs_of(spark, lambda: s.time_split(txn)) <= 6
    assert jobs_of(spark, lambda: s.replay_slice(txn, 20, 50)) <= 7
    assert jobs_of(spark, lambda: s.sample_n(txn, 50)) <= 4


@pytest.mark.parametrize("select_rows", [10, 100_000])
def test_sample_is_the_smallest_draws(spark, monkeypatch, select_rows):
    monkeypatch.setattr(s, "SELECT_ROWS", select_rows)
    df = spark.range(20_000).withColumnRenamed("id", "txn_id")
    draw = s.hash_int(42, F.col("txn_id"), digits=s.SAMPLE_HASH_DIGITS)
    want = [x["txn_id"] for x in df.orderBy(draw, "txn_id").limit(300).collect()]
    assert {x["txn_id"] for x in s.sample_n(df, 300).collect()} == set(want)
    assert s.sample_n(df, 0).count() == 0 and s.sample_n(df, 20_000).count() == 20_000


def test_sample_is_topped_up_when_the_bound_lets_too_few_through(spark, monkeypatch):
    df = spark.range(5_000).withColumnRenamed("id", "txn_id")
    want = {x["txn_id"] for x in s.sample_n(df, 900).collect()}
    monkeypatch.setattr(s.math, "isqrt", lambda n: -n // 10)
    assert {x["txn_id"] for x in s.sample_n(df, 900).collect()} == want and len(want) == 900
