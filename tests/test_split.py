import pytest
from pyspark.sql import functions as F

from riskengine.operators import split as s


def chronological(frame):
    return list(frame.sort_values(["Time", "txn_id"])["txn_id"])


def test_time_split_is_a_stable_cut(txn, frame):
    train, test = s.time_split(txn, 0.8)
    order = chronological(frame)
    assert {r[0] for r in train.select("txn_id").collect()} == set(order[:160])
    assert {r[0] for r in test.select("txn_id").collect()} == set(order[160:])


def test_fraction_is_truncated(txn):
    train, test = s.time_split(txn, 0.777)
    assert (train.count(), test.count()) == (155, 45)


def test_first_rows_keeps_a_shorter_table_whole(txn):
    head, tail = s.first_rows(txn, 227845)
    assert (head.count(), tail.count()) == (200, 0)


@pytest.mark.parametrize("start,limit", [(0, None), (0, 10), (30, 50), (190, 50), (300, 5)])
def test_replay_slice(txn, frame, start, limit):
    got = [r[0] for r in s.replay_slice(txn, start, limit).orderBy("Time", "txn_id").select("txn_id").collect()]
    end = None if limit is None else start + limit
    assert got == chronological(frame)[start:end]


def test_split_stats_add_up(txn, frame):
    rows = {r["split"]: r for r in s.split_stats(s.label_split(txn)).collect()}
    assert rows["train"]["n_rows"] + rows["test"]["n_rows"] == 200
    assert rows["train"]["n_fraud"] + rows["test"]["n_fraud"] == 12
    assert rows["train"]["time_max"] <= rows["test"]["time_min"]
    assert rows["test"]["low_fraud_warning"] and not rows["train"]["low_fraud_warning"]


def test_split_without_fraud_has_ratio_zero(txn):
    rows = s.split_stats(s.label_split(txn.withColumn("Class", F.lit(0)))).collect()
    assert all(r["legit_per_fraud"] == 0.0 for r in rows)


def test_sample_is_exact_and_repeatable(txn):
    ids = lambda df: {r["txn_id"] for r in df.collect()}
    first = ids(s.sample_n(txn, 50))
    assert len(first) == 50 == len(ids(s.sample_n(txn.repartition(7), 50)) & first)
    assert ids(s.sample_n(txn, 50, seed=1)) != first
    assert s.sample_n(txn, 500).count() == 200


def test_top_effects_put_undefined_last(spark):
    df = spark.createDataFrame([("a", -3.0), ("b", 1.0), ("c", float("nan")), ("d", 2.0)], "feature string, effect_size double")
    assert [r[0] for r in s.top_effects(df, 3).collect()] == ["a", "d", "b"]
    assert [r[0] for r in s.top_effects(df, 4).collect()][-1] == "c"
    assert [r[0] for r in s.top_effects(df, 2, weakest=True).collect()] == ["c", "b"]
