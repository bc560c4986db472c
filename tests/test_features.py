"""Projections, contracts and message decoding, with edge-case rows."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskengine.functions.draws import normal, uniform
from riskengine.operators import quality as q
from riskengine.schema import FEATURES, KEYED_SCHEMA, PCA_FEATURES, RAW_COLUMNS
from riskengine.sources import messages as m

NAN, INF = float("nan"), float("inf")


def one(spark, **changes):
    row = {"txn_id": 1, "Time": 3600.0, **{c: 0.1 * i for i, c in enumerate(PCA_FEATURES, 1)}, "Amount": 149.62, "Class": 0}
    row.update(changes)
    return spark.createDataFrame([tuple(row[f] for f in KEYED_SCHEMA.fieldNames())], KEYED_SCHEMA)


def test_feature_names_and_order(txn):
    assert len(FEATURES) == 30 and FEATURES[-2:] == ["log_amount", "hour_of_day"]
    assert q.compute_features(txn).columns == FEATURES
    assert q.feature_names() == FEATURES


def test_features_match_numpy(txn, frame):
    got = q.compute_features(txn, keep=("txn_id",)).toPandas().sort_values("txn_id")
    assert np.allclose(got["log_amount"], np.log1p(frame["Amount"]), atol=1e-12)
    assert np.allclose(got["hour_of_day"], (frame["Time"] % 86400) / 3600)
    assert np.array_equal(got["V14"], frame["V14"])


@pytest.mark.parametrize("time,hour", [(0.0, 0.0), (86399.0, 86399 / 3600), (86400.0, 0.0), (90000.0, 1.0), (-5.0, 86395 / 3600)])
def test_hour_of_day_wraps(spark, time, hour):
    assert q.engineer_time(one(spark, Time=time)).first()["hour_of_day"] == pytest.approx(hour)


@pytest.mark.parametrize("amount,want", [(0.0, 0.0), (math.e - 1, 1.0), (-1.0, -INF), (INF, INF)])
def test_log_amount(spark, amount, want):
    assert q.transform_amount(one(spark, Amount=amount)).first()["log_amount"] == pytest.approx(want)


def test_log_amount_below_minus_one_is_nan(spark):
    assert math.isnan(q.transform_amount(one(spark, Amount=-2.0)).first()["log_amount"])


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="V14"):
        q.compute_features(one(spark).drop("V14"))


@pytest.mark.parametrize("bad", [{"Amount": None}, {"V3": NAN}, {"Amount": -1.0}])
def test_strict_features_fail_on_bad_rows(spark, bad):
    with pytest.raises(Exception, match="no features"):
        q.compute_features(one(spark, **bad), strict=True).collect()
    assert q.compute_features(one(spark), strict=True).count() == 1


def test_null_audit_counts_null_and_nan(spark):
    df = one(spark, V1=None).union(one(spark, V1=NAN)).union(one(spark, Amount=None))
    got = {r["feature"]: r["n_missing"] for r in q.null_audit(df).collect()}
    assert got["V1"] == 2 and got["Amount"] == 1 and got["V2"] == 0 and got["Class"] == 0
    with pytest.raises(ValueError, match="3 missing values"):
        q.require_no_nulls(df)
    assert q.require_no_nulls(one(spark)).count() == 1


def test_inf_audit(spark):
    df = q.transform_amount(one(spark, Amount=-1.0).union(one(spark, Amount=-2.0)).union(one(spark)))
    r = q.inf_audit(df, "log_amount").first()
    assert (r["n_rows"], r["n_inf"], r["n_nan"]) == (3, 1, 1)
    with pytest.raises(ValueError, match="infinite"):
        q.require_no_inf(df, "log_amount")


def test_prepare_keeps_all_columns(txn):
    assert set(RAW_COLUMNS + ["Class", "txn_id", "log_amount", "hour_of_day"]) == set(q.prepare_features(txn).columns)


def test_prescale_check(txn, frame):
    got = {r["feature"]: (r["mean"], r["std"]) for r in q.prescale_check(txn).collect()}
    assert len(got) == 28
    assert got["V7"] == pytest.approx((frame["V7"].mean(), frame["V7"].std()))


def test_json_round_trip_is_exact(txn, frame):
    back = m.decode(m.encode(txn)).toPandas().sort_values("txn_id").reset_index(drop=True)
    assert back["bad_message"].isna().all()
    assert np.array_equal(back[RAW_COLUMNS].to_numpy(), frame[RAW_COLUMNS].to_numpy())


def test_decode_sorts_out_messages(spark):
    sound = json.loads(m.encode(one(spark)).first()["value"].decode())
    broken = {k: v for k, v in sound.items() if k != "V14"}
    texts = {
        "ok": json.dumps(sound),
        "extra": json.dumps({**sound, "more": 1}),
        "cut": json.dumps(sound)[:30],
        "text": "not json",
        "empty": "",
        "absent": json.dumps(broken),
        "nan": json.dumps({**sound, "Amount": NAN}),
        "type": json.dumps({**sound, "V1": "abc"}),
        "minus": json.dumps({**sound, "Amount": -1.0}),
    }
    df = spark.createDataFrame([(k, t.encode()) for k, t in texts.items()], "key string, value binary")
    good, dead = m.split_messages(m.decode(df, keep=("key",)))
    assert {r["key"] for r in good.collect()} == {"ok", "extra"}
    assert {r["key"]: r["problem"] for r in dead.collect()} == {
        "cut": "bad_json", "text": "bad_json", "empty": "bad_json", "type": "bad_json",
        "absent": "missing:V14", "nan": "missing:Amount", "minus": "infinite:log_amount",
    }


def test_draws_do_not_depend_on_partitioning(spark):
    a = spark.range(0, 5000, 1, 1).select("id", normal(0, 1, 42, F.col("id")).alias("x"), uniform(1, F.col("id")).alias("u"))
    b = spark.range(0, 5000, 1, 7).select("id", normal(0, 1, 42, F.col("id")).alias("x"), uniform(1, F.col("id")).alias("u"))
    pa, pb = a.toPandas(), b.toPandas().sort_values("id").reset_index(drop=True)
    assert pa.equals(pb)
    assert abs(pa["x"].mean()) < 0.05 and abs(pa["x"].std() - 1) < 0.05
    assert 0 < pa["u"].min() and pa["u"].max() < 1
