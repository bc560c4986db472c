"""Feature drift: two-sample distances per feature, the drift decision, synthetic drift."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskengine.functions.draws import normal
from riskengine.functions.kstest import ks_pvalue
from riskengine.operators.ordered import (
    BUCKET,
    bucket_number,
    find_edges,
    melt,
    running_totals,
)
from riskengine.operators.quality import require_columns
from riskengine.operators.split import first_rows, sample_n, time_split
from riskengine.schema import FEATURES, KEY_FEATURES, ROW_ID
from riskengine.session import materialize

# Defaults of the drift decision.
DRIFT_SHARE = 0.20
P_VALUE = 0.05
KEY_FEATURE_COUNT = 2

# Windows are compared in smaller value buckets, as a Python task holds one of them.
WINDOW_BUCKETS = 10


def both_sides(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """Two tables as one: a = 1 on reference rows, b = 1 on current rows."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    cols = [c for c in ref.columns if c in cur.columns]
    return ref.select(*cols, one.alias("a"), zero.alias("b")).unionByName(
        cur.select(*cols, zero.alias("a"), one.alias("b"))
    )


def mark_sides(df: DataFrame, is_reference: Column) -> DataFrame:
    """One table whose rows belong to either side; it is then scanned once, not twice."""
    return df.withColumn("a", F.when(is_reference, 1).otherwise(0).cast("long")).withColumn(
        "b", 1 - F.col("a")
    )


def distances(
    sides: DataFrame,
    keys: Sequence[str] = (),
    cols: list[str] = FEATURES,
) -> DataFrame:
    """(keys..., feature, n_ref, n_cur, ks, wasserstein) from the two running shares.

    Features are handled together in one long table, spread over value buckets and ordered inside
    them. Equal values are collapsed on the map side, so a hot value costs no more than another.
    """
    keys = list(keys)
    require_columns(sides, cols)
    part = [*keys, "feature", BUCKET]
    edges = find_edges(sides, cols)
    rows = _collapsed(melt(sides, cols, keep=[*keys, "a", "b"], edges=edges, by_number=True), part)
    by = [*keys, "feature"]
    curve = running_totals(rows, by, "value", ["a", "b"], next_value=True)
    gap = F.abs(
        F.try_divide(F.col("a_cum").cast("double"), F.col("a_all").cast("double"))
        - F.try_divide(F.col("b_cum").cast("double"), F.col("b_all").cast("double"))
    )
    per_feature = curve.groupBy(*by).agg(
        F.max("a_all").alias("n_ref"),
        F.max("b_all").alias("n_cur"),
        F.max(gap).alias("ks"),
        F.coalesce(F.sum(gap * (F.col("next_value") - F.col("value"))), F.lit(0.0)).alias(
            "wasserstein"
        ),
    )
    names = F.array(*[F.lit(c) for c in cols])
    return per_feature.withColumn("feature", names[F.col("feature")])


def _collapsed(rows: DataFrame, part: list[str]) -> DataFrame:
    return rows.groupBy(*part, "value").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def moments(sides: DataFrame, keys: Sequence[str] = (), cols: list[str] = FEATURES) -> DataFrame:
    """Mean and population standard deviation of each feature on both sides."""
    keys = list(keys)
    r = F.when(F.col("a") == 1, F.col("value"))
    c = F.when(F.col("b") == 1, F.col("value"))
    return (
        melt(sides, cols, keep=[*keys, "a", "b"])
        .groupBy(*keys, "feature")
        .agg(
            F.avg(r).alias("ref_mean"),
            F.avg(c).alias("cur_mean"),
            F.stddev_pop(r).alias("ref_std"),
            F.stddev_pop(c).alias("cur_std"),
        )
    )


def with_pvalue(table: DataFrame, p_value: float = P_VALUE) -> DataFrame:
    p = ks_pvalue(F.col("ks"), F.col("n_ref"), F.col("n_cur"))
    return table.withColumn("p_value", p).withColumn("drifted", F.col("p_value") < p_value)


def drift_report(
    sides: DataFrame,
    keys: Sequence[str] = (),
    cols: list[str] = FEATURES,
    p_value: float = P_VALUE,
) -> DataFrame:
    """All per-feature drift numbers; one row per (keys, feature)."""
    by = [*keys, "feature"]
    return with_pvalue(distances(sides, keys, cols), p_value).join(moments(sides, keys, cols), by)


def drift_decision(
    report: DataFrame,
    keys: Sequence[str] = (),
    drift_share: float = DRIFT_SHARE,
    key_features: int = KEY_FEATURE_COUNT,
) -> DataFrame:
    """Drift when enough features moved, or enough of the key ones; one row per key."""
    place = F.create_map(*[F.lit(v) for i, c in enumerate(FEATURES) for v in (c, i)])
    rank = F.create_map(*[F.lit(v) for i, c in enumerate(KEY_FEATURES) for v in (c, i)])
    name, drifted = F.col("feature"), F.col("drifted")
    listed = report.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_features_count"),
        # At most one entry per feature.
        F.sort_array(F.collect_list(F.when(drifted, F.struct(place[name].alias("o"), name)))).alias(
            "moved"
        ),
        F.sort_array(
            F.collect_list(
                F.when(drifted & name.isin(KEY_FEATURES), F.struct(rank[name].alias("o"), name))
            )
        ).alias("moved_key"),
    )
    n = F.col("drifted_features_count").cast("double")
    return (
        listed.select(
            *keys,
            F.size("moved").cast("long").alias("drifted_features_count"),
            "total_features_count",
            F.transform("moved", lambda m: m["feature"]).alias("drifted_features"),
            F.transform("moved_key", lambda m: m["feature"]).alias("key_features_drifted"),
        )
        .withColumn("drift_share", n / F.col("total_features_count").cast("double"))
        .withColumn("drift_by_share", F.col("drift_share") >= drift_share)
        .withColumn("drift_by_key_features", F.size("key_features_drifted") >= key_features)
        .withColumn("drift_detected", F.col("drift_by_share") | F.col("drift_by_key_features"))
    )


def synthetic_drift(
    df: DataFrame,
    amount_log_shift: float = 2.0,
    v_mean_shift: float = 1.5,
    v_noise_std: float = 1.0,
    features: list[str] | None = None,
    seed: int = 42,
) -> DataFrame:
    """Shift log_amount and add normal noise to the chosen features, row by row."""
    changed = {}
    if "log_amount" in df.columns:
        changed["log_amount"] = F.col("log_amount") + amount_log_shift
    for f in features or KEY_FEATURES:
        if f in df.columns:
            base = changed.get(f, F.col(f))
            changed[f] = base + normal(v_mean_shift, v_noise_std, seed, f, F.col(ROW_ID))
    return df.withColumns(changed)


def reference_sample(
    table: DataFrame,
    split_only: bool = True,
    reference_rows: int | None = None,
    sample_size: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """The reference side: the training part of the table, or its first `reference_rows`, sampled."""
    out = table
    if split_only:
        out, _ = time_split(table) if reference_rows is None else first_rows(table, reference_rows)
    return sample_n(out, sample_size, seed) if sample_size else out


def _windows_in_bucket(window_start: str):
    """Distances of every window within one value bucket, the reference read once.

    Between two values of a window its share is constant while the reference's only rises: the
    largest gap is at an end, and the area between them has at most one crossing, found by binary
    search. `steps` holds the bucket's values, `known` what lies before and after the bucket.
    """

    def measure(steps: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        is_ref = steps[window_start].isna()
        ref = steps[is_ref].sort_values("value")
        windows = dict(tuple(steps[~is_ref].sort_values("value").groupby(window_start)))
        at = ref["value"].to_numpy()
        lo, hi, ref_base, n_ref = known[["lo", "hi", "ref_base", "n_ref"]].iloc[0]
        counts = np.r_[ref_base, ref_base + ref["n"].to_numpy().cumsum()]
        share = counts / n_ref if n_ref else np.zeros(len(counts))
        starts = np.r_[lo, at]
        # Area under the reference's share from lo on, linear between these places.
        places = np.r_[starts, hi]
        areas = np.r_[0.0, np.cumsum(share * np.diff(places))]
        out = known[["feature_of", window_start, "n_ref", "n_cur"]].rename(columns={"feature_of": "feature"})
        ks, area = [], []
        for window, base, n_cur in zip(known[window_start], known["base"], known["n_cur"]):
            mine = windows.get(window)
            values = mine["value"].to_numpy() if mine is not None else np.empty(0)
            held = np.r_[base, base + mine["n"].to_numpy().cumsum()] if mine is not None else np.r_[base]
            if not n_ref or not n_cur:
                ks.append(np.nan)
                area.append(0.0)
                continue
            level = held / n_cur
            before = share[np.searchsorted(at, values, side="left")]
            after = share[np.searchsorted(at, values, side="right")]
            gaps = np.r_[np.abs(before - level[:-1]), np.abs(after - level[1:])]
            ks.append(gaps.max() if len(gaps) else np.nan)
            left, right = np.r_[lo, values], np.r_[values, hi]
            cross = np.r_[starts, hi][np.searchsorted(share, level, side="right")]
            cross = np.clip(cross, left, right)
            a, c, b = (np.interp(x, places, areas) for x in (left, cross, right))
            area.append(float(np.sum(level * (cross - left) - (c - a) + (b - c) - level * (right - cross))))
        return out.assign(ks=ks, wasserstein=area)

    return measure


def window_distances(
    ref: DataFrame, rows: DataFrame, window_start: str, cols: list[str] = FEATURES
) -> DataFrame:
    """`distances` of every window of `rows` from all of `ref`, with `ref` ordered only once.

    Both tables are put in value buckets together. A bucket of a feature is one group, about a
    million rows long; what it needs of the buckets before comes from a table of bucket totals.
    """
    cols_in = [window_start, *cols]
    kind = rows.schema[window_start].dataType
    both = ref.withColumn(window_start, F.lit(None).cast(kind)).select(cols_in).unionByName(
        rows.where(F.col(window_start).isNotNull()).select(cols_in)
    )
    n_buckets = bucket_number(both.sparkSession, WINDOW_BUCKETS * both.count())
    edges = find_edges(both, cols, n_buckets)
    steps = materialize(
        melt(both, cols, keep=[window_start], edges=edges, by_number=True)
        .groupBy("feature", BUCKET, window_start, "value")
        .agg(F.count(F.lit(1)).alias("n")),
        "steps",
    )
    # One entry per window: the list of days.
    days = [r[0] for r in steps.select(window_start).distinct().collect() if r[0] is not None]
    listed = F.array(*[F.lit(d) for d in days]).cast(T.ArrayType(kind))
    across = Window.partitionBy("feature").orderBy(BUCKET)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    is_ref = F.col(window_start).isNull()
    buckets = (
        steps.groupBy("feature", BUCKET)
        .agg(
            F.coalesce(F.sum(F.when(is_ref, F.col("n"))), F.lit(0)).alias("ref_n"),
            F.min("value").alias("lo"),
            F.max("value").alias("top"),
        )
        .select(
            "feature",
            BUCKET,
            "lo",
            F.coalesce(F.lead("lo").over(across), F.col("top")).alias("hi"),
            F.coalesce(F.sum("ref_n").over(earlier), F.lit(0)).alias("ref_base"),
            F.sum("ref_n").over(Window.partitionBy("feature")).alias("n_ref"),
        )
        .select("*", F.explode(listed).alias(window_start))
    )
    part = ["feature", BUCKET]
    on = [*part, window_start]
    mine = steps.where(~is_ref).groupBy(*on).agg(F.sum("n").alias("cur_n"))
    by_window = Window.partitionBy("feature", window_start)
    before = by_window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    known = buckets.join(mine, on, "left").select(
        *[F.col(c).alias(f"{c}_of") for c in part],
        *[c for c in buckets.columns if c not in part],
        F.coalesce(F.sum("cur_n").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.sum("cur_n").over(by_window), F.lit(0)).alias("n_cur"),
    )
    out = T.StructType(
        [
            T.StructField("feature", T.IntegerType()),
            T.StructField(window_start, kind),
            T.StructField("n_ref", T.LongType()),
            T.StructField("n_cur", T.LongType()),
            T.StructField("ks", T.DoubleType()),
            T.StructField("wasserstein", T.DoubleType()),
        ]
    )
    found = (
        steps.groupBy(*part)
        .cogroup(known.groupBy(*[f"{c}_of" for c in part]))
        .applyInPandas(_windows_in_bucket(window_start), out)
    )
    names = F.array(*[F.lit(c) for c in cols])
    return (
        found.groupBy(window_start, "feature")
        .agg(
            F.max("n_ref").alias("n_ref"),
            F.max("n_cur").alias("n_cur"),
            F.max(F.nanvl("ks", F.lit(None))).alias("ks"),
            F.sum("wasserstein").alias("wasserstein"),
        )
        .withColumn("feature", names[F.col("feature")])
    )


def drift_by_window(
    ref: DataFrame,
    rows: DataFrame,
    window_start: str = "window_start",
    cols: list[str] = FEATURES,
    p_value: float = P_VALUE,
) -> DataFrame:
    """Every window of `rows` against the same reference rows: the per-feature report."""
    by = [window_start, "feature"]
    found = window_distances(ref, rows, window_start, cols)
    of_ref = moments(mark_sides(ref, F.lit(True)), [], cols).select("feature", "ref_mean", "ref_std")
    of_cur = moments(mark_sides(rows, F.lit(False)), [window_start], cols)
    return (
        with_pvalue(found, p_value)
        .join(of_cur.select(*by, "cur_mean", "cur_std"), by)
        .join(F.broadcast(of_ref), "feature")  # one row per feature
    )
