"""One query per operator, over the given tables. Each takes (spark, table folder).

Sums and averages of doubles depend on the order of addition, so they are rounded here; counts,
keys and values that come from a single operation are returned as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskengine.operators import bootstrap as boot
from riskengine.operators import costs as cost
from riskengine.operators import curves, drift, governance, learners, profile, quality, scoring
from riskengine.operators import slices, split
from riskengine.schema import KEYED_SCHEMA, LABEL, ROW_ID
from riskengine.session import materialize, scratch_path
from riskengine.sources import files, messages, store
from riskengine.sources.views import (
    add_formula_score,
    model_runs,
    scored,
    table,
    transactions,
)
from riskengine.streaming import raw_zone, score_stream, telemetry
from riskengine.streaming.transport import (
    FileChannel,
    LogChannel,
    publish,
    replay,
    run_to_rank,
    slices_for,
    start,
    subscribe,
)

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the queries; the checking SQL uses the same ones.
REPLAY_START, REPLAY_LIMIT = 100, 5000
REFERENCE_ROWS, REFERENCE_SAMPLE = 7500, 2000
SAMPLE_ROWS = 1000
THRESHOLD = 0.5
N_BOOTSTRAPS = 1000
REPLAY_BATCHES = 6
RECENT = 100


def _round(df: DataFrame, **places: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in places.items()})


def _rounded(df: DataFrame, places: int, *skip: str) -> DataFrame:
    """Every double column but `skip`, rounded."""
    cols = [f.name for f in df.schema if f.dataType.typeName() == "double" and f.name not in skip]
    return df.withColumns({c: F.round(c, places) for c in cols})


def _payload(df: DataFrame) -> DataFrame:
    return df.select(*KEYED_SCHEMA.fieldNames())


# --- sources and sinks ---------------------------------------------------------------------


def csv_scan(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.save_csv(_payload(transactions(spark, sf_dir)), path)
    return files.load_dataset(spark, path, KEYED_SCHEMA)


def replay_slice(spark, sf_dir):
    txn = _payload(transactions(spark, sf_dir))
    return split.replay_slice(txn, REPLAY_START, REPLAY_LIMIT).select(
        ROW_ID, "Time", "Amount", LABEL
    )


def reference_scan(spark, sf_dir):
    path = scratch_path(spark, "features")
    quality.compute_features(transactions(spark, sf_dir), keep=(ROW_ID, "Time", LABEL)).write.parquet(path)
    table_ = files.load_features(spark, path)
    out = drift.reference_sample(
        table_, reference_rows=REFERENCE_ROWS, sample_size=REFERENCE_SAMPLE
    )
    return _round(out.drop("Time"), log_amount=9)


def _store(spark, sf_dir):
    root = store.FeatureStore(spark, scratch_path(spark, "store"))
    txn = transactions(spark, sf_dir)
    train, _ = split.time_split(txn)
    root.write_new_version(quality.feature_matrix(train), "training rows")
    root.write_new_version(quality.feature_matrix(txn), "all rows")
    return root


def feature_store_roundtrip(spark, sf_dir):
    return _round(_store(spark, sf_dir).get_current_features(), log_amount=9)


def feature_store_versions(spark, sf_dir):
    root = _store(spark, sf_dir)
    stored = root.get_version(1).withColumn("version", F.lit(1).cast("long")).unionByName(
        root.get_version(2).withColumn("version", F.lit(2).cast("long"))
    )
    counted = stored.groupBy("version").agg(
        F.count(F.lit(1)).alias("rows_read"), F.sum(LABEL).alias("n_fraud")
    )
    return root.list_versions().join(counted, "version").select(
        "version", "description", "n_rows", "n_columns", "is_current", "rows_read", "n_fraud"
    )


def json_encode(spark, sf_dir):
    sent = messages.encode(_payload(transactions(spark, sf_dir)))
    return messages.decode(sent).drop(messages.RAW_TEXT)


def raw_zone_ingest(spark, sf_dir):
    channel = FileChannel(scratch_path(spark, "topic"))
    zone, state = scratch_path(spark, "zone"), scratch_path(spark, "state")
    replay(_payload(transactions(spark, sf_dir)), channel)
    raw_zone.ingest(spark, channel, zone, state, per_trigger=2).awaitTermination()
    landed = raw_zone.transactions_of(raw_zone.read_zone(spark, zone))
    return landed.drop("date", "hour")


def raw_zone_compacted(spark, sf_dir):
    channel = FileChannel(scratch_path(spark, "topic"))
    zone, state = scratch_path(spark, "zone"), scratch_path(spark, "state")
    replay(_payload(transactions(spark, sf_dir)), channel)
    raw_zone.ingest(spark, channel, zone, state, per_trigger=1).awaitTermination()
    raw_zone.compact_zone(spark, zone, before=datetime.now(timezone.utc) + timedelta(days=1))
    landed = raw_zone.transactions_of(raw_zone.read_zone(spark, zone))
    return landed.drop("date", "hour")


def _damaged(txn: DataFrame) -> DataFrame:
    """Messages of all transactions, some of them cut short, incomplete or without a number."""
    kind = F.pmod(F.col(ROW_ID), F.lit(10))
    sound = messages.json_of(*KEYED_SCHEMA.fieldNames())
    part = [c for c in KEYED_SCHEMA.fieldNames() if c != "V14"]
    text = (
        F.when(kind == 3, F.substring(sound, 1, 40))
        .when(kind == 5, messages.json_of(*part))
        .when(kind == 7, F.regexp_replace(sound, '"Amount":[^,}]+', '"Amount":NaN'))
        .otherwise(sound)
    )
    return txn.select(F.col(ROW_ID).alias("key"), text.cast("binary").alias("value"))


def dead_letter_split(spark, sf_dir):
    decoded = messages.decode(_damaged(transactions(spark, sf_dir)), keep=("key",))
    good, dead = messages.split_messages(decoded)
    return good.select(
        "key", F.lit("ok").alias("status"), F.lit(None).cast("string").alias("problem")
    ).unionByName(dead.select("key", F.lit("dead_letter").alias("status"), "problem"))


def predictions_sink(spark, sf_dir):
    _, test = split.time_split(scored(spark, sf_dir))
    path = scratch_path(spark, "predictions")
    out = test.select(ROW_ID, F.col(LABEL).alias("y_true"), "p", "p_b")
    files.save_csv(out, path)
    return spark.read.schema(out.schema).option("header", True).csv(path)


# --- projections and data quality ----------------------------------------------------------


def compute_features(spark, sf_dir):
    out = quality.compute_features(transactions(spark, sf_dir), keep=(ROW_ID,))
    return _round(out, log_amount=9)


def null_audit(spark, sf_dir):
    txn = _payload(transactions(spark, sf_dir)).withColumns(
        {
            "Amount": F.when(F.col(ROW_ID) % 23 == 0, F.lit(float("nan"))).otherwise(F.col("Amount")),
            "V14": F.when(F.col(ROW_ID) % 17 != 0, F.col("V14")),
        }
    )
    return quality.null_audit(txn)


def inf_audit(spark, sf_dir):
    amount = (
        F.when(F.col(ROW_ID) % 29 == 0, F.lit(-1.0))
        .when(F.col(ROW_ID) % 31 == 0, F.lit(-2.0))
        .otherwise(F.col("Amount"))
    )
    txn = transactions(spark, sf_dir).withColumn("Amount", amount)
    return quality.inf_audit(quality.transform_amount(txn), "log_amount")


def amount_log(spark, sf_dir):
    out = quality.transform_amount(transactions(spark, sf_dir))
    return _round(out.select(ROW_ID, "Amount", "log_amount"), log_amount=9)


def hour_of_day(spark, sf_dir):
    out = quality.engineer_time(transactions(spark, sf_dir))
    return out.select(ROW_ID, "Time", "hour_of_day")


def prepare_features(spark, sf_dir):
    out = quality.prepare_features(_payload(transactions(spark, sf_dir)))
    return _round(out, log_amount=9)


def feature_matrix(spark, sf_dir):
    return _round(quality.feature_matrix(transactions(spark, sf_dir)), log_amount=9)


def prescale_check(spark, sf_dir):
    return _rounded(quality.prescale_check(transactions(spark, sf_dir)), 9)


def synthetic_drift(spark, sf_dir):
    feats = quality.compute_features(transactions(spark, sf_dir), keep=(ROW_ID,))
    out = drift.synthetic_drift(feats).select(ROW_ID, "log_amount", *drift.KEY_FEATURES)
    return _rounded(out, 9)


# --- sorting, splitting, sampling ----------------------------------------------------------


def time_split(spark, sf_dir):
    return split.label_split(_payload(transactions(spark, sf_dir))).select(
        ROW_ID, "Time", LABEL, "split"
    )


def split_stats(spark, sf_dir):
    return _rounded(split.split_stats(split.label_split(transactions(spark, sf_dir))), 9)


def sample_n(spark, sf_dir):
    txn = transactions(spark, sf_dir).select(ROW_ID, "Time", "Amount", LABEL)
    return split.sample_n(txn, SAMPLE_ROWS)


def top_effects(spark, sf_dir):
    return _rounded(split.top_effects(profile.class_comparison(transactions(spark, sf_dir))), 6)


def weakest_effects(spark, sf_dir):
    effects = profile.class_comparison(transactions(spark, sf_dir))
    return _rounded(split.top_effects(effects, 5, weakest=True), 6)


# --- aggregation and profiling -------------------------------------------------------------


def dataset_summary(spark, sf_dir):
    return profile.dataset_summary(transactions(spark, sf_dir))


def dataset_columns(spark, sf_dir):
    return profile.column_summary(transactions(spark, sf_dir))


def statistical_profile(spark, sf_dir):
    return _rounded(profile.statistical_profile(transactions(spark, sf_dir)), 6)


def class_profiles(spark, sf_dir):
    sides = profile.class_profiles(transactions(spark, sf_dir))
    fraud, legit = (d.withColumn(LABEL, F.lit(y)) for d, y in zip(sides, (1, 0)))
    return _rounded(fraud.unionByName(legit), 6)


def class_effect_size(spark, sf_dir):
    return _rounded(profile.class_comparison(transactions(spark, sf_dir)), 6)


def amount_outliers(spark, sf_dir):
    return _rounded(profile.amount_outliers(transactions(spark, sf_dir)), 9)


def imbalance(spark, sf_dir):
    return cost.imbalance(transactions(spark, sf_dir))


def naive_baseline(spark, sf_dir):
    return cost.naive_baseline(transactions(spark, sf_dir))


def scale_pos_weight(spark, sf_dir):
    train, _ = split.time_split(transactions(spark, sf_dir))
    return cost.imbalance(train).select("n_legit", "n_fraud", "scale_pos_weight")


def _calibrated(df: DataFrame) -> cost.CostMatrix:
    return cost.CostMatrix().calibrate(df)


def cost_calibration(spark, sf_dir):
    return _rounded(cost.cost_calibration(transactions(spark, sf_dir)), 9)


def expected_cost(spark, sf_dir):
    rows = scored(spark, sf_dir)
    daily = rows.groupBy(F.date_format("scored_at", "yyyy-MM-dd").alias("day")).agg(
        *curves.confusion_aggs(curves.flagged("p", THRESHOLD))
    )
    return _rounded(cost.expected_cost(daily, _calibrated(rows)), 6)


def cost_scenario(spark, sf_dir):
    txn = transactions(spark, sf_dir)
    return _rounded(cost.cost_scenario(txn, _calibrated(txn)), 6)


# --- evaluation ----------------------------------------------------------------------------


def auc_pr(spark, sf_dir):
    out = curves.compute_metrics(scored(spark, sf_dir)).select("n_pos", "n_rows", "auc_pr")
    return _rounded(out, 9)


def auc_roc(spark, sf_dir):
    out = curves.compute_metrics(scored(spark, sf_dir)).select("n_pos", "n_rows", "auc_roc")
    return _rounded(out, 9)


def _sweep(spark, sf_dir):
    rows = scored(spark, sf_dir)
    return curves.threshold_sweep(rows, _calibrated(rows))


def threshold_sweep(spark, sf_dir):
    return _round(_sweep(spark, sf_dir), total_cost=6)


def optimal_threshold(spark, sf_dir):
    best = curves.optimal_threshold(_sweep(spark, sf_dir))
    return _round(best, min_cost=6, cost_at_default=6)


def confusion_at(spark, sf_dir):
    rows = scored(spark, sf_dir)
    return _rounded(curves.confusion_at(rows, THRESHOLD, _calibrated(rows)), 6)


def candidate_thresholds(spark, sf_dir):
    rows = scored(spark, sf_dir)
    return _rounded(curves.candidate_thresholds(rows, _calibrated(rows)), 6)


def slice_by_amount(spark, sf_dir):
    return slices.slice_by_amount(scored(spark, sf_dir), THRESHOLD)


def slice_by_hour(spark, sf_dir):
    return slices.slice_by_hour(quality.engineer_time(scored(spark, sf_dir)), THRESHOLD)


def _samples(spark, sf_dir):
    _, test = split.time_split(scored(spark, sf_dir))
    return boot.bootstrap_samples(test, n_bootstraps=N_BOOTSTRAPS)


def bootstrap_samples(spark, sf_dir):
    return _rounded(_samples(spark, sf_dir), 9)


def bootstrap_summary(spark, sf_dir):
    return _rounded(boot.bootstrap_summary(_samples(spark, sf_dir)), 9)


def bootstrap_percentiles(spark, sf_dir):
    return _rounded(boot.bootstrap_percentiles(_samples(spark, sf_dir)), 9)


def model_choice(spark, sf_dir):
    return boot.model_choice(boot.bootstrap_summary(_samples(spark, sf_dir)))


# --- learning ------------------------------------------------------------------------------


def _matrix_split(spark, sf_dir):
    rows = quality.compute_features(transactions(spark, sf_dir), keep=(ROW_ID, "Time", LABEL))
    return split.time_split(materialize(rows, "matrix"))


def _score_out(df: DataFrame) -> DataFrame:
    """Every scored row and whether its score is a probability: what SQL knows of a trained model."""
    return df.select(ROW_ID, LABEL, "p")


def gbt_train_score(spark, sf_dir):
    train, test = _matrix_split(spark, sf_dir)
    model = learners.train_gbt(train, cost.scale_pos_weight(train))
    return _score_out(learners.predict(model, test))


def _with_error(spark, sf_dir):
    rows = quality.compute_features(transactions(spark, sf_dir), keep=(ROW_ID, "Time", LABEL))
    both = split.label_split(materialize(rows, "matrix"))
    legit = both.where((F.col("split") == "train") & (F.col(LABEL) == 0))
    return learners.reconstruction_error(both, learners.train_autoencoder(legit))


def recon_error(spark, sf_dir):
    return _with_error(spark, sf_dir).select(ROW_ID, LABEL, "split", "recon_error")


def recon_error_by_class(spark, sf_dir):
    return learners.error_by_class(_with_error(spark, sf_dir))


def ensemble_train_score(spark, sf_dir):
    both = materialize(_with_error(spark, sf_dir), "errors")
    train, test = both.where("split = 'train'"), both.where("split = 'test'")
    model = learners.train_ensemble(train, cost.scale_pos_weight(train))
    return _score_out(learners.predict(model, test))


def _stored_threshold(spark, sf_dir) -> float:
    """Choose the cheapest threshold, write it as the serving config and read it back."""
    rows = scored(spark, sf_dir)
    best = curves.optimal_threshold(curves.threshold_sweep(rows, _calibrated(rows)))
    path = scratch_path(spark, "threshold")
    files.save_threshold(path, spark, best, auc_pr=0.0, model_name="formula")
    return files.load_threshold(spark, path)["optimal_threshold"]


def batch_score(spark, sf_dir):
    rows = add_formula_score(_payload(transactions(spark, sf_dir))).drop("p_b")
    out = scoring.score_payload(
        rows, _stored_threshold(spark, sf_dir), latency=F.col("scoring_latency_ms")
    )
    return out.drop("scored_at")


# --- drift ---------------------------------------------------------------------------------


def _sides(spark, sf_dir):
    """Train rows as reference, hold-out rows as current."""
    feats = quality.compute_features(transactions(spark, sf_dir), keep=(ROW_ID, "Time"))
    return drift.mark_sides(feats, split.in_train(feats))


def _distances(spark, sf_dir):
    return drift.distances(_sides(spark, sf_dir))


def drift_ks(spark, sf_dir):
    return _rounded(_distances(spark, sf_dir).drop("wasserstein"), 9)


def drift_pvalue(spark, sf_dir):
    out = drift.with_pvalue(_distances(spark, sf_dir))
    return _rounded(out.select("feature", "p_value", "drifted"), 6)


def drift_wasserstein(spark, sf_dir):
    return _rounded(_distances(spark, sf_dir).select("feature", "wasserstein"), 9)


def drift_moments(spark, sf_dir):
    return _rounded(drift.moments(_sides(spark, sf_dir)), 6)


def _decision_text(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: F.array_join(c, ",") for c in ("drifted_features", "key_features_drifted")}
    )


def drift_decision(spark, sf_dir):
    feats = quality.compute_features(transactions(spark, sf_dir), keep=(ROW_ID, "Time"))
    ref, cur = split.time_split(feats)
    sides = drift.both_sides(ref, drift.synthetic_drift(cur))
    table_ = drift.with_pvalue(drift.distances(sides))
    return _rounded(_decision_text(drift.drift_decision(table_)), 9)


def _by_window(spark, sf_dir):
    feats = quality.compute_features(transactions(spark, sf_dir), keep=(ROW_ID, "Time", "ts"))
    feats = feats.withColumn("window_start", F.to_date("ts"))
    train, _ = split.time_split(feats)
    return drift.drift_by_window(train.drop("window_start"), feats)


def _day(col: str) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def drift_by_window(spark, sf_dir):
    out = _rounded(_by_window(spark, sf_dir), 6)
    return out.withColumn("window_start", _day("window_start"))


def _window_decisions(spark, sf_dir):
    return drift.drift_decision(_by_window(spark, sf_dir), ["window_start"])


def drift_decision_by_window(spark, sf_dir):
    out = _rounded(_decision_text(_window_decisions(spark, sf_dir)), 9)
    return out.withColumn("window_start", _day("window_start"))


def retrain_decision(spark, sf_dir):
    out = governance.retrain_decision(_window_decisions(spark, sf_dir))
    return out.withColumn("window_start", _day("window_start"))


# --- governance ----------------------------------------------------------------------------


def promotion_gate(spark, sf_dir):
    return governance.promotion_gate(model_runs(spark, sf_dir))


def registry_stages(spark, sf_dir):
    decided = materialize(governance.promotion_gate(model_runs(spark, sf_dir)), "decisions")
    return governance.registry_stages(decided)


def register_versions(spark, sf_dir):
    """Register the finished orders first, then offer all orders: known runs get no new version."""
    orders = table(spark, sf_dir, "orders")
    runs = orders.select(
        F.col("o_custkey").cast("string").alias("model_name"),
        F.col("o_orderkey").alias("run_id"),
        (F.col("o_totalprice") / 500000.0).alias("auc_pr"),
        "o_orderstatus",
    )
    empty = spark.createDataFrame([], "model_name string, run_id long, version long")
    known = governance.register_versions(runs.where("o_orderstatus = 'F'"), empty)
    known = materialize(known, "registry")
    fresh = governance.register_versions(runs, known)
    return known.withColumn("wave", F.lit(1)).unionByName(fresh.withColumn("wave", F.lit(2)))


# --- streaming -----------------------------------------------------------------------------


def _sent(spark, df: DataFrame) -> FileChannel:
    channel = FileChannel(scratch_path(spark, "topic"))
    replay(df, channel)
    return channel


def stream_replay(spark, sf_dir):
    """Replay in time order as an ordered log, read as a stream; each row with its rank and batch.

    The query is stopped half way and started again from its checkpoint.
    """
    channel = LogChannel(scratch_path(spark, "log"))
    txn = _payload(transactions(spark, sf_dir))
    replay(txn, channel)
    n_rows = txn.count()
    size = max(1, -(-n_rows // REPLAY_BATCHES))
    landed, state = scratch_path(spark, "landed"), scratch_path(spark, "state")

    def land(batch: DataFrame, number: int) -> None:
        rows = messages.decode(batch, keep=("rank",)).select("rank", ROW_ID, "Time", "Amount", LABEL)
        rows.write.mode("overwrite").parquet(f"{landed}/batch={number}")

    for until in (size * (REPLAY_BATCHES // 2), n_rows):
        writer = subscribe(spark, channel, per_trigger=size).writeStream.foreachBatch(land)
        run_to_rank(start(writer, state, interval="0 seconds"), min(until, n_rows))
    out = spark.read.parquet(landed)
    return out.select("rank", F.col("batch").cast("long").alias("batch"), ROW_ID, "Time", "Amount", LABEL)


def stream_score(spark, sf_dir):
    """The whole table as a message stream, scored and published; the same rows as batch_score."""
    source = _sent(spark, _payload(transactions(spark, sf_dir)))
    sink = FileChannel(scratch_path(spark, "scored"))
    score_stream.run_scoring(
        spark,
        source,
        sink,
        scratch_path(spark, "state"),
        add_formula_score,
        _stored_threshold(spark, sf_dir),
        per_trigger=2,
    ).awaitTermination()
    return score_stream.read_scored(spark, sink.path).drop("scored_at")


def stream_dead_letters(spark, sf_dir):
    source = FileChannel(scratch_path(spark, "topic"))
    damaged = _damaged(_payload(transactions(spark, sf_dir)))
    publish(damaged.repartition(slices_for(damaged)), source)
    path = scratch_path(spark, "dead")
    score_stream.dead_letters(spark, source, path, scratch_path(spark, "state")).awaitTermination()
    return spark.read.parquet(path).groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


def stream_fan_out(spark, sf_dir):
    """Damaged messages through one consumer: the scored records, and the dead letters by problem."""
    source = FileChannel(scratch_path(spark, "topic"))
    damaged = _damaged(_payload(transactions(spark, sf_dir)))
    publish(damaged.repartition(slices_for(damaged)), source)
    out, state = scratch_path(spark, "fan-out"), scratch_path(spark, "state")
    score_stream.run_fan_out(
        spark, source, out, state, add_formula_score, THRESHOLD, per_trigger=2
    ).awaitTermination()
    records, dead = score_stream.read_fan_out(spark, out)
    # The same columns; a message that is not JSON has no txn_id.
    letters = dead.select(ROW_ID, "problem").withColumns(
        {"fraud_probability": F.lit(None).cast("double"), "is_fraud": F.lit(None).cast("boolean")}
    )
    return records.select(ROW_ID, "fraud_probability", "is_fraud").withColumn(
        "problem", F.lit(None).cast("string")
    ).unionByName(letters)


def _published(spark, sf_dir) -> DataFrame:
    """Batch payload with the event time as scoring time, so that results are reproducible."""
    return scoring.score_payload(
        scored(spark, sf_dir).drop("p_b"),
        THRESHOLD,
        latency=F.col("scoring_latency_ms"),
        scored_at=F.col("scored_at"),
    )


def scoring_stats(spark, sf_dir):
    return _rounded(scoring.scoring_stats(_published(spark, sf_dir)), 9)


def recent_n(spark, sf_dir):
    return scoring.recent(_published(spark, sf_dir), RECENT).select(
        ROW_ID, "Time", "fraud_probability", "is_fraud"
    )


def _stream_of_published(spark, sf_dir) -> DataFrame:
    """The published records sent as messages and read back as a stream."""
    payload = _published(spark, sf_dir).select(
        ROW_ID, "Time", "fraud_probability", "is_fraud", "scoring_latency_ms", "scored_at"
    )
    channel = FileChannel(scratch_path(spark, "scored"))
    values = payload.select(messages.json_of(*payload.columns).alias("value"))
    publish(values.repartition(slices_for(values)), channel)
    return score_stream.stream_scored(spark, channel, per_trigger=1)


def stream_scoring_stats(spark, sf_dir):
    out = scratch_path(spark, "stats")
    stream = _stream_of_published(spark, sf_dir)
    telemetry.run_stats(stream, out, scratch_path(spark, "state")).awaitTermination()
    return _rounded(telemetry.latest(spark, out), 9)


def stream_recent(spark, sf_dir):
    out = scratch_path(spark, "recent")
    stream = _stream_of_published(spark, sf_dir)
    telemetry.run_recent(stream, out, scratch_path(spark, "state"), limit=RECENT).awaitTermination()
    return telemetry.latest(spark, out).select(ROW_ID, "Time", "fraud_probability", "is_fraud")


def flagship(spark, sf_dir):
    """Cost of a threshold on the hold-out: features, time split, confusion, cost, per band."""
    rows = quality.prepare_features(transactions(spark, sf_dir))
    costs = _calibrated(rows)
    _, test = split.time_split(add_formula_score(rows))
    table_ = slices.slice_by_amount(test, THRESHOLD)
    return _rounded(cost.expected_cost(table_, costs), 6)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        csv_scan, replay_slice, reference_scan, feature_store_roundtrip, feature_store_versions,
        json_encode, raw_zone_ingest, raw_zone_compacted, dead_letter_split, predictions_sink,
        compute_features, null_audit, inf_audit, amount_log, hour_of_day, prepare_features,
        feature_matrix, prescale_check, synthetic_drift,
        time_split, split_stats, sample_n, top_effects, weakest_effects,
        dataset_summary, dataset_columns, statistical_profile, class_profiles, class_effect_size, amount_outliers,
        imbalance, naive_baseline, scale_pos_weight, cost_calibration, expected_cost, cost_scenario,
        auc_pr, auc_roc, threshold_sweep, optimal_threshold, confusion_at, candidate_thresholds,
        slice_by_amount, slice_by_hour, bootstrap_samples, bootstrap_summary,
        bootstrap_percentiles, model_choice,
        gbt_train_score, recon_error, recon_error_by_class, ensemble_train_score, batch_score,
        drift_ks, drift_pvalue, drift_wasserstein, drift_moments, drift_decision,
        drift_by_window, drift_decision_by_window, retrain_decision,
        promotion_gate, registry_stages, register_versions,
        stream_replay, stream_score, stream_dead_letters, stream_fan_out, scoring_stats, stream_scoring_stats,
        recent_n, stream_recent, flagship,
    )
}
