"""Published records, statistics, recent records, and their streaming twins."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from riskengine.operators import scoring as sc
from riskengine.schema import KEYED_SCHEMA
from riskengine.session import scratch_path
from riskengine.sources.messages import json_of
from riskengine.sources.views import add_formula_score
from riskengine.streaming import raw_zone, score_stream, telemetry
from riskengine.streaming.transport import (
    FileChannel,
    publish,
    publish_stream,
    replay,
    run_bounded,
    subscribe,
)


def payload(spark, rows):
    df = spark.createDataFrame(rows, "txn_id long, scoring_latency_ms double, is_fraud boolean")
    return df.withColumn("scored_at", F.timestamp_seconds(F.col("txn_id") + 1_700_000_000))


def test_payload_contract(txn):
    out = sc.score_payload(add_formula_score(txn).drop("p_b"), 0.5, latency=F.col("scoring_latency_ms"))
    assert "Class" not in out.columns and "p" not in out.columns
    assert out.columns[-5:] == ["fraud_probability", "is_fraud", "threshold_used", "scoring_latency_ms", "scored_at"]
    assert dict(out.dtypes)["scored_at"] == "timestamp" and dict(out.dtypes)["is_fraud"] == "boolean"


@pytest.mark.parametrize("p,flag,shown", [(0.4999999, False, 0.5), (0.5, True, 0.5), (0.12345678, False, 0.123457), (float("nan"), False, None)])
def test_flag_uses_the_unrounded_score(spark, p, flag, shown):
    r = sc.score_payload(spark.createDataFrame([(1, p)], "txn_id long, p double"), 0.5).first()
    assert r["is_fraud"] == flag
    assert shown is None or r["fraud_probability"] == shown


def test_stats_of_known_latencies(spark):
    rows = [(i, float(i), i % 5 == 0) for i in range(1, 11)]
    r = sc.scoring_stats(payload(spark, rows)).first()
    assert (r["total_scored"], r["total_flagged"], r["flag_rate"]) == (10, 2, 0.2)
    assert (r["latency_p50"], r["latency_min"], r["latency_max"], r["latency_mean"]) == (5.5, 1.0, 10.0, 5.5)
    assert r["latency_p95"] == pytest.approx(9.55) and r["latency_p99"] == pytest.approx(9.91)
    cells = payload(spark, rows).groupBy("scoring_latency_ms").agg(F.count("*").alias("n"), F.sum(F.col("is_fraud").cast("long")).alias("n_flagged"))
    assert sc.stats_from_histogram(cells).select(*sorted(r.asDict())).first() == sc.scoring_stats(payload(spark, rows)).select(*sorted(r.asDict())).first()


def test_stats_of_nothing_are_zero(spark):
    r = sc.scoring_stats(payload(spark, [])).first()
    assert set(r.asDict().values()) == {0}


def test_recent_keeps_the_last_in_order(spark):
    df = payload(spark, [(i, 1.0, False) for i in range(10)])
    assert [r["txn_id"] for r in sc.recent(df, 20, limit=5).collect()] == [5, 6, 7, 8, 9]
    assert [r["txn_id"] for r in sc.recent(df, 3).collect()] == [7, 8, 9]
    assert sc.recent(df, 0).count() == 0 and sc.recent(df, -1).count() == 0


def channel_of(spark, txn, extra=()):
    channel = FileChannel(scratch_path(spark, "topic"))
    replay(txn, channel, slices=3)
    if extra:
        publish(spark.createDataFrame([(t,) for t in extra], "value string"), channel)
    return channel


def test_replay_writes_time_ordered_slices(spark, txn):
    channel = channel_of(spark, txn)
    lines = spark.read.text(channel.path).select(
        F.input_file_name().alias("f"), F.get_json_object("value", "$.Time").cast("double").alias("t")
    )
    spans = sorted((r["lo"], r["hi"]) for r in lines.groupBy("f").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).collect())
    assert len(spans) == 3 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_raw_zone_keeps_every_message(spark, txn, frame):
    channel = channel_of(spark, txn, extra=["{broken"])
    zone, state = scratch_path(spark, "zone"), scratch_path(spark, "state")
    raw_zone.ingest(spark, channel, zone, state, per_trigger=1).awaitTermination()
    landed = raw_zone.read_zone(spark, zone)
    assert landed.count() == 201
    assert [r["bad_message"] for r in landed.where("bad_message IS NOT NULL").collect()] == ["{broken"]
    back = raw_zone.transactions_of(landed).toPandas().sort_values("txn_id").reset_index(drop=True)
    assert back["V28"].equals(frame["V28"]) and back["hour"].between(0, 23).all()
    # A second run of the same query finds nothing new; new files are picked up once.
    raw_zone.ingest(spark, channel, zone, state).awaitTermination()
    assert raw_zone.read_zone(spark, zone).count() == 201
    publish(spark.createDataFrame([("{again",)], "value string"), channel)
    raw_zone.ingest(spark, channel, zone, state).awaitTermination()
    assert raw_zone.read_zone(spark, zone).count() == 202


def test_stream_scores_equal_batch_scores(spark, txn):
    channel = channel_of(spark, txn, extra=["{broken", '{"txn_id": 5}'])
    sink = FileChannel(scratch_path(spark, "scored"))
    score_stream.run_scoring(spark, channel, sink, scratch_path(spark, "state"), add_formula_score, 0.6, per_trigger=2).awaitTermination()
    got = score_stream.read_scored(spark, sink.path).drop("scored_at").orderBy("txn_id").collect()
    batch = sc.score_payload(add_formula_score(txn).drop("p_b"), 0.6, latency=F.col("scoring_latency_ms"))
    assert got == batch.drop("scored_at").orderBy("txn_id").collect()
    dead = scratch_path(spark, "dead")
    score_stream.dead_letters(spark, channel, dead, scratch_path(spark, "state")).awaitTermination()
    kinds = {r["problem"].split(":")[0]: r["n"] for r in spark.read.parquet(dead).groupBy("problem").agg(F.count("*").alias("n")).collect()}
    assert kinds == {"bad_json": 1, "missing": 1}


def test_stream_statistics_and_recent(spark, txn, monkeypatch):
    monkeypatch.setattr(telemetry, "KEEP_BATCHES", 2)
    scored = sc.score_payload(add_formula_score(txn).drop("p_b"), 0.5, latency=F.col("scoring_latency_ms"), scored_at=F.timestamp_seconds(F.col("Time").cast("long")))
    scored = scored.select("txn_id", "is_fraud", "scoring_latency_ms", "scored_at")
    channel = FileChannel(scratch_path(spark, "scored"))
    publish(scored.select(json_of(*scored.columns).alias("value")).repartition(3), channel)
    stream = score_stream.stream_scored(spark, channel, per_trigger=1, schema=KEYED_SCHEMA)
    out = scratch_path(spark, "stats")
    telemetry.run_stats(stream, out, scratch_path(spark, "state"), state_partitions=2).awaitTermination()
    got, want = telemetry.latest(spark, out).first().asDict(), sc.scoring_stats(scored).first().asDict()
    assert got == pytest.approx(want)
    out = scratch_path(spark, "recent")
    telemetry.run_recent(stream, out, scratch_path(spark, "state"), limit=7).awaitTermination()
    ids = {r["txn_id"] for r in telemetry.latest(spark, out).collect()}
    assert ids == {r["txn_id"] for r in sc.recent(scored, 7).collect()}


@pytest.mark.parametrize("limits,least,most", [({"max_records": 60}, 60, 150), ({"idle_seconds": 4.0}, 200, 200)])
def test_bounded_runs_stop_after_records_or_idle_time(spark, txn, limits, least, most):
    channel, sink = FileChannel(scratch_path(spark, "topic")), FileChannel(scratch_path(spark, "out"))
    replay(txn, channel, slices=4)
    query = publish_stream(subscribe(spark, channel, per_trigger=1), sink, scratch_path(spark, "state"), interval="1 second")
    assert least <= run_bounded(query, **limits) <= most and not query.isActive


def test_recent_state_outlives_a_restart(spark):
    rows = payload(spark, [(i, 1.0, i % 2 == 0) for i in range(60)]).withColumn(
        "scored_at", F.when(F.col("txn_id") % 6 != 0, F.timestamp_seconds(F.floor(F.col("txn_id") / 4)))
    )
    channel, out, state = (FileChannel(scratch_path(spark, "in")), scratch_path(spark, "recent"), scratch_path(spark, "state"))
    files = [rows.where("txn_id < 40").repartition(3), rows.where("txn_id >= 50"), rows.where("txn_id >= 40 AND txn_id < 50")]
    for k, part in enumerate(files):
        part.write.mode("append").parquet(channel.path)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(channel.path)
        telemetry.run_recent(stream, out, state, limit=9).awaitTermination()
        seen = rows.where("txn_id < 40" if k == 0 else "txn_id < 40 OR txn_id >= 50" if k == 1 else "true")
        got = telemetry.latest(spark, out)
        assert sorted(got.collect()) == sorted(sc.recent(seen, 9).select(got.columns).collect())
    rows.limit(0).write.mode("append").parquet(channel.path)
    telemetry.run_recent(stream, out, state, limit=9).awaitTermination()
    assert telemetry.latest(spark, out).count() == 9


def test_recent_keeps_records_without_a_time_last_and_none_for_no_limit(spark):
    rows = payload(spark, [(i, 1.0, False) for i in range(4)]).withColumn("scored_at", F.lit(None).cast("timestamp"))
    path = scratch_path(spark, "in")
    rows.write.parquet(path)
    for limit, want in ((3, [1, 2, 3]), (0, []), (-2, [])):
        out = scratch_path(spark, "recent")
        telemetry.run_recent(spark.readStream.schema(rows.schema).parquet(path), out, scratch_path(spark, "state"), limit=limit).awaitTermination()
        assert sorted(r["txn_id"] for r in telemetry.latest(spark, out).collect()) == want


def test_recent_runs_whatever_state_store_the_session_has(spark):
    """Spark's default store has no list states; a session that keeps it gets the same records."""
    key, default = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    rows, path, out = payload(spark, [(i, 1.0, False) for i in range(30)]), scratch_path(spark, "in"), scratch_path(spark, "recent")
    rows.repartition(3).write.parquet(path)
    before, partitions = spark.conf.get(key), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(key, default)
    try:
        telemetry.run_recent(spark.readStream.schema(rows.schema).parquet(path), out, scratch_path(spark, "state"), limit=5).awaitTermination()
        assert (spark.conf.get(key), spark.conf.get("spark.sql.shuffle.partitions")) == (default, partitions)
    finally:
        spark.conf.set(key, before)
    assert sorted(r["txn_id"] for r in telemetry.latest(spark, out).collect()) == [25, 26, 27, 28, 29]


@pytest.mark.parametrize("stopped_in", ["scored", "dead"])
def test_fan_out_loses_and_doubles_nothing_over_a_stop(spark, txn, monkeypatch, stopped_in):
    channel = channel_of(spark, txn, extra=["{broken", '{"txn_id": 5}', "{also broken"])
    out, state = scratch_path(spark, "fan-out"), scratch_path(spark, "state")
    judged = []

    def score(rows):
        judged.append(1)
        if len(judged) == 2 and stopped_in == "scored":
            raise RuntimeError("stopped before the second batch is scored")
        return add_formula_score(rows)

    def dies_between(self, path, *args, **kwargs):
        if "/dead/" in path and "batch=1" in path:
            raise RuntimeError("stopped between the two writes")
        return parquet(self, path, *args, **kwargs)

    parquet = DataFrameWriter.parquet
    if stopped_in == "dead":
        monkeypatch.setattr(DataFrameWriter, "parquet", dies_between)
    with pytest.raises(StreamingQueryException):
        score_stream.run_fan_out(spark, channel, out, state, score, 0.6, per_trigger=1).awaitTermination()
    # What a reader sees now is the first batch alone, though the second may be half written.
    records, dead = score_stream.read_fan_out(spark, out)
    assert {r["batch"] for r in records.select("batch").union(dead.select("batch")).collect()} == {0}
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    score_stream.run_fan_out(spark, channel, out, state, score, 0.6, per_trigger=1).awaitTermination()
    records, dead = score_stream.read_fan_out(spark, out)
    assert records.count() == 200 and dead.count() == 3
    batch = sc.score_payload(add_formula_score(txn).drop("p_b"), 0.6, latency=F.col("scoring_latency_ms"))
    assert records.drop("scored_at", "batch").orderBy("txn_id").collect() == batch.drop("scored_at").orderBy("txn_id").collect()
    assert sorted(r["problem"].split(":")[0] for r in dead.collect()) == ["bad_json", "bad_json", "missing"]


def test_fan_out_of_nothing(spark):
    records, dead = score_stream.read_fan_out(spark, scratch_path(spark, "fan-out"))
    assert records.count() == dead.count() == 0
