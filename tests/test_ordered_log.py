"""The ordered log: rank offsets, order across batches, restarts, slices of the log, and pace."""

import time

import pytest
from pyspark.sql import functions as F

from riskengine.session import scratch_path
from riskengine.sources import ordered_log
from riskengine.streaming import raw_zone
from riskengine.streaming.transport import (
    FileChannel,
    LogChannel,
    publish,
    publish_stream,
    replay,
    run_to_rank,
    start,
    subscribe,
)


@pytest.fixture(scope="module")
def log(spark, txn):
    path = scratch_path(spark, "log")
    replay(txn, LogChannel(path), slices=5)
    return path


def collected(spark, channel, state, seen, until, **options):
    def keep(batch, number):
        rows = batch.select("rank", F.get_json_object("value", "$.Time").cast("double").alias("t")).orderBy("rank")
        seen.setdefault(number, []).append([(r["rank"], r["t"]) for r in rows.collect()])

    writer = subscribe(spark, channel, **options).writeStream.foreachBatch(keep)
    run_to_rank(start(writer, state, interval="0 seconds"), until)


def test_log_has_every_message_in_time_order(spark, log, frame):
    rows = ordered_log.read_log(spark, log).orderBy("rank").select("rank", F.get_json_object("value", "$.txn_id").cast("long").alias("i"))
    want = frame.sort_values(["Time", "txn_id"])["txn_id"].tolist()
    assert [tuple(r) for r in rows.collect()] == list(enumerate(want))


def test_batches_follow_each_other_in_time_also_after_a_restart(spark, log):
    seen, state = {}, scratch_path(spark, "state")
    collected(spark, LogChannel(log), state, seen, 60, per_trigger=30)
    stopped = len(seen)
    assert stopped >= 2
    collected(spark, LogChannel(log), state, seen, 200, per_trigger=30)
    # A batch that was cut off by the stop is done again with the same rows.
    batches = [seen[k][-1] for k in sorted(seen)]
    assert all(len({tuple(x) for x in seen[k]}) == 1 for k in seen)
    assert [r for b in batches for r, _ in b] == list(range(200))
    assert [len(b) for b in batches] == [30] * 6 + [20]
    assert all(a[-1][1] <= b[0][1] for a, b in zip(batches, batches[1:]))


def test_start_row_and_limit_are_part_of_the_offset(spark, log):
    seen = {}
    collected(spark, LogChannel(log, start_row=35, limit=50), scratch_path(spark, "state"), seen, 85, per_trigger=20)
    assert [r for k in sorted(seen) for r, _ in seen[k][0]] == list(range(35, 85))


@pytest.mark.parametrize("first,stop,limit,expected", [(0, 0, None, 200), (190, 0, 50, 10), (500, 0, 5, 0)])
def test_ends_of_a_log(spark, log, first, stop, limit, expected):
    reader = ordered_log.OrderedLogReader({"path": log, "start_row": str(first), **({"limit": str(limit)} if limit else {})})
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == expected


def test_tasks_read_parts_of_a_file(log, monkeypatch):
    monkeypatch.setattr(ordered_log, "TASK_ROWS", 7)
    reader = ordered_log.OrderedLogReader({"path": log})
    parts = reader.partitions({"rank": 11}, {"rank": 150})
    assert max(p.stop - p.first for p in parts) == 7
    assert [r for p in parts for b in reader.read(p) for r in b.column(0).to_pylist()] == list(range(11, 150))


def test_pace_limits_what_is_there(log, monkeypatch):
    now = [100.0]
    monkeypatch.setattr(time, "monotonic", lambda: now[0])
    reader = ordered_log.OrderedLogReader({"path": log, "per_second": "10", "per_trigger": "25"})
    assert reader.latestOffset() == {"rank": 0}
    now[0] = 101.5
    assert reader.latestOffset() == {"rank": 15}
    reader.partitions({"rank": 0}, {"rank": 15})
    now[0] = 160.0
    assert reader.latestOffset() == {"rank": 40}
    reader.partitions({"rank": 15}, {"rank": 40})
    assert reader.latestOffset() == {"rank": 65}


def test_restarted_reader_goes_on_from_the_stated_offset(log):
    reader = ordered_log.OrderedLogReader({"path": log, "per_trigger": "25"})
    assert reader.partitions({"rank": 75}, {"rank": 75}) == []
    assert reader.latestOffset() == {"rank": 100}


def test_raw_zone_is_fed_from_a_log(spark, log, frame):
    zone = scratch_path(spark, "zone")
    query = raw_zone.ingest(spark, LogChannel(log), zone, scratch_path(spark, "state"), per_trigger=80, interval="0 seconds")
    run_to_rank(query, 200)
    landed = raw_zone.transactions_of(raw_zone.read_zone(spark, zone))
    assert landed.count() == 200 and landed.agg(F.sum("txn_id")).first()[0] == frame["txn_id"].sum()


def test_empty_log_and_wrong_uses(spark, txn, log):
    path = scratch_path(spark, "log")
    replay(txn.limit(0), LogChannel(path))
    reader = ordered_log.OrderedLogReader({"path": path})
    assert reader.latestOffset() == {"rank": 0} and reader.partitions({"rank": 0}, {"rank": 0}) == []
    with pytest.raises(ValueError, match="replay"):
        publish(txn, LogChannel(path))
    with pytest.raises(ValueError, match="pace"):
        subscribe(spark, FileChannel(path), per_second=1.0)


def test_a_failed_query_is_reported(spark, log):
    def fail(batch, number):
        raise RuntimeError("no room")

    writer = subscribe(spark, LogChannel(log)).writeStream.foreachBatch(fail)
    with pytest.raises(Exception, match="no room"):
        run_to_rank(start(writer, scratch_path(spark, "state"), interval="0 seconds"), 200)


def test_scored_records_leave_in_order(spark, log):
    sink = FileChannel(scratch_path(spark, "out"))
    query = publish_stream(subscribe(spark, LogChannel(log), per_trigger=100).select("value"), sink, scratch_path(spark, "state"), "0 seconds")
    run_to_rank(query, 200)
    assert spark.read.text(sink.path).count() == 200
