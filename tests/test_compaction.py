"""Merging small files of a raw zone: readers see the same rows before, during and after."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from riskengine.session import scratch_path
from riskengine.sources import compaction
from riskengine.sources.messages import encode
from riskengine.streaming import raw_zone
from riskengine.streaming.transport import FileChannel, publish

LATER = datetime.now(timezone.utc) + timedelta(days=1)


@pytest.fixture
def landed(spark, txn):
    """A zone of many small files, its channel and its stream's state."""
    channel = FileChannel(scratch_path(spark, "topic"))
    zone, state = scratch_path(spark, "zone"), scratch_path(spark, "state")
    for k in range(4):
        part = txn.where(F.col("txn_id") % 4 == k).repartition(2)
        publish(encode(part).select(F.col("value").cast("string")), channel)
    publish(spark.createDataFrame([("{broken",)], "value string"), channel)
    raw_zone.ingest(spark, channel, zone, state, per_trigger=1).awaitTermination()
    return zone, channel, state


def rows_of(spark, zone):
    return sorted((r["txn_id"] if r["txn_id"] is not None else -1, r["Amount"] or 0.0, r["bad_message"] or "", str(r["date"]), r["hour"]) for r in raw_zone.read_zone(spark, zone).collect())


def files_of(spark, zone):
    return set(raw_zone.read_zone(spark, zone).inputFiles())


def test_rows_are_the_same_before_and_after(spark, landed):
    zone, channel, state = landed
    before, files = rows_of(spark, zone), files_of(spark, zone)
    assert len(before) == 201 and len(files) >= 8
    assert raw_zone.compact_zone(spark, zone) == 0  # the current hour is open
    # At the turn of an hour the messages lie in two of them.
    assert raw_zone.compact_zone(spark, zone, LATER) >= len(files) - 1
    assert rows_of(spark, zone) == before and len(files_of(spark, zone)) <= 2
    assert raw_zone.compact_zone(spark, zone, LATER) == 0
    # A message that lands later is read beside the merged ones, then merged with its like.
    for text in ("{late", "{later"):
        publish(spark.createDataFrame([(text,)], "value string"), channel)
    raw_zone.ingest(spark, channel, zone, state, per_trigger=1).awaitTermination()
    after = rows_of(spark, zone)
    assert len(after) == 203 and set(before) < set(after)
    raw_zone.compact_zone(spark, zone, LATER)
    assert rows_of(spark, zone) == after
    # Partition filters still reach the scan of both kinds of files.
    day = before[0][3]
    assert raw_zone.read_zone(spark, zone).where(F.col("date") == F.lit(day).cast("date")).count() == sum(r[3] == day for r in after)


def test_a_merge_without_its_commit_is_not_seen(spark, landed, monkeypatch):
    zone, _, _ = landed
    before, files = rows_of(spark, zone), files_of(spark, zone)

    def lost(*_):
        assert rows_of(spark, zone) == before  # while it is written
        raise OSError("driver lost")

    monkeypatch.setattr(compaction, "_commit", lost)
    with pytest.raises(OSError):
        raw_zone.compact_zone(spark, zone, LATER)
    assert rows_of(spark, zone) == before and files_of(spark, zone) == files
    monkeypatch.undo()
    assert raw_zone.compact_zone(spark, zone, LATER) > 0 and rows_of(spark, zone) == before


def test_of_two_merges_at_once_one_counts(spark, landed, monkeypatch):
    zone, _, _ = landed
    before = rows_of(spark, zone)
    commit, done = compaction._commit, []

    def second(*args):
        if not done:
            done.append(None)
            done[0] = raw_zone.compact_zone(spark, zone, LATER)
        return commit(*args)

    monkeypatch.setattr(compaction, "_commit", second)
    assert raw_zone.compact_zone(spark, zone, LATER) == 0 and done[0] > 0
    assert rows_of(spark, zone) == before and len(compaction._commits(spark, zone)) == 1


def test_files_are_filled_up_to_the_target(spark, landed):
    zone, _, _ = landed
    before = rows_of(spark, zone)
    sizes = [r["length"] for r in spark.read.format("binaryFile").load(list(files_of(spark, zone))).select("length").collect()]
    target = 2 * max(sizes) + 1
    assert raw_zone.compact_zone(spark, zone, LATER, target_bytes=target) > 0
    merged = files_of(spark, zone)
    assert rows_of(spark, zone) == before and 2 < len(merged) < len(sizes)
