"""Running statistics and the most recent records of a scored stream."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from riskengine.functions.values import count_where
from riskengine.operators.scoring import RECENT_LIMIT, stats_from_histogram
from riskengine.session import ROCKSDB, STATE_STORE_KEY
from riskengine.sources.files import drop_folder, numbered_folders
from riskengine.streaming.transport import start

BATCH = "batch="
# Snapshots kept, so that a reader of the newest one is never cut off.
KEEP_BATCHES = 20
# Newest first, by the time of scoring; ties by transaction.
NEWEST = [("scored_at", "descending"), ("txn_id", "descending")]


def _write_snapshot(rows: DataFrame, out: str, number: int) -> None:
    """One folder per batch; a repeated batch rewrites its own, old ones are dropped."""
    rows.write.mode("overwrite").parquet(f"{out}/{BATCH}{number}")
    if number >= KEEP_BATCHES:
        drop_folder(rows.sparkSession, f"{out}/{BATCH}{number - KEEP_BATCHES}")


@contextmanager
def _stream_settings(spark: SparkSession, state_partitions: int | None, provider: str | None = None) -> Iterator[None]:
    """A stream fixes its number of state partitions and its state store when it starts."""
    settings = {"spark.sql.shuffle.partitions": state_partitions, STATE_STORE_KEY: provider}
    wanted = {name: str(value) for name, value in settings.items() if value}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def run_stats(
    scored: DataFrame,
    out: str,
    checkpoint: str,
    interval: str | None = None,
    state_partitions: int | None = 8,
) -> StreamingQuery:
    """One snapshot row per micro-batch under `out`/batch=N.

    The state is a histogram of the published latencies: its size is bounded by their resolution,
    not by the number of records, and percentiles taken from it are exact.
    """
    cells = scored.groupBy("scoring_latency_ms").agg(
        F.count(F.lit(1)).alias("n"), count_where(F.col("is_fraud")).alias("n_flagged")
    )

    def snapshot(batch: DataFrame, number: int) -> None:
        _write_snapshot(stats_from_histogram(batch), out, number)

    with _stream_settings(scored.sparkSession, state_partitions):
        writer = cells.writeStream.outputMode("complete").foreachBatch(snapshot)
        return start(writer, checkpoint, interval)


class _Newest(StatefulProcessor):
    """A list state of the newest records, replaced by the newest of it and of each batch."""

    def __init__(self, schema: T.StructType, limit: int):
        self._schema = schema
        self._limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._held = handle.getListState("newest", self._schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        names = self._schema.fieldNames()
        place = [names.index(c) for c, _ in NEWEST]

        def order(record: tuple) -> tuple:
            # A missing value is older than any other.
            return tuple((record[i] is not None, record[i]) for i in place)

        fresh = (tuple(row[c] for c in names) for row in rows)
        newest = heapq.nlargest(self._limit, chain(map(tuple, self._held.get()), fresh), key=order)
        self._held.put(newest)
        for record in newest:
            yield Row(**dict(zip(names, record)))

    def close(self) -> None:
        pass


def _newest_of_part(limit: int):
    """The newest `limit` records of a partition; no more than those and one batch are held."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if best is None else pa.concat_tables([best, rows])
            at = pc.sort_indices(rows, sort_keys=NEWEST, null_placement="at_end")
            best = rows.take(at[:limit])
        if best is not None:
            yield from best.to_batches()

    return pick


def run_recent(
    scored: DataFrame,
    out: str,
    checkpoint: str,
    interval: str | None = None,
    limit: int = RECENT_LIMIT,
) -> StreamingQuery:
    """Keep the newest `limit` records in a list state; each batch writes them as its snapshot.

    Every partition of a batch passes on its own newest `limit` alone, so the one task that holds
    the state reads `limit` records a partition, whatever the length of the batch. Nothing is kept
    for a `limit` of 0 or less. A batch without records leaves the snapshot before it the newest.
    The state is held in RocksDB, whatever state store the session has: the default one has no lists.
    """
    limit = max(0, limit)
    # Python's times depend on the zone of its process: the state holds microseconds.
    times = [f.name for f in scored.schema if f.dataType == T.TimestampType()]
    plain = scored.withColumns({c: F.unix_micros(c) for c in times})
    newest = (
        plain.mapInArrow(_newest_of_part(limit), plain.schema)
        .withColumn("all__", F.lit(0))
        .groupBy("all__")
        .transformWithState(_Newest(plain.schema, limit), plain.schema, "Update", "None")
        .withColumns({c: F.timestamp_micros(c) for c in times})
    )

    def snapshot(batch: DataFrame, number: int) -> None:
        held = batch.persist()  # `limit` records
        try:
            if number == 0 or not held.isEmpty():
                _write_snapshot(held, out, number)
        finally:
            held.unpersist()

    with _stream_settings(scored.sparkSession, 1, ROCKSDB):  # one key, one state
        writer = newest.writeStream.outputMode("update").foreachBatch(snapshot)
        return start(writer, checkpoint, interval)


def latest(spark: SparkSession, out: str) -> DataFrame:
    """The table of the last finished batch."""
    newest = numbered_folders(spark, out, BATCH, finished=True)[-1]
    return spark.read.parquet(f"{out}/{BATCH}{newest}")
