"""Message channels: a Kafka topic, an ordered log, or a folder of text files with one message per line."""

from __future__ import annotations

import re
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from riskengine.operators.split import CHRONOLOGICAL
from riskengine.sources.messages import encode, json_of
from riskengine.sources.ordered_log import stream_log, write_log

# Default channel names.
RAW_TOPIC = "transactions-raw"
SCORED_TOPIC = "transactions-scored"

# Slices of a replayed table: by its length, a few at least so that a stream has several batches.
ROWS_PER_SLICE = 1_000_000
MIN_SLICES = 4


@dataclass(frozen=True)
class FileChannel:
    """A folder; each file is one slice of the stream. Slices are read as they come, not in time order."""

    path: str


@dataclass(frozen=True)
class LogChannel:
    """An ordered log written once by `replay`; it is read by rank, with `start_row` and `limit` of the read."""

    path: str
    start_row: int = 0
    limit: int | None = None


@dataclass(frozen=True)
class KafkaChannel:
    """A topic; needs the Kafka connector on the class path."""

    servers: str
    topic: str = RAW_TOPIC


Channel = FileChannel | LogChannel | KafkaChannel


def publish(messages: DataFrame, channel: Channel) -> None:
    """Send a batch of (value[, key]) rows, in no particular order."""
    if isinstance(channel, LogChannel):
        raise ValueError("an ordered log is written by replay()")
    if isinstance(channel, KafkaChannel):
        writer = messages.write.format("kafka").option("kafka.bootstrap.servers", channel.servers)
        writer.option("topic", channel.topic).save()
    else:
        messages.select(F.col("value").cast("string")).write.mode("append").text(channel.path)


def slices_for(df: DataFrame) -> int:
    """How many pieces a table is sent in."""
    return max(MIN_SLICES, -(-df.count() // ROWS_PER_SLICE))


def replay(
    df: DataFrame, channel: Channel, cols: list[str] | None = None, slices: int | None = None
) -> None:
    """Send a table in time order: range-sorted pieces, as many as its rows need, each sorted inside.

    Only an ordered log keeps the order for its readers; other channels keep it inside a piece.
    """
    if isinstance(channel, LogChannel):
        message = df.select(json_of(*(cols or df.columns)).alias("value"), *CHRONOLOGICAL)
        write_log(message, CHRONOLOGICAL, channel.path, slices or slices_for(df))
        return
    ordered = df.repartitionByRange(slices or slices_for(df), *CHRONOLOGICAL).sortWithinPartitions(*CHRONOLOGICAL)
    publish(encode(ordered, cols), channel)


def subscribe(
    spark: SparkSession, channel: Channel, per_trigger: int | None = None, per_second: float | None = None
) -> DataFrame:
    """The channel as a stream of `value`; `per_trigger` bounds a micro-batch (records or files).

    An ordered log also has `rank`, and `per_second` sets the pace at which its records appear.
    """
    if isinstance(channel, LogChannel):
        return stream_log(
            spark,
            channel.path,
            start_row=channel.start_row,
            limit=channel.limit,
            per_trigger=per_trigger,
            per_second=per_second,
        )
    if per_second is not None:
        raise ValueError("only an ordered log is replayed at a pace")
    if isinstance(channel, KafkaChannel):
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", channel.servers)
            .option("subscribe", channel.topic)
            .option("startingOffsets", "earliest")
        )
        if per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", per_trigger)
        return reader.load().select("value", "timestamp")
    reader = spark.readStream.format("text")
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(channel.path).select("value")


def start(writer: DataStreamWriter, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Run until the channel is drained, or keep running when an interval is given.

    Without an interval an ordered log is read in a single batch of `per_trigger` records at most;
    `run_bounded` stops a running query at a number of records.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def run_bounded(
    query: StreamingQuery,
    max_records: int | None = None,
    idle_seconds: float | None = None,
    poll_seconds: float = 0.5,
) -> int:
    """Wait until the query has read `max_records`, or nothing for `idle_seconds`, then stop it.

    Returns the records read. Whole micro-batches are counted: the one that reaches the limit is
    finished, so `per_trigger` sets how far it can be passed. A drained query ends the wait, too.
    """
    read: dict[int, int] = {}
    last = time.monotonic()
    while query.isActive:
        for batch in query.recentProgress:
            if batch.numInputRows and batch.batchId not in read:
                last = time.monotonic()
            read[batch.batchId] = max(batch.numInputRows, read.get(batch.batchId, 0))
        if max_records is not None and sum(read.values()) >= max_records:
            break
        if query.status["isTriggerActive"] and query.status["isDataAvailable"]:
            last = time.monotonic()  # at work on a batch
        if idle_seconds is not None and time.monotonic() - last >= idle_seconds:
            break
        time.sleep(poll_seconds)
    query.stop()
    for batch in query.recentProgress:
        read[batch.batchId] = max(batch.numInputRows, read.get(batch.batchId, 0))
    return sum(read.values())


def run_to_rank(query: StreamingQuery, rank: int, poll_seconds: float = 0.1) -> None:
    """Wait until a query on an ordered log has finished the batch that reaches `rank`, then stop it."""
    while query.isActive and not any(_end_rank(p) >= rank for p in query.recentProgress):
        time.sleep(poll_seconds)
    query.stop()
    if query.exception() is not None:
        raise query.exception()


def _end_rank(progress) -> int:
    found = re.search(r"rank\D+(\d+)", str(progress.sources[0].endOffset))
    return int(found[1]) if found else -1


def publish_stream(
    messages: DataFrame, channel: Channel, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Send a stream of JSON strings in `value`."""
    if isinstance(channel, KafkaChannel):
        writer = (
            messages.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", channel.servers)
            .option("topic", channel.topic)
        )
    else:
        writer = messages.writeStream.format("text").option("path", channel.path)
    return start(writer.outputMode("append"), checkpoint, interval)
