"""Scoring a message stream with the same projections as a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskengine.operators.scoring import score_payload
from riskengine.schema import KEYED_SCHEMA
from riskengine.sources.files import last_finished, path_exists
from riskengine.sources.messages import RAW_TEXT, decode, json_of, split_messages
from riskengine.streaming.transport import Channel, publish_stream, start, subscribe

# Folders of a fan-out.
SCORED, DEAD, BATCH = "scored", "dead", "batch="

SCORING_FIELDS = [
    T.StructField("fraud_probability", T.DoubleType()),
    T.StructField("is_fraud", T.BooleanType()),
    T.StructField("threshold_used", T.DoubleType()),
    T.StructField("scoring_latency_ms", T.DoubleType()),
    T.StructField("scored_at", T.TimestampType()),
]


def scored_schema(schema: T.StructType = KEYED_SCHEMA) -> T.StructType:
    """Schema of a published record for a given input schema."""
    kept = [f for f in schema.fields if f.name != "Class"]
    return T.StructType([*kept, *SCORING_FIELDS])


def score_messages(
    messages: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    threshold: float,
    latency: Column | None = None,
    schema: T.StructType = KEYED_SCHEMA,
) -> DataFrame:
    """Decode, drop unusable messages, add the score `p`, and build the published record."""
    usable, _ = split_messages(decode(messages, schema))
    return _payload(usable, score, threshold, latency, schema)


def _payload(
    usable: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    threshold: float,
    latency: Column | None,
    schema: T.StructType,
) -> DataFrame:
    judged = score(usable)
    if latency is None and "scoring_latency_ms" in judged.columns:
        latency = F.col("scoring_latency_ms")
    payload = score_payload(judged, threshold, latency=latency)
    return payload.select(*[f.name for f in scored_schema(schema)])


def run_scoring(
    spark: SparkSession,
    source: Channel,
    sink: Channel,
    checkpoint: str,
    score: Callable[[DataFrame], DataFrame],
    threshold: float,
    per_trigger: int | None = None,
    interval: str | None = None,
    schema: T.StructType = KEYED_SCHEMA,
) -> StreamingQuery:
    """Read, score and publish one JSON record per usable message."""
    payload = score_messages(subscribe(spark, source, per_trigger), score, threshold, None, schema)
    records = payload.select(json_of(*payload.columns).alias("value"))
    return publish_stream(records, sink, checkpoint, interval)


def dead_letters(
    spark: SparkSession,
    source: Channel,
    path: str,
    checkpoint: str,
    per_trigger: int | None = None,
    interval: str | None = None,
    schema: T.StructType = KEYED_SCHEMA,
) -> StreamingQuery:
    """Keep what the scorer skips, with the reason, as its own consumer of the channel."""
    _, dead = split_messages(decode(subscribe(spark, source, per_trigger), schema))
    writer = dead.writeStream.format("parquet").option("path", path).outputMode("append")
    return start(writer, checkpoint, interval)


def run_fan_out(
    spark: SparkSession,
    source: Channel,
    out: str,
    checkpoint: str,
    score: Callable[[DataFrame], DataFrame],
    threshold: float,
    per_trigger: int | None = None,
    interval: str | None = None,
    schema: T.StructType = KEYED_SCHEMA,
) -> StreamingQuery:
    """One consumer, two sinks: scored records and dead letters, each message decoded once.

    A batch has a folder of JSON records under `out`/scored and one of Parquet under `out`/dead,
    both named by its number, and is finished with the second. One that is run again after a stop
    rewrites its own folders, or leaves them as they are if both are finished, so no message is
    lost, doubled, or in both. `read_fan_out` shows finished batches only.
    """

    def write(batch: DataFrame, number: int) -> None:
        name = f"{BATCH}{number}"
        if path_exists(spark, f"{out}/{DEAD}/{name}/_SUCCESS"):
            return
        # Read by both writes; a block lost with its executor is decoded again from the source.
        decoded = batch.persist(StorageLevel.DISK_ONLY)
        try:
            usable, dead = split_messages(decoded)
            payload = _payload(usable, score, threshold, None, schema)
            records = payload.select(json_of(*payload.columns).alias("value"))
            records.write.mode("overwrite").text(f"{out}/{SCORED}/{name}")
            dead.write.mode("overwrite").parquet(f"{out}/{DEAD}/{name}")
        finally:
            decoded.unpersist()

    decoded = decode(subscribe(spark, source, per_trigger), schema)
    return start(decoded.writeStream.foreachBatch(write), checkpoint, interval)


def read_fan_out(
    spark: SparkSession, out: str, schema: T.StructType = KEYED_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """(scored records, dead letters) of all finished batches, with the number of their `batch`.

    Batches finish one after the other, so those up to the last finished one are whole.
    """
    last = last_finished(spark, f"{out}/{DEAD}", BATCH)
    number = T.StructField("batch", T.LongType())
    record = T.StructType([*scored_schema(schema).fields, number])
    letter = T.StructType(
        [
            *schema.fields,
            T.StructField(RAW_TEXT, T.StringType()),
            T.StructField("problem", T.StringType()),
            number,
        ]
    )
    if last is None:
        return spark.createDataFrame([], record), spark.createDataFrame([], letter)
    whole = F.col("batch") <= last
    return (
        spark.read.schema(record).json(f"{out}/{SCORED}").where(whole),
        spark.read.schema(letter).parquet(f"{out}/{DEAD}").where(whole),
    )


def read_scored(
    spark: SparkSession, path: str, schema: T.StructType = KEYED_SCHEMA
) -> DataFrame:
    """Published records read back from a file channel."""
    return spark.read.schema(scored_schema(schema)).json(path)


def stream_scored(
    spark: SparkSession,
    channel: Channel,
    per_trigger: int | None = None,
    schema: T.StructType = KEYED_SCHEMA,
) -> DataFrame:
    """Published records as a stream, for the telemetry queries."""
    record = F.from_json(F.col("value").cast("string"), scored_schema(schema))
    return subscribe(spark, channel, per_trigger).select(record.alias("r")).select("r.*")
