"""Landing the message stream as immutable Parquet under date=/hour= of the ingestion clock."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskengine.schema import KEYED_SCHEMA
from riskengine.sources import compaction
from riskengine.sources.messages import RAW_TEXT, decode
from riskengine.streaming.transport import Channel, start, subscribe


def ingest(
    spark: SparkSession,
    channel: Channel,
    zone: str,
    checkpoint: str,
    schema: T.StructType = KEYED_SCHEMA,
    per_trigger: int | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Write every message untransformed. Unreadable ones land as text in `bad_message`.

    The file sink commits each micro-batch once, so a restart neither loses nor repeats records.
    """
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    rows = decode(subscribe(spark, channel, per_trigger), schema).select(
        "*", F.date_format(now, "yyyy-MM-dd").alias("date"), F.date_format(now, "HH").alias("hour")
    )
    writer = (
        rows.writeStream.format("parquet")
        .option("path", zone)
        .partitionBy("date", "hour")
        .outputMode("append")
    )
    return start(writer, checkpoint, interval)


def _landed(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [
            *schema.fields,
            T.StructField(RAW_TEXT, T.StringType()),
            T.StructField("date", T.DateType()),
            T.StructField("hour", T.IntegerType()),
        ]
    )


def read_zone(spark: SparkSession, zone: str, schema: T.StructType = KEYED_SCHEMA) -> DataFrame:
    """All landed messages with their partition columns; filters on those prune folders."""
    return compaction.read_merged(spark, zone, _landed(schema))


def compact_zone(
    spark: SparkSession,
    zone: str,
    before: datetime | None = None,
    target_bytes: int = compaction.TARGET_BYTES,
    schema: T.StructType = KEYED_SCHEMA,
) -> int:
    """Merge the small files of closed hours; see `compaction.compact`. Readers miss no message meanwhile."""
    return compaction.compact(spark, zone, _landed(schema), before, target_bytes)


def transactions_of(zone: DataFrame) -> DataFrame:
    """The readable messages."""
    return zone.where(F.col(RAW_TEXT).isNull()).drop(RAW_TEXT)
