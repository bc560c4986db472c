"""Transactions as JSON messages: encoding, decoding, and routing of unusable ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskengine.functions.features import row_problem, unusable
from riskengine.schema import KEYED_SCHEMA

RAW_TEXT = "bad_message"


def json_of(*cols: str) -> Column:
    """The columns as one JSON object; missing values are written as null, not left out."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def encode(df: DataFrame, cols: list[str] | None = None, key: str | None = None) -> DataFrame:
    """One message per row: `value` as bytes, and `key` when a key column is named."""
    value = json_of(*(cols or df.columns)).cast("binary").alias("value")
    return df.select(F.col(key).cast("string").cast("binary").alias("key"), value) if key else df.select(value)


def decode(
    messages: DataFrame, schema: T.StructType = KEYED_SCHEMA, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Parse `value` with a fixed schema. Text that is not such an object is kept in `bad_message`.

    Absent keys become NULL, unknown keys are ignored, a bare NaN is a number.
    """
    text = F.col("value").cast("string")
    with_raw = T.StructType([*schema.fields, T.StructField(RAW_TEXT, T.StringType())])
    record = F.from_json(text, with_raw, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW_TEXT})
    # A generator, so that filters on the fields do not pull the parser into every one of them.
    parsed = messages.select(
        *keep, text.alias("text__"), F.explode(F.array(F.struct(record.alias("v")))).alias("r")
    )
    empty = F.col("r.v").isNull()
    return parsed.select(
        *keep,
        *[f"r.v.{c}" for c in schema.fieldNames()],
        F.when(empty, F.coalesce("text__", F.lit(""))).otherwise(F.col(f"r.v.{RAW_TEXT}")).alias(RAW_TEXT),
    )


def usable() -> Column:
    """True for a decoded message that can be scored."""
    return F.col(RAW_TEXT).isNull() & ~unusable()


def problem() -> Column:
    """Why a decoded message cannot be scored; NULL when it can."""
    return F.when(F.col(RAW_TEXT).isNotNull(), F.lit("bad_json")).otherwise(row_problem())


def split_messages(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, dead letters with their `problem`) of one decoded table or stream."""
    return (
        decoded.where(usable()).drop(RAW_TEXT),
        decoded.where(~usable()).withColumn("problem", problem()),
    )
