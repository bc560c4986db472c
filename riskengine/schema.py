"""The transactions table: column names, types and the fixed lists built on them."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and order are part of the data contract.
PCA_FEATURES = [f"V{i}" for i in range(1, 29)]
ENGINEERED_FEATURES = ["log_amount", "hour_of_day"]
FEATURES = PCA_FEATURES + ENGINEERED_FEATURES
RAW_COLUMNS = ["Time", *PCA_FEATURES, "Amount"]
KEY_FEATURES = ["V17", "V14", "V12", "V10", "V16"]
LABEL = "Class"
ROW_ID = "txn_id"

TXN_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in RAW_COLUMNS]
    + [T.StructField(LABEL, T.IntegerType())]
)

# Rows carry an explicit id, so ties in Time have a stable order.
KEYED_SCHEMA = T.StructType([T.StructField(ROW_ID, T.LongType()), *TXN_SCHEMA.fields])
