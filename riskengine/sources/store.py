"""Versioned feature tables: one immutable Parquet folder and one commit file per version."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskengine.sources.commits import claim, write_text
from riskengine.sources.files import path_exists

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("description", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("n_columns", T.LongType()),
        T.StructField("columns", T.ArrayType(T.StringType())),
    ]
)


class FeatureStore:
    """Time travel over feature tables; writing moves the current version to the newest.

    A version is its data, in a folder of a name of its own, and a commit file named by its number.
    The commit is written aside and renamed without overwriting, so that of two writers one gets
    the number and the other tries the next one. Data without a commit is never seen.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def _commits(self) -> str:
        return f"{self.root}/commits"

    def list_versions(self) -> DataFrame:
        """One row per version with `is_current`; empty when nothing was written."""
        if path_exists(self.spark, self._commits):
            rows = self.spark.read.schema(MANIFEST_SCHEMA).json(self._commits)
        else:
            rows = self.spark.createDataFrame([], MANIFEST_SCHEMA)
        # There is one small commit per version.
        current = rows.agg(F.max("version")).first()[0]
        return rows.withColumn("is_current", F.col("version") == F.lit(current))

    def current_version(self) -> int | None:
        return self.list_versions().agg(F.max("version")).first()[0]

    def write_new_version(self, df: DataFrame, description: str) -> int:
        """Write df as the next version. Writers at once get different numbers, none is lost."""
        token = uuid.uuid4().hex
        path = f"{self.root}/data/{token}"
        df.write.mode("errorifexists").parquet(path)
        entry = {
            "path": path,
            "created_at": datetime.now(timezone.utc).isoformat(),
            "description": description,
            "n_rows": self.spark.read.schema(df.schema).parquet(path).count(),
            "n_columns": len(df.columns),
            "columns": df.columns,
        }
        version = self.current_version() or 0
        while True:
            version += 1
            # The name begins with a dot, so that readers pass over it.
            aside = f"{self._commits}/.{token}-{version}"
            write_text(self.spark, aside, json.dumps({"version": version, **entry}))
            if claim(self.spark, aside, f"{self._commits}/{version:012d}.json"):
                return version

    def get_version(self, version: int) -> DataFrame:
        row = self.list_versions().where(F.col("version") == version).first()
        if row is None:
            raise LookupError(f"version {version} is not in the store at {self.root}")
        return self.spark.read.parquet(row["path"])

    def get_current_features(self) -> DataFrame:
        version = self.current_version()
        if version is None:
            raise LookupError(f"the store at {self.root} holds no version")
        return self.get_version(version)
