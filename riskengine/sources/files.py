"""CSV, Parquet and JSON files in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskengine.schema import FEATURES, ROW_ID, TXN_SCHEMA


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on the file system the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def numbered_folders(
    spark: SparkSession, path: str, prefix: str, finished: bool = False
) -> list[int]:
    """The numbers N of the sub-folders `<prefix>N`, ascending; empty when there is no such path.

    `finished` leaves out folders whose write has not been committed.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    found = sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix))
    return [n for n in found if not finished or path_exists(spark, f"{path}/{prefix}{n}/_SUCCESS")]


def last_finished(spark: SparkSession, path: str, prefix: str) -> int | None:
    """The largest N of a finished `<prefix>N`; looks at as few folders as it can."""
    newest_first = reversed(numbered_folders(spark, path, prefix))
    return next((n for n in newest_first if path_exists(spark, f"{path}/{prefix}{n}/_SUCCESS")), None)


def drop_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def load_dataset(spark: SparkSession, path: str, schema: T.StructType = TXN_SCHEMA) -> DataFrame:
    """CSV with a header, read with a fixed schema; an error when the path does not exist."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no dataset at {path}")
    return spark.read.schema(schema).option("header", True).csv(path)


def save_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def load_features(spark: SparkSession, path: str) -> DataFrame:
    """The ordering keys and the 30 features of a feature table; only these columns are read."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no feature table at {path}")
    return spark.read.parquet(path).select(ROW_ID, "Time", *FEATURES)


def save_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def save_threshold(
    path: str, spark: SparkSession, choice: DataFrame, auc_pr: float, model_name: str
) -> None:
    """Write the chosen threshold (a row of optimal_threshold) with its quality and the time."""
    choice.select(
        "optimal_threshold",
        F.lit(float(auc_pr)).alias("auc_pr"),
        F.lit(model_name).alias("model_name"),
        F.col("precision").alias("precision_at_threshold"),
        F.col("recall").alias("recall_at_threshold"),
        F.current_timestamp().alias("training_timestamp"),
    ).write.mode("overwrite").json(path)


def load_threshold(spark: SparkSession, path: str) -> dict:
    """Read it back; an error when the file or the threshold is missing."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no threshold config at {path}")
    row = spark.read.json(path).first()
    config = row.asDict() if row else {}
    if config.get("optimal_threshold") is None:
        raise ValueError(f"no optimal_threshold in {path}")
    return config
