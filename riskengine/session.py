"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
STATE_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "riskengine", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config(STATE_STORE_KEY, ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A temporary one takes its place on a local master alone, where all tasks share one disk; on a
    cluster an unset folder is an error.
    """
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="riskengine-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_root(spark)}/riskengine/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str, narrow: bool = False) -> DataFrame:
    """Write `df` once and read it back: durable, cuts lineage, keeps column pruning.

    `narrow`: for rows of a few numbers, which are first dealt to as many files as there are cores,
    however many partitions they come from; Spark joins smaller ones and splits larger ones.
    """
    spark = df.sparkSession
    if narrow:
        df = df.hint("rebalance", spark.sparkContext.defaultParallelism)
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
