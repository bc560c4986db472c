"""Gradient-boosted trees for a label of 0 and 1, grown level by level from sums over binned rows.

The trees are those of Spark ML's GBTClassifier (logistic loss, first tree on labels of -1 and 1, bins
of even weight found on about 10,000 rows, variance as impurity), and the result is its model. A row is
a byte or so per feature, a label and a margin. One task grows all trees if it can hold all rows; else
a level of a tree is one job of one stage, whose tasks return sums. The trees are the same either way.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskengine.functions import treehist as th
from riskengine.session import scratch_path, shared_root

# Fixed value: thresholds are found on about this many rows, and on all rows of a shorter table.
SPLIT_ROWS = 10_000
# Rows of a task. Up to the larger number one task is faster than a job for each level.
LEAST_ROWS, MOST_ROWS = 100_000, 2_000_000
# Sums of more tasks than this are added up on executors before they come to the driver.
DIRECT_TASKS = 64
# Two bins of this width are a code of 16 bits.
WIDEST = 256

_MODEL = "org.apache.spark.ml.classification.GBTClassificationModel"
_TREE = "org.apache.spark.ml.regression.DecisionTreeRegressionModel"
_NOT_OF_TREES = {
    "featureSubsetStrategy", "lossType", "maxIter", "probabilityCol", "rawPredictionCol", "stepSize",
    "subsamplingRate", "thresholds", "validationIndicatorCol", "validationTol",
}
# Spark ML's layout of saved trees.
_NODES = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, "
    "rawCount long, gain double, leftChild int, rightChild int, "
    "split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)


def fit_trees(
    rows: DataFrame,
    features: list[str],
    label: str,
    pos_weight: float,
    booster: GBTClassifier,
    most_rows: int = MOST_ROWS,
) -> GBTClassificationModel:
    """The model `booster` describes (trees, depth, step, bins, seed), positives weighing `pos_weight`."""
    if not 0 <= pos_weight < float("inf"):
        raise ValueError(f"positives can't weigh {pos_weight}")
    if booster.getMaxBins() > WIDEST:
        raise ValueError(f"at most {WIDEST} bins")
    spark, y = rows.sparkSession, F.col(label)
    path = scratch_path(spark, "trees")
    known = F.when(y.isin(0, 1), y).otherwise(F.raise_error(F.lit("labels are 0 or 1")))
    rows = rows.select(*[F.col(c).cast("double").alias(c) for c in features], known.cast("byte").alias(label))
    n_rows = rows.count()
    if not n_rows:
        raise ValueError("no rows to train on")
    weights = np.array([1.0, float(pos_weight)])
    n_bins = min(booster.getMaxBins(), n_rows)
    grid = th.Grid(_cut_points(rows, features, label, n_rows, weights, n_bins, booster.getSeed()), weights)
    n_trees, rate, depth = booster.getMaxIter(), booster.getStepSize(), booster.getMaxDepth()
    if n_rows <= most_rows:
        held = _blocks(rows, features, label, 1, grid)
        trees = held.mapPartitions(
            lambda b: th.boosted(th.HeldRows(b, grid), n_trees, rate, depth, grid)
        ).collect()
    else:
        cores = spark.sparkContext.defaultParallelism
        rounds = -(-n_rows // (most_rows * cores))
        tasks = rounds * min(cores, max(2, -(-n_rows // LEAST_ROWS)))
        source = SpreadRows(spark, _blocks(rows, features, label, tasks, grid), grid, booster.getCheckpointInterval())
        trees = th.boosted(source, n_trees, rate, depth, grid)
        source.finish()
    return _model(spark, trees, grid, booster, path)


def _cut_points(
    rows: DataFrame, features: list[str], label: str, n_rows: int, weights: np.ndarray, n_bins: int, seed: int
) -> list[np.ndarray]:
    """The thresholds of each feature."""
    wanted = max(SPLIT_ROWS, n_bins**2)
    some = rows if n_rows <= wanted else rows.sample(False, wanted / n_rows, seed)

    def thresholds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                th.cut_points(np.array(x, float), weights[np.array(y, int)], n_bins)
                for x, y in zip(batch["x"].to_pylist(), batch["y"].to_pylist())
            ]
            yield pa.RecordBatch.from_pydict({"i": batch["i"], "cuts": pa.array(found, pa.list_(pa.float64()))})

    # A list leaves out what is NULL, so that it is written as NaN, which is an error.
    entries = F.array(*(F.ifnull(F.col(c), F.lit(float("nan"))) for c in features))
    long = some.select(F.posexplode(entries).alias("i", "x"), F.col(label).alias("y"))
    listed = long.groupBy("i").agg(F.collect_list(F.struct("x", "y")).alias("xy"))
    found = listed.select("i", "xy.x", "xy.y").mapInArrow(thresholds, "i int, cuts array<double>").collect()
    by_feature = {r["i"]: r["cuts"] for r in found}
    return [np.array(by_feature.get(i, []), float) for i in range(len(features))]


def _blocks(rows: DataFrame, features: list[str], label: str, tasks: int, grid: th.Grid) -> RDD:
    """Blocks of coded rows in `tasks` partitions."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = grid.codes([batch[c].to_numpy(zero_copy_only=False) for c in features])
                y = batch[label].to_numpy(zero_copy_only=False).astype(np.int8)
                yield pa.RecordBatch.from_pydict({"codes": [codes.tobytes()], "y": [y.tobytes()]})

    pieces = rows.mapInArrow(packed, "codes binary, y binary").repartition(tasks)
    return pieces.rdd.mapPartitions(lambda held: th.blocks(held, grid))


class SpreadRows:
    """Blocks in many tasks. After each tree they are cached anew, with the margins they have then."""

    def __init__(self, spark: SparkSession, state: RDD, grid: th.Grid, every: int):
        self.spark, self.state, self.grid, self.every = spark, state, grid, every
        self.before = self.last = self.saved = None
        self.n_trees = 0
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(shared_root(spark))

    def _added(self, sums: RDD):
        if sums.getNumPartitions() > DIRECT_TASKS:
            return sums.treeReduce(add)
        return reduce(add, sums.collect())

    def sums(self, tree: th.Tree, level: int, wanted: list[int]) -> th.Sums:
        grid, save = self.grid, level == 0 and self.n_trees % self.every == 0
        if level == 0:
            self.state.persist(StorageLevel.MEMORY_AND_DISK)
        if save:
            self.state.checkpoint()
        sums = self._added(
            self.state.mapPartitions(lambda b: th.summed(th.walked(b, tree, level, grid), tree, wanted, grid))
        )
        if level == 0 and self.last:
            self.last.close(sums.last_square)
            self.before.unpersist()
        if save:
            self._drop()
            self.saved = self.state.getCheckpointFile()
        return sums

    def move(self, tree: th.Tree, rate: float) -> None:
        grid, depth = self.grid, len(tree.feature).bit_length() - 1
        self.before, self.last, self.n_trees = self.state, tree, self.n_trees + 1
        self.state = self.state.mapPartitions(
            lambda b: (x.moved(tree, rate, grid) for x in th.walked(b, tree, depth, grid))
        )

    def finish(self) -> None:
        self.last.close(self._added(self.state.map(lambda block: block.square)))
        self.before.unpersist()
        self._drop()

    def _drop(self) -> None:
        """Delete the checkpoint that a later one has replaced."""
        if self.saved:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.saved)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _model(
    spark: SparkSession, trees: list[th.Tree], grid: th.Grid, booster: GBTClassifier, path: str
) -> GBTClassificationModel:
    """The trees as Spark ML's model, by way of its file layout under `path`."""
    given = {p.name: v for p, v in booster._paramMap.items()}
    default = {p.name: v for p, v in booster._defaultParamMap.items()}

    def described(name: str, uid: str, leave_out: set[str], **more) -> str:
        about = {"class": name, "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid}
        maps = {"paramMap": given, "defaultParamMap": default}
        return json.dumps(about | {m: {p: v for p, v in x.items() if p not in leave_out} for m, x in maps.items()} | more)

    whole = described(_MODEL, booster.uid, set(), numFeatures=len(grid.cuts), numTrees=len(trees))
    each = [
        (k, described(_TREE, f"dtr_{uuid.uuid4().hex[:12]}", _NOT_OF_TREES), booster.getStepSize() if k else 1.0)
        for k in range(len(trees))
    ]
    nodes = [(k, node) for k, tree in enumerate(trees) for node in tree.listed(grid.cuts)]
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(nodes, _NODES, verifySchema=False).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)
