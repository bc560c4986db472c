"""Files, the feature store, learners and the end-to-end plans."""

import glob
import json
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskengine.operators import learners as ln
from riskengine.operators import quality
from riskengine.operators.boosting import fit_trees
from riskengine.plans.eda import run_eda
from riskengine.plans.training import load_serving_model, save_result, train_and_evaluate
from riskengine.schema import FEATURES, KEYED_SCHEMA
from riskengine.session import scratch_path
from riskengine.sources import files
from riskengine.sources.commits import claim, write_text
from riskengine.sources.store import FeatureStore
from riskengine.streaming import score_stream
from riskengine.streaming.transport import FileChannel, replay
from conftest import make_frame
from test_evaluation import average_precision


def test_csv_round_trip_and_missing_path(spark, txn, frame):
    path = scratch_path(spark, "csv")
    with pytest.raises(FileNotFoundError):
        files.load_dataset(spark, path)
    files.save_csv(txn, path)
    back = files.load_dataset(spark, path, KEYED_SCHEMA).toPandas().sort_values("txn_id").reset_index(drop=True)
    assert back.equals(frame)


def test_feature_scan_reads_only_the_needed_columns(spark, txn):
    path = scratch_path(spark, "features")
    quality.prepare_features(txn).write.parquet(path)
    plan = files.load_features(spark, path).select("V1")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<V1:double>" in plan
    with pytest.raises(FileNotFoundError):
        files.load_features(spark, path + "-none")


def test_feature_store_time_travel(spark, txn):
    store = FeatureStore(spark, scratch_path(spark, "store"))
    assert store.list_versions().count() == 0 and store.current_version() is None
    with pytest.raises(LookupError):
        store.get_current_features()
    feats = quality.compute_features(txn, keep=("txn_id",))
    assert store.write_new_version(feats.limit(50), "first") == 1
    assert store.write_new_version(feats, "second") == 2
    assert store.get_version(1).count() == 50 and store.get_current_features().count() == 200
    rows = {r["version"]: r for r in store.list_versions().collect()}
    assert (rows[1]["n_rows"], rows[2]["n_rows"], rows[2]["n_columns"]) == (50, 200, 31)
    assert rows[2]["is_current"] and not rows[1]["is_current"] and rows[1]["description"] == "first"
    assert rows[2]["columns"] == ["txn_id", *FEATURES]
    with pytest.raises(LookupError):
        store.get_version(9)
    # A write that died before its commit is not seen and does not block the next one.
    feats.limit(1).write.parquet(f"{store.root}/data/unfinished")
    write_text(spark, f"{store.root}/commits/.unfinished", "{")
    assert store.write_new_version(feats, "third") == 3 and store.list_versions().count() == 3
    assert rows[2]["created_at"] >= rows[1]["created_at"]


def test_writers_at_once_get_different_versions(spark, txn):
    store = FeatureStore(spark, scratch_path(spark, "store"))
    parts = [txn.limit(10 * k) for k in range(1, 5)]
    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(lambda part: store.write_new_version(part, "parallel"), parts))
    assert sorted(versions) == [1, 2, 3, 4]
    assert [store.get_version(v).count() for v in versions] == [10, 20, 30, 40]
    assert store.current_version() == 4 and store.list_versions().count() == 4


def test_a_taken_number_is_not_overwritten(spark):
    root = scratch_path(spark, "store")
    for k in range(2):
        write_text(spark, f"{root}/commits/.aside{k}", '{"version": 1, "description": "%d"}' % k)
    assert [claim(spark, f"{root}/commits/.aside{k}", f"{root}/commits/1.json") for k in range(2)] == [True, False]
    assert [r["description"] for r in FeatureStore(spark, root).list_versions().collect()] == ["0"]


def test_threshold_config(spark):
    path = scratch_path(spark, "config")
    with pytest.raises(FileNotFoundError):
        files.load_threshold(spark, path)
    choice = spark.createDataFrame([(0.031, 0.56, 0.81)], "optimal_threshold double, precision double, recall double")
    files.save_threshold(path, spark, choice, 0.7996, "baseline")
    got = files.load_threshold(spark, path)
    assert (got["optimal_threshold"], got["auc_pr"], got["model_name"]) == (0.031, 0.7996, "baseline")
    other = scratch_path(spark, "config")
    spark.createDataFrame([(1,)], "x int").write.json(other)
    with pytest.raises(ValueError, match="optimal_threshold"):
        files.load_threshold(spark, other)


def test_reconstruction_error_matches_numpy(spark, txn):
    feats = quality.feature_matrix(txn)
    model = ln.train_autoencoder(feats.where("Class = 0"), encoding_dim=14)
    got = ln.reconstruction_error(feats, model).toPandas().sort_values("txn_id")
    x = got[FEATURES].to_numpy()
    legit = x[got["Class"].to_numpy() == 0]
    z = (x - legit.mean(0)) / legit.std(0, ddof=1)
    zl = z[got["Class"].to_numpy() == 0]
    _, vectors = np.linalg.eigh(np.cov(zl.T))
    v = vectors[:, ::-1][:, :14]
    want = ((z - z @ v @ v.T) ** 2).mean(1)
    assert np.allclose(got["recon_error"], want, atol=1e-9)
    assert not [c for c in got.columns if c.endswith("__")]


def test_no_encoder_gives_zero_errors(txn):
    assert {r[0] for r in ln.reconstruction_error(txn, None).select("recon_error").collect()} == {0.0}


def test_error_by_class(spark):
    df = spark.createDataFrame([("train", 0, 1.0), ("train", 0, 3.0), ("train", 1, 6.0), ("test", 0, 2.0)], "split string, Class int, recon_error double")
    rows = {r["split"]: r for r in ln.error_by_class(df).collect()}
    assert rows["train"]["fraud_to_legit"] == 3.0 and rows["test"]["fraud_error"] is None


@pytest.fixture(scope="module")
def learnable(spark):
    frame = make_frame(800, seed=11, frauds=90)
    frame.loc[frame["Class"] == 1, ["V14", "V17"]] -= 2.5
    return spark.createDataFrame(frame, KEYED_SCHEMA)


def test_trees_at_full_settings_score_a_stream_as_they_score_a_table(spark, learnable):
    """Held-out average precision far above the 11 % of positives, and one model for both inputs."""
    feats = quality.compute_features(learnable, keep=("txn_id", "Class"))
    model = ln.train_gbt(feats.where("txn_id % 4 > 0"), 8.0)
    assert model.stages[-1].getNumTrees == 200
    held = learnable.where("txn_id % 4 = 0")
    table = ln.predict(model, quality.compute_features(held, keep=("txn_id", "Class"))).toPandas()
    assert average_precision(table["Class"].to_numpy(), table["p"].to_numpy()) > 0.75
    assert table["p"].between(0, 1).all()

    source, sink = FileChannel(scratch_path(spark, "topic")), FileChannel(scratch_path(spark, "scored"))
    replay(held, source)
    score = lambda df: ln.predict(model, quality.prepare_features(df))
    score_stream.run_scoring(spark, source, sink, scratch_path(spark, "state"), score, 0.4).awaitTermination()
    got = score_stream.read_scored(spark, sink.path).toPandas().set_index("txn_id").sort_index()
    want = table.set_index("txn_id").sort_index()
    assert list(got.index) == list(want.index)
    assert np.allclose(got["fraud_probability"], want["p"], atol=1e-6)
    assert list(got["is_fraud"]) == list(want["p"] >= 0.4)


def test_weight_of_positives_raises_their_scores(spark, learnable):
    feats = quality.compute_features(learnable, keep=("txn_id", "Class"))
    mean = {w: ln.predict(ln.train_gbt(feats, w, n_trees=5, max_depth=3), feats).agg(F.avg("p")).first()[0] for w in (1.0, 20.0)}
    assert mean[20.0] > 1.1 * mean[1.0]


def booster(**settings):
    return GBTClassifier(featuresCol="inputs", labelCol="Class", weightCol="w", stepSize=0.1, seed=42, checkpointInterval=2, **settings)


def nodes_of(model):
    """Every tree as {node number: (feature and threshold or None, value, weight, rows, impurity, gain)}."""
    def walk(node, k, out):
        inner = node.subtreeDepth() > 0
        split = (node.split().featureIndex(), node.split().threshold()) if inner else None
        stats = node.impurityStats()
        out[k] = (split, [node.prediction(), stats.count(), stats.rawCount(), node.impurity(), node.gain() if inner else 0.0])
        if inner:
            walk(node.leftChild(), 2 * k + 1, out)
            walk(node.rightChild(), 2 * k + 2, out)
        return out

    return [walk(tree.rootNode(), 0, {}) for tree in model._java_obj.trees()]


def test_trees_are_those_of_spark_ml(spark):
    """Large nodes of mixed labels, where no two splits gain the same."""
    frame = make_frame(4000, seed=3, frauds=1200)
    frame.loc[frame["Class"] == 1, ["V14", "V17"]] -= 0.7
    feats = quality.compute_features(spark.createDataFrame(frame, KEYED_SCHEMA), keep=("Class",))
    trees = booster(maxIter=12, maxDepth=3)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="inputs").transform(feats)
    want = trees.fit(rows.withColumn("w", F.when(F.col("Class") == 1, 8.0).otherwise(1.0)))
    got = fit_trees(feats, FEATURES, "Class", 8.0, trees)
    assert got.treeWeights == want.treeWeights and got.numFeatures == want.numFeatures == 30
    for a, b in zip(nodes_of(got), nodes_of(want), strict=True):
        assert {k: split for k, (split, _) in a.items()} == {k: split for k, (split, _) in b.items()}
        assert all(np.allclose(a[k][1], b[k][1], rtol=1e-9, atol=1e-12) for k in a)
    p, q = (m.transform(rows).select(vector_to_array("probability")[1]).toPandas().to_numpy() for m in (got, want))
    assert np.allclose(p, q, rtol=1e-9)
    assert got.extractParamMap().keys() >= {got.maxIter} and got.getMaxIter() == 12 and got.uid == trees.uid


def test_trees_do_not_depend_on_where_rows_lie(spark, learnable):
    """One task or many, in whatever order: rows alike in all features but two make many splits that tie."""
    alike = quality.compute_features(learnable, keep=("txn_id", "Class")).where("txn_id % 8 = 0").crossJoin(spark.range(6))
    feats = alike.withColumn("hour_of_day", F.col("id") * 2.0).withColumn("log_amount", F.col("id") * -1.0)
    trees, folder = booster(maxIter=5, maxDepth=6), spark.sparkContext.getCheckpointDir()
    before = set(glob.glob(f"{folder.removeprefix('file:')}/rdd-*")) if folder else set()
    fits = [
        fit_trees(feats, FEATURES, "Class", 8.0, trees),
        fit_trees(feats.repartition(3), FEATURES, "Class", 8.0, trees),
        fit_trees(feats.repartition(5, "V1"), FEATURES, "Class", 8.0, trees, most_rows=100),
    ]
    first, *others = [nodes_of(m) for m in fits]
    for other in others:
        for a, b in zip(first, other, strict=True):
            assert {k: split for k, (split, _) in a.items()} == {k: split for k, (split, _) in b.items()}
            assert all(np.allclose(a[k][1], b[k][1], rtol=1e-9, atol=1e-12) for k in a)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    assert set(glob.glob(f"{folder}/rdd-*")) <= before


def test_a_table_of_one_task_is_fitted_in_few_jobs(spark, learnable):
    feats = quality.compute_features(learnable, keep=("Class",))
    spark.sparkContext.setJobGroup("fit", "trees")
    ln.train_gbt(feats, 8.0, n_trees=10)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("fit")) < 30


@pytest.mark.parametrize("column, value", [("V3", float("nan")), ("V3", float("inf")), ("V3", None), ("Class", 2), ("Class", None)])
def test_rows_that_trees_can_not_use_are_an_error(spark, learnable, column, value):
    feats = quality.compute_features(learnable, keep=("txn_id", "Class"))
    spoilt = feats.withColumn(column, F.when(F.col("txn_id") == 7, F.lit(value)).otherwise(F.col(column)))
    with pytest.raises(Exception, match="a feature is missing, NaN or infinite|labels are 0 or 1"):
        ln.train_gbt(spoilt, 8.0, n_trees=2)


def test_trees_of_degenerate_tables(spark):
    same = spark.createDataFrame([(1.0, 0.0, k % 2) for k in range(4)], "a double, b double, Class int")
    model = fit_trees(same, ["a", "b"], "Class", 2.0, booster(maxIter=3, maxDepth=2))
    assert [len(t) for t in nodes_of(model)] == [1, 1, 1]
    flat = fit_trees(same.withColumn("a", F.rand(1)), ["a", "b"], "Class", 2.0, booster(maxIter=2, maxDepth=0))
    assert [len(t) for t in nodes_of(flat)] == [1, 1] and nodes_of(flat)[0][0][1][0] == pytest.approx(1 / 3)
    with pytest.raises(ValueError, match="no rows"):
        fit_trees(same.where("a > 1"), ["a", "b"], "Class", 2.0, booster(maxIter=2))


def test_training_run(spark, learnable, tmp_path):
    result = train_and_evaluate(learnable, n_bootstraps=10, n_trees=4, max_depth=3)
    assert result.auc_pr > 0.5
    assert result.holdout.count() == 160 and result.metrics.count() == 2
    assert result.threshold == result.best_threshold.first()["optimal_threshold"]
    assert result.best_threshold.first()["min_cost"] <= min(r["total_cost"] for r in result.candidates.collect())
    assert result.by_amount.count() > 0 and result.by_hour.count() > 0
    folder = str(tmp_path / "run")
    save_result(result, folder)
    assert files.load_threshold(spark, f"{folder}/threshold_config")["optimal_threshold"] == result.threshold
    assert spark.read.option("header", True).csv(f"{folder}/test_predictions").count() == 160

    model = PipelineModel.load(f"{folder}/model")
    assert model.stages[-1].getNumTrees == 4
    saved = spark.read.option("header", True).csv(f"{folder}/bootstrap_samples")
    assert saved.count() == 10 and set(saved.columns) == {"iteration", "auc_pr_a", "auc_pr_b", "diff"}

    # Registry first, then the local copy.
    stages = spark.createDataFrame([("m", 1, "Production")], "model_name string, version long, stage string")
    model.write().save(str(tmp_path / "registry" / "m" / "1"))
    assert load_serving_model(stages, str(tmp_path / "registry"), f"{folder}/model", "m")[1] == "registry"
    # Another model in Production is never served under this name.
    other = spark.createDataFrame([("a", 1, "Production")], stages.schema)
    both = stages.union(other)
    assert load_serving_model(both, str(tmp_path / "registry"), f"{folder}/model", "m")[1] == "registry"
    for none in (stages.where("version = 9"), None, other, stages.withColumn("version", F.lit(7))):
        assert load_serving_model(none, str(tmp_path / "registry"), f"{folder}/model", "m")[1] == "local_fallback"
    with pytest.raises(Exception):
        load_serving_model(None, "", str(tmp_path / "nothing"), "m")


def test_eda_report(spark, txn, tmp_path):
    tables = run_eda(txn, str(tmp_path / "eda"))
    assert tables["summary"].first()["n_rows"] == 200 and tables["top_effects"].count() == 10
    saved = spark.read.json(str(tmp_path / "eda" / "profile"))
    assert saved.count() == 30
    assert json.loads(spark.read.text(str(tmp_path / "eda" / "imbalance")).first()[0])["n_fraud"] == 12
