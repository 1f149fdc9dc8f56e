"""Boosted regression trees fitted in saved rounds.

A round fits some trees to what the rounds before it have left of the target, and its trees and the
new residuals are saved in the shared folder. A fit that is called again with the same rows, target
and parameters goes on from the last saved round, so that a lost driver costs one round at most.
Within a round the first tree counts in full and the others with the learning rate, as in any
single fit of this kind.

A table of at most ``TASK_CELLS`` inputs is fitted in one task, which holds it in bins
(``histograms``): MLlib runs a job for every level of every tree, and on such a table nearly all its
time goes to starting them. Larger tables are fitted by MLlib.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    GBTRegressionModel,
    GBTRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.config import TreeParams
from quotewell.operators import histograms
from quotewell.sources import folders
from quotewell.sources.stages import ensure_checkpoint_dir

TREES_PER_ROUND = 100
TREES_PER_CHECKPOINT = 50
HISTOGRAM_MB = 1024  # memory for the histograms of one pass
TASK_CELLS = 1 << 24  # rows times inputs that one task fits, at 8 bytes until they are binned


def fingerprint(rows: DataFrame, *about: object) -> str:
    """Short digest of the rows, in any order, and of whatever else decides a fit."""
    hashed = F.xxhash64(*rows.columns)
    found = rows.agg(
        F.count("*"), F.bit_xor(hashed), F.sum(F.pmod(hashed, F.lit(1 << 31)))
    ).first()
    text = json.dumps([list(found), rows.columns, *about], default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def saved_rounds(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the rounds that a fit in this folder has finished, the first one first."""
    return [f"{folder}/{name}" for name in folders.names(spark, folder)
            if name.startswith("round-")]


def _ensemble(
    spark: SparkSession,
    trees: list[DecisionTreeRegressionModel],
    weights: list[float],
    prediction: str,
) -> GBTRegressionModel:
    """A model of given trees and weights."""
    gateway = spark.sparkContext._gateway
    kind = spark._jvm.org.apache.spark.ml.regression
    listed = gateway.new_array(kind.DecisionTreeRegressionModel, len(trees))
    weighted = gateway.new_array(gateway.jvm.double, len(trees))
    for k, (tree, weight) in enumerate(zip(trees, weights, strict=True)):
        listed[k], weighted[k] = tree._java_obj, float(weight)
    java = kind.GBTRegressionModel(
        f"boosted_{uuid.uuid4().hex[:12]}", listed, weighted, trees[0].numFeatures)
    return GBTRegressionModel(java).setPredictionCol(prediction)


def _arity(rows: DataFrame) -> dict[int, int]:
    """The number of labels of the inputs that are codes of labels, by position."""
    kinds = rows.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    labelled = {item["idx"]: item.get("num_vals") or len(item.get("vals", ()))
                for item in kinds.get("nominal", ())}
    return {at: n for at, n in labelled.items() if n} | {
        item["idx"]: 2 for item in kinds.get("binary", ())}


def _fit_in_task(
    regressor: GBTRegressor, rows: DataFrame, n_features: int, path: str
) -> GBTRegressionModel:
    """Fit in one task and save to ``path``, in the files that MLlib would write."""
    spark = rows.sparkSession
    trees, depth = regressor.getMaxIter(), regressor.getMaxDepth()
    fit = histograms.fitter(
        n_features, _arity(rows), regressor.getMaxBins(), trees, depth, regressor.getStepSize())
    held = rows.select(vector_to_array("features").alias("inputs"), "residual",
                       F.spark_partition_id().alias("part"))
    held.coalesce(1).mapInArrow(fit, histograms.NODE_SCHEMA).write.parquet(f"{path}/data")

    def about(kind: str, uid: str, names: list[str], **more: object) -> str:
        return json.dumps({
            "class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000),
            "sparkVersion": spark.version, "uid": f"{uid}_{uuid.uuid4().hex[:12]}",
            "paramMap": {name: regressor.getOrDefault(name) for name in names},
            "defaultParamMap": {}, **more,
        })

    shared = [
        "featuresCol", "labelCol", "predictionCol", "impurity", "maxBins", "maxDepth", "seed"]
    weights = [1.0] + [regressor.getStepSize()] * (trees - 1)
    spark.createDataFrame(
        [(k, about("DecisionTreeRegressionModel", "dtr", shared), weight)
         for k, weight in enumerate(weights)], "_1 int, _2 string, _3 double",
    ).coalesce(1).write.parquet(f"{path}/treesMetadata")
    ensemble = about(
        "GBTRegressionModel", "gbtr", [*shared, "maxIter", "stepSize", "lossType"],
        numFeatures=n_features, numTrees=trees)
    spark.createDataFrame([(ensemble,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return GBTRegressionModel.load(path)


def boost(
    rows: DataFrame,
    params: TreeParams,
    max_bins: int,
    folder: str,
    prediction: str,
    trees_per_round: int = TREES_PER_ROUND,
    stop_after: int | None = None,
) -> GBTRegressionModel | None:
    """Fit ``params.n_trees`` trees to ``rows`` (features, target), with saved rounds in ``folder``.

    ``rows`` should be a staged table; later rounds read the saved residuals instead. ``folder``
    belongs to this fit alone (see ``fingerprint``); finished rounds in it are not fitted again.
    ``stop_after`` ends the call once so many rounds are saved, without a model. Residuals are
    removed as soon as the next round is saved.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    total = -(-params.n_trees // trees_per_round)
    done = saved_rounds(spark, folder)
    n_features = rows.schema["features"].metadata["ml_attr"]["num_attrs"]
    in_task = len(done) < total and rows.count() * n_features <= TASK_CELLS
    for number in range(len(done), total):
        if stop_after is not None and number >= stop_after:
            return None
        current = (
            spark.read.parquet(f"{done[-1]}/rows") if done
            else rows.select("features", F.col("target").alias("residual"))
        )
        regressor = GBTRegressor(
            featuresCol="features",
            labelCol="residual",
            predictionCol="step",
            maxIter=min(trees_per_round, params.n_trees - number * trees_per_round),
            maxDepth=params.max_depth,
            stepSize=params.learning_rate,
            maxBins=max_bins,
            lossType="squared",
            seed=params.seed,
            checkpointInterval=TREES_PER_CHECKPOINT,
            maxMemoryInMB=HISTOGRAM_MB,
        )
        staged = f"{folder}/writing-{uuid.uuid4().hex}"
        if in_task:
            part = _fit_in_task(regressor, current, n_features, f"{staged}/model")
        else:
            part = regressor.fit(current)
            part.write().save(f"{staged}/model")
        if number + 1 < total:
            left = F.col("residual") - F.col("step")
            part.transform(current).select("features", left.alias("residual")).write.parquet(
                f"{staged}/rows")
        final = f"{folder}/round-{number:05d}"
        folders.commit(spark, staged, final)
        if done:
            folders.delete(spark, f"{done[-1]}/rows")
        done.append(final)
    parts = [GBTRegressionModel.load(f"{path}/model") for path in done]
    return _ensemble(
        spark, [tree for part in parts for tree in part.trees],
        [weight for part in parts for weight in part.treeWeights], prediction,
    )
