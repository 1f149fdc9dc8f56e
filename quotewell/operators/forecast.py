"""Naive, direct and residual forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.config import PanelConfig, TreeParams
from quotewell.operators import boosting
from quotewell.operators.cleaning import in_scope
from quotewell.operators.split import with_split
from quotewell.sources import folders

# A missing value stands below all real values in one column and above them in another, so that
# each split can send missing values to the side that fits better.
BELOW, ABOVE = -1e300, 1e300


def model_split(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """The modelling scope with its temporal split; shared by audits and models."""
    return with_split(in_scope(panel, cfg.commodity, cfg.scope), cfg)


def with_prior_report(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=["lag_1"])


def naive_split(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """The naive model's own split: rows without a prior report go before the cutoff is set."""
    return model_split(with_prior_report(panel), cfg)


def naive_forecast(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Test rows with the price of the prior report as the prediction."""
    return (
        naive_split(panel, cfg)
        .where(~F.col("is_train"))
        .select(*cfg.keys, cfg.date, cfg.price, F.col("lag_1").alias("predicted"))
    )


def naive_summary(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """One row: rows dropped for want of a prior report, and the size of the naive split."""
    dropped = panel.agg(F.count_if(F.col("lag_1").isNull())).scalar()
    return naive_split(panel, cfg).agg(
        dropped.alias("n_dropped"),
        F.count("*").alias("n"),
        F.min(cfg.date).alias("date_min"),
        F.max(cfg.date).alias("date_max"),
        F.count_if(F.col("is_train")).alias("n_train"),
        F.count_if(~F.col("is_train")).alias("n_test"),
    )


def residual_target(split: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Change against the prior report; rows without one are dropped after the split."""
    return with_prior_report(split).withColumn("residual", F.col(cfg.price) - F.col("lag_1"))


def reconstruct_price(scored: DataFrame, residual: str, name: str = "predicted") -> DataFrame:
    return scored.withColumn(name, F.col("lag_1") + F.col(residual))


def residual_features(features: Sequence[str]) -> list[str]:
    return [name for name in features if name != "lag_1"]


def input_columns(train: DataFrame, features: Sequence[str], cfg: PanelConfig) -> list[str]:
    """Names of a model's inputs: one per feature, two per numeric one with missing values."""
    numeric = [name for name in features if name not in cfg.categorical_features]
    gaps = train.agg(*[
        F.count_if(_number(name).isNull()).alias(name) for name in numeric
    ]).first() if numeric else {}
    return [
        column for name in features for column in (
            [f"in_{name}", f"high_{name}"] if name in numeric and gaps[name] else [f"in_{name}"])
    ]


def _number(name: str) -> Column:
    """A numeric feature; NaN counts as missing."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def assemble_inputs(
    df: DataFrame, columns: Sequence[str], features: Sequence[str], cfg: PanelConfig
) -> DataFrame:
    """Numeric features as doubles, missing ones below or above all real values."""
    numeric = [name for name in features if name not in cfg.categorical_features]
    low = {f"in_{name}": F.coalesce(_number(name), F.lit(BELOW)) for name in numeric}
    high = {f"high_{name}": F.coalesce(_number(name), F.lit(ABOVE)) for name in numeric
            if f"high_{name}" in columns}
    return df.withColumns(low | high)


def fit_trees(
    train: DataFrame,
    target: str,
    features: Sequence[str],
    cfg: PanelConfig,
    params: TreeParams,
    prediction: str,
    folder: str,
    trees_per_round: int = boosting.TREES_PER_ROUND,
    stop_after: int | None = None,
) -> PipelineModel | None:
    """Boosted regression trees on ``target``, resumed if an earlier call was cut off.

    Category codes are fitted on ``train`` in label order. A label that train does not have
    gets a code of its own, as a missing label does. Missing numbers go to either side of a split,
    whichever leaves the smaller error. ``train`` should be a staged table. ``folder`` holds the
    saved rounds of fits, one subfolder for each combination of rows, target and parameters.
    """
    categorical = [name for name in features if name in cfg.categorical_features]
    rows = train.where(F.col(target).isNotNull())
    codes = StringIndexer(
        inputCols=categorical,
        outputCols=[f"in_{name}" for name in categorical],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    ).fit(rows)
    largest = max((len(labels) + 1 for labels in codes.labelsArray), default=0)
    columns = input_columns(rows, features, cfg)
    vector = VectorAssembler(inputCols=columns, outputCol="features")
    inputs = vector.transform(codes.transform(assemble_inputs(rows, columns, features, cfg)))
    own = boosting.fingerprint(
        rows.select(target, *features), params.as_dict(), list(features), trees_per_round)
    trees = boosting.boost(
        inputs.select("features", F.col(target).cast("double").alias("target")), params,
        max(params.max_bins, largest), f"{folder}/fit-{own}", prediction, trees_per_round,
        stop_after,
    )
    return PipelineModel([codes, vector, trees]) if trees is not None else None


def predict(
    model: PipelineModel, df: DataFrame, features: Sequence[str], cfg: PanelConfig
) -> DataFrame:
    """``df`` plus the model's prediction column."""
    name = model.stages[-1].getPredictionCol()
    columns = model.stages[-2].getInputCols()
    scored = model.transform(assemble_inputs(df, columns, features, cfg))
    return scored.select(*df.columns, name)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def saved_nodes(spark: SparkSession, model: PipelineModel, path: str) -> DataFrame:
    """The nodes of all trees of a saved model, as MLlib stores them, in ``nodeData``."""
    trees = len(model.stages) - 1
    return spark.read.parquet(f"{path}/stages/{trees}_{model.stages[trees].uid}/data")


def split_gains(spark: SparkSession, model: PipelineModel, path: str) -> DataFrame:
    """One row per split of a saved model: input position and reduction of squared error.

    A node's gain is per row, so it is multiplied by the node's rows to be comparable between
    nodes.
    """
    nodes = saved_nodes(spark, model, path)
    return nodes.where("nodeData.split.featureIndex >= 0").select(
        F.col("nodeData.split.featureIndex").alias("position"),
        (F.col("nodeData.gain") * F.col("nodeData.rawCount")).alias("gain"),
    )


def saved_rounds(spark: SparkSession, folder: str) -> list[str]:
    """The finished rounds of all fits in a folder."""
    return [path for fit in folders.names(spark, folder) if fit.startswith("fit-")
            for path in boosting.saved_rounds(spark, f"{folder}/{fit}")]


def first_split(
    spark: SparkSession, model: PipelineModel, path: str, features: Sequence[str]
) -> DataFrame:
    """The root of a saved model's first tree: feature, cut, missing_left, and its gain.

    ``missing_left`` is null where the feature had no missing values.
    """
    columns = list(model.stages[-2].getInputCols())
    names = {f"{kind}_{name}": name for name in features for kind in ("in", "high")}
    inputs = spark.createDataFrame(
        [(k, names[column],
          column.startswith("in_") if f"high_{names[column]}" in columns else None)
         for k, column in enumerate(columns)],
        "position int, feature string, missing_left boolean",
    )
    root = saved_nodes(spark, model, path).where("treeID = 0 AND nodeData.id = 0").select(
        F.col("nodeData.split.featureIndex").alias("position"),
        F.col("nodeData.split.leftCategoriesOrThreshold")[0].alias("cut"),
        (F.col("nodeData.gain") * F.col("nodeData.rawCount")).alias("gain"),
    )
    return root.join(inputs, "position").select("feature", "cut", "missing_left", "gain")


def feature_importance(
    spark: SparkSession, model: PipelineModel, path: str, features: Sequence[str]
) -> DataFrame:
    """Average gain per split of every feature, also as percent of the sum; unused ones are 0."""
    names = {f"{kind}_{name}": name for name in features for kind in ("in", "high")}
    columns = [names[column] for column in model.stages[-2].getInputCols()]
    inputs = spark.createDataFrame(list(enumerate(columns)), "position int, feature string")
    gains = (
        split_gains(spark, model, path).join(inputs, "position")
        .groupBy("feature").agg(F.avg("gain").alias("gain"))
    )
    listed = spark.createDataFrame([(name,) for name in features], "feature string")
    total = gains.agg(F.sum("gain")).scalar()
    gain = F.coalesce("gain", F.lit(0.0))
    return (
        listed.join(gains, "feature", "left")
        .select(
            "feature",
            gain.alias("gain"),
            F.coalesce(F.try_divide(gain, total) * 100, F.lit(0.0)).alias("gain_pct"),
        )
        .orderBy(F.desc("gain"), "feature")
    )
