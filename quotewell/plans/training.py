"""Training, scoring and logging of the direct and the residual model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.config import EXCLUDED_FEATURES, PanelConfig, TreeParams
from quotewell.operators import forecast, metrics
from quotewell.operators.split import cutoff
from quotewell.sources import folders
from quotewell.sources.runlog import append_run_record, metric_map, run_record
from quotewell.sources.stages import Stages

NAIVE, DIRECT, RESIDUAL = "BASELINE", "DIRECT", "RESIDUAL"


@dataclass(frozen=True)
class TrainedModel:
    """A fitted model with where it is saved and what it was fitted on."""

    kind: str
    model: PipelineModel
    path: str
    features: Sequence[str]


def model_features(kind: str, cfg: PanelConfig) -> list[str]:
    if kind == RESIDUAL:
        return forecast.residual_features(cfg.model_features)
    return list(cfg.model_features)


def model_rows(split: DataFrame, kind: str, cfg: PanelConfig) -> DataFrame:
    """The residual model uses the rows that have a prior report, the direct model all rows."""
    return forecast.residual_target(split, cfg) if kind == RESIDUAL else split


def train(
    split: DataFrame, kind: str, cfg: PanelConfig, params: TreeParams, stages: Stages, path: str
) -> TrainedModel:
    """Fit on the train rows and save to ``path``.

    Rounds of the fit are saved beside it until it ends: called again after a loss of the driver,
    it goes on from the last one.
    """
    target = "residual" if kind == RESIDUAL else cfg.price
    features = model_features(kind, cfg)
    rows = model_rows(split, kind, cfg).where("is_train").select(target, *features)
    rounds = f"{path}-rounds"
    model = forecast.fit_trees(
        stages.write(rows, f"train-{kind}"), target, features, cfg, params, "model_output", rounds
    )
    forecast.save_model(model, path)
    folders.delete(split.sparkSession, rounds)
    return TrainedModel(kind, model, path, features)


def load(kind: str, cfg: PanelConfig, path: str) -> TrainedModel:
    return TrainedModel(kind, forecast.load_model(path), path, model_features(kind, cfg))


def score(trained: TrainedModel, rows: DataFrame, cfg: PanelConfig, name: str) -> DataFrame:
    """``rows`` with the predicted price as ``name``; the residual model's predicted change
    is kept as ``predicted_residual``."""
    scored = forecast.predict(trained.model, rows, trained.features, cfg)
    if trained.kind == RESIDUAL:
        changed = scored.withColumnRenamed("model_output", "predicted_residual")
        return forecast.reconstruct_price(changed, "predicted_residual", name)
    return scored.withColumnRenamed("model_output", name)


def test_rows(split: DataFrame, kind: str, cfg: PanelConfig) -> DataFrame:
    return model_rows(split, kind, cfg).where(~F.col("is_train"))


def three_way_metrics(
    split: DataFrame, residual: TrainedModel, direct: TrainedModel | None, cfg: PanelConfig
) -> DataFrame:
    """Errors of all models on the same rows; without a direct model its rows are absent."""
    rows = score(residual, test_rows(split, RESIDUAL, cfg), cfg, "residual_price")
    models = {NAIVE: "lag_1", RESIDUAL: "residual_price"}
    if direct is not None:
        rows = score(direct, rows, cfg, "direct_price")
        models[DIRECT] = "direct_price"
    return metrics.forecast_metrics(rows, cfg.price, models, cfg.commodity, cfg.scope)


def importance(spark: SparkSession, trained: TrainedModel) -> DataFrame:
    return forecast.feature_importance(
        spark, trained.model, trained.path, trained.features
    )


def log_run(
    trained: TrainedModel,
    split: DataFrame,
    scores: DataFrame,
    cfg: PanelConfig,
    params: TreeParams,
    log_path: str,
) -> None:
    """Append the run record of one model; ``scores`` holds its metric rows."""
    sizes = model_rows(split, trained.kind, cfg).agg(
        F.count_if(F.col("is_train")).alias("n_train"),
        F.count_if(~F.col("is_train")).alias("n_test"),
    )
    left_out = [name for name in cfg.model_features if name not in trained.features]
    columns = {
        "model": trained.kind,
        "model_path": trained.path,
        "cutoff": cutoff(split, cfg).select(F.col("cutoff_date").cast("string")).scalar(),
        "n_train": sizes.select("n_train").scalar(),
        "n_test": sizes.select("n_test").scalar(),
        "model_features": list(trained.features),
        "excluded_features": [*left_out, *EXCLUDED_FEATURES],
    }
    if trained.kind == RESIDUAL:
        columns["target"] = f"residual = {cfg.price} - lag_1"
        columns["inference"] = "predicted_price = lag_1 + predicted_residual"
    record = run_record(
        metric_map(scores, trained.kind),
        importance(split.sparkSession, trained),
        params=params.as_dict(),
        columns=columns,
    )
    append_run_record(record, log_path)
