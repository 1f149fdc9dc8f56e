"""The stages of the forecasting pipeline over one source, each written once per session."""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from quotewell.config import PanelConfig, TreeParams
from quotewell.operators import cleaning, forecast, panel
from quotewell.plans import training
from quotewell.plans.training import DIRECT, RESIDUAL, TrainedModel
from quotewell.sources.stages import Stages


class Pipeline:
    """Raw quotes -> cleaned quotes -> feature panel -> split -> models.

    Cleaned quotes and the feature panel are Parquet tables in the shared folder: the wide
    source is read for them only, and every report and model starts from the smaller table.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: DataFrame,
        cfg: PanelConfig,
        trees: TreeParams | None = None,
        stages: Stages | None = None,
    ):
        self.spark = spark
        self.raw = raw
        self.cfg = cfg
        self.trees = trees or TreeParams()
        self.stages = stages or Stages(spark)
        self._models: dict[str, TrainedModel] = {}
        self._lock = threading.RLock()

    @property
    def dated(self) -> DataFrame:
        """Raw quotes with normalised headers and typed dates."""
        return cleaning.parse_date_column(cleaning.normalise_headers(self.raw), self.cfg)

    @property
    def valid(self) -> DataFrame:
        return cleaning.valid_quotes(self.raw, self.cfg)

    @cached_property
    def bounds(self) -> DataFrame:
        return cleaning.price_bounds(self.valid, self.cfg, self.stages)

    @property
    def cleaned(self) -> DataFrame:
        return self.stages.once(
            "cleaned",
            lambda: cleaning.remove_outliers(self.valid, self.bounds, self.cfg).drop(
                self.cfg.low_price, self.cfg.high_price
            ),
        )

    @property
    def features(self) -> DataFrame:
        """The feature panel, in one folder per commodity: scope filters skip whole folders."""
        return self.stages.once(
            "features",
            lambda: panel.feature_panel(self.cleaned, self.cfg),
            partition_by=[self.cfg.commodity],
        )

    @property
    def split(self) -> DataFrame:
        """The scope rows of the feature panel with ``is_train``."""
        return self.stages.once("split", lambda: forecast.model_split(self.features, self.cfg))

    @property
    def residual_split(self) -> DataFrame:
        """The rows all models are compared on: those of the split that have a prior report."""
        return forecast.residual_target(self.split, self.cfg)

    def train(self, *kinds: str) -> None:
        """Fit and save those of the models that are not fitted yet, at the same time.

        The trees of a model come one after the other, so a single fit leaves a cluster idle.
        """
        with self._lock:
            missing = [kind for kind in kinds if kind not in self._models]
            if not missing:
                return
            # The threads take no lock that this one may hold.
            split = self.split
            paths = [self.stages.path(f"model-{kind}") for kind in missing]

            def fitted(kind: str, path: str) -> TrainedModel:
                return training.train(split, kind, self.cfg, self.trees, self.stages, path)

            with ThreadPoolExecutor(len(missing)) as pool:
                models = pool.map(inheritable_thread_target(self.spark)(fitted), missing, paths)
                self._models.update(zip(missing, models, strict=True))

    def trained(self, kind: str) -> TrainedModel:
        """The direct or the residual model, fitted and saved on first use."""
        self.train(kind)
        return self._models[kind]

    def predictions(self, kind: str) -> DataFrame:
        """The model's test rows with its ``predicted`` price, scored once per session."""
        def scored() -> DataFrame:
            rows = training.test_rows(self.split, kind, self.cfg)
            return training.score(self.trained(kind), rows, self.cfg, "predicted")

        return self.stages.once(f"scored-{kind}", scored)

    def three_way_metrics(self) -> DataFrame:
        """Errors of all three models on the same rows, scored once per session.

        The direct model is read from disk.
        """
        self.train(DIRECT, RESIDUAL)

        def scored() -> DataFrame:
            direct = training.load(DIRECT, self.cfg, self.trained(DIRECT).path)
            return training.three_way_metrics(
                self.split, self.trained(RESIDUAL), direct, self.cfg)

        return self.stages.once("three-way", scored)

    def importance(self, kind: str) -> DataFrame:
        return training.importance(self.spark, self.trained(kind)).withColumn(
            "model", F.lit(kind)
        )

    def log_run(self, kind: str, scores: DataFrame, log_path: str) -> None:
        training.log_run(
            self.trained(kind), self.split, scores, self.cfg, self.trees, log_path
        )
