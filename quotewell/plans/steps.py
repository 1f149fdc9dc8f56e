"""The pipeline as separate runs that hand over through tables in one folder.

Each step reads the tables of earlier steps, writes its own, and returns its report tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.config import PanelConfig, TreeParams
from quotewell.operators import charts, cleaning, forecast, metrics, panel, profile, season, split
from quotewell.plans import training
from quotewell.plans.training import DIRECT, NAIVE, RESIDUAL, TrainedModel
from quotewell.sources import runlog, tables
from quotewell.sources.schemas import (
    BASELINE_PREDICTIONS,
    CLEANED,
    DIRECT_PREDICTIONS,
    FEATURES,
)
from quotewell.sources.stages import Stages

Reports = dict[str, DataFrame]


@dataclass
class Workspace:
    """A folder of stage tables, models and run records."""

    spark: SparkSession
    folder: str
    raw_path: str | None = None
    cfg: PanelConfig = field(default_factory=PanelConfig)
    trees: TreeParams = field(default_factory=TreeParams)
    references_path: str | None = None

    def __post_init__(self) -> None:
        self.stages = Stages(self.spark)

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def raw(self) -> DataFrame:
        """The columns of the raw file that the steps use, as a stage table.

        Text files cannot be read in part, so the file is parsed once, and every report reads
        the columns it needs from the stage table.
        """
        if self.raw_path is None:
            raise ValueError("this step needs the raw quote file")
        return self.stages.once("raw", self._read_raw)

    def _read_raw(self) -> DataFrame:
        raw = cleaning.normalise_headers(tables.read_raw_quotes(self.spark, self.raw_path, self.stages))
        used = {*CLEANED.names, *self.cfg.keys, self.cfg.date, *self.cfg.price_columns}
        return raw.select(*[name for name in raw.columns if name in used])

    def references(self) -> DataFrame | None:
        """The Parquet table of reference prices, if there is one."""
        if self.references_path is None:
            return None
        return self.spark.read.parquet(self.references_path)

    def cleaned(self) -> DataFrame:
        return tables.read_table(self.spark, self.path("cleaned"), CLEANED)

    def features(self) -> DataFrame:
        return tables.read_table(
            self.spark, self.path("features"), FEATURES, partitioned_by=[self.cfg.commodity]
        )

    def split(self) -> DataFrame:
        return self.stages.once("split", lambda: forecast.model_split(self.features(), self.cfg))

    def saved_model(self, kind: str) -> TrainedModel | None:
        """A model of an earlier run, or None if that run has not been made."""
        try:
            self.spark.read.text(f"{self.path(f'model-{kind}')}/metadata")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return training.load(kind, self.cfg, self.path(f"model-{kind}"))


def clean(ws: Workspace) -> Reports:
    """Raw quote file -> table ``cleaned``."""
    cfg, raw = ws.cfg, ws.raw()
    valid = cleaning.valid_quotes(raw, cfg)
    bounds = cleaning.price_bounds(valid, cfg, ws.stages)
    kept = cleaning.remove_outliers(valid, bounds, cfg)
    tables.write_table(kept.select(*CLEANED.names), ws.path("cleaned"))
    cleaned = ws.cleaned()
    labels = cleaning.canonicalise_labels(
        raw.withColumn("raw_state", F.col(cfg.state)), cfg.state, cfg.state_aliases
    )
    return {
        "steps": cleaning.cleaning_steps(raw, bounds, cfg),
        "unreadable_dates": cleaning.unreadable_dates(raw, cfg),
        "outliers": cleaning.outlier_profile(valid, bounds, cfg),
        "label_cardinality": profile.label_cardinality(
            labels, raw_state=F.col("raw_state"), state=F.col(cfg.state)
        ),
        "top_commodities": profile.top_categories(cleaned, cfg.commodity),
        "price_summary": profile.describe(cleaned, cfg.price, [], ws.stages),
        "state_counts": profile.category_counts(cleaned, cfg.state),
        "date_span": profile.date_span(cleaned, cfg),
    }


def granularity(ws: Workspace) -> Reports:
    """Whether quotes are dense enough per market or per state."""
    covered = profile.coverage(ws.cleaned(), ws.cfg)
    return {"coverage": covered, "verdict": profile.coverage_verdict(covered, ws.cfg)}


def features(ws: Workspace) -> Reports:
    """Table ``cleaned`` -> table ``features``, one folder per commodity."""
    built = panel.feature_panel(ws.cleaned(), ws.cfg, ws.references(), ws.stages)
    built = built.select(*FEATURES.names)
    tables.write_table(built, ws.path("features"), partition_by=[ws.cfg.commodity])
    return {"nulls": profile.null_totals(ws.features())}


def verify(ws: Workspace) -> Reports:
    """Integrity of the feature panel, and three rows to look at."""
    rows = ws.features()
    keys = [*ws.cfg.keys, ws.cfg.date]
    return {
        "integrity": split.panel_integrity(rows, ws.cfg, ws.references(), ws.stages),
        "sample": profile.spot_sample(rows, keys, ws.cfg.seed),
    }


def gaps(ws: Workspace) -> Reports:
    """Where the reports of a commodity end, and whether the cleaning is to blame."""
    cfg, cleaned = ws.cfg, ws.cleaned()
    raw = cleaning.parse_date_column(ws.raw(), cfg)
    return {
        "cleaned_ranges": profile.date_ranges(cleaned, cfg, cfg.all_commodities),
        "raw_ranges": profile.date_ranges(raw, cfg, cfg.all_commodities),
        "cleaned_months": profile.monthly_rows(cleaned, cfg, cfg.gap_commodities),
        "raw_months": profile.monthly_rows(raw, cfg, cfg.gap_commodities),
        "states": profile.monthly_states(cleaned, cfg, cfg.gap_commodities),
        "verdict": profile.gap_verdict(raw, cleaned, cfg, cfg.gap_commodities),
    }


def audit(ws: Workspace) -> Reports:
    """Everything to confirm before training."""
    cfg, rows = ws.cfg, ws.split()
    return {
        "scope": split.scope_audit(rows, cfg, cfg.scope),
        "cutoff": split.cutoff(rows, cfg),
        "split": split.split_audit(rows, cfg),
        "representation": split.split_representation(rows, cfg),
        "missing_groups": split.missing_groups(rows, cfg, cfg.scope),
        "leakage": split.leakage_audit(ws.features(), cfg, cfg.model_features),
        "nulls": profile.null_audit(rows, cfg.model_features),
        "categories": split.category_plan(rows, cfg.categorical_features),
        "unseen": split.unseen_categories(rows, cfg.categorical_features),
        "distribution": profile.describe(rows, cfg.price, ["is_train"], ws.stages),
        "distribution_by_commodity": profile.describe(
            rows, cfg.price, [cfg.commodity, "is_train"], ws.stages
        ),
        "mean_shift": split.mean_shift(rows, cfg),
        "findings": split.findings(rows, cfg, cfg.model_features, cfg.scope),
    }


def seasonality(ws: Workspace) -> Reports:
    """The test window against the same months of the training years."""
    cfg, rows = ws.cfg, ws.split()
    windows = season.season_windows(rows, cfg, ws.stages)
    return {
        "year_months": season.year_month_means(rows, cfg),
        "test_months": season.test_month_means(rows, cfg),
        "windows": season.season_window_report(windows),
        "delta": season.season_delta(rows, windows, cfg),
    }


def baseline(ws: Workspace) -> Reports:
    """Naive forecast -> table ``baseline_predictions``."""
    cfg, rows = ws.cfg, ws.features()
    tables.write_baseline_predictions(
        forecast.naive_forecast(rows, cfg), ws.path("baseline_predictions")
    )
    scored = tables.read_table(ws.spark, ws.path("baseline_predictions"), BASELINE_PREDICTIONS)
    return {
        "summary": forecast.naive_summary(rows, cfg),
        "missing_groups": split.missing_groups(forecast.naive_split(rows, cfg), cfg, cfg.scope),
        "metrics": metrics.forecast_metrics(
            scored, cfg.price, {NAIVE: "predicted"}, cfg.commodity, cfg.scope
        ),
    }


def direct(ws: Workspace) -> Reports:
    """Train the direct model, save it with its predictions, and log the run."""
    cfg, rows = ws.cfg, ws.split()
    trained = training.train(
        rows, DIRECT, cfg, ws.trees, ws.stages, ws.path(f"model-{DIRECT}")
    )
    scored = training.score(trained, training.test_rows(rows, DIRECT, cfg), cfg, "predicted")
    scored = ws.stages.write(scored, "direct-scored")
    tables.write_direct_predictions(scored, ws.path("direct_predictions"), cfg)
    scores = metrics.forecast_metrics(
        scored, cfg.price, {NAIVE: "lag_1", DIRECT: "predicted"}, cfg.commodity, cfg.scope
    )
    training.log_run(trained, rows, scores, cfg, ws.trees, ws.path("run_log"))
    compared = metrics.compare_models(scores, NAIVE, DIRECT)
    saved = tables.saved_row_count(
        ws.spark, ws.path("baseline_predictions"), BASELINE_PREDICTIONS
    )
    return {
        "metrics": scores,
        "comparison": compared,
        "verdict": metrics.beats_base(compared, "mape_pct_imp_pct"),
        "importance": training.importance(ws.spark, trained),
        "unseen": split.unseen_categories(rows, cfg.categorical_features),
        "saved_baseline_rows": ws.spark.createDataFrame([(saved,)], "n bigint"),
    }


def residual(ws: Workspace) -> Reports:
    """Train the residual model, log the run, and compare all models on the same rows."""
    cfg, rows = ws.cfg, ws.split()
    trained = training.train(
        rows, RESIDUAL, cfg, ws.trees, ws.stages, ws.path(f"model-{RESIDUAL}")
    )
    scores = ws.stages.write(
        training.three_way_metrics(rows, trained, ws.saved_model(DIRECT), cfg), "scores"
    )
    training.log_run(trained, rows, scores, cfg, ws.trees, ws.path("run_log"))
    logged = runlog.logged_metrics(runlog.read_run_records(ws.spark, ws.path("run_log")))
    compared = metrics.compare_three(scores, NAIVE, DIRECT, RESIDUAL)
    targets = forecast.residual_target(rows, cfg).where("is_train")
    predicted = training.score(
        trained, training.test_rows(rows, RESIDUAL, cfg), cfg, "predicted"
    )
    return {
        "target_summary": profile.describe(targets, "residual", [], ws.stages),
        "price_summary": profile.describe(predicted, "predicted", [], ws.stages),
        "comparison": compared,
        "verdict": metrics.beats_base(
            compared, "mae_resid_vs_base_pct", "mape_pct_resid_vs_base_pct"
        ),
        "cross_check": metrics.cross_check(scores, logged, DIRECT),
        "importance": training.importance(ws.spark, trained),
    }


def chart_tables(ws: Workspace) -> Reports:
    """The tables behind the charts; predictions and importances need the trained models."""
    cfg, cleaned = ws.cfg, ws.cleaned()
    scored = tables.read_table(ws.spark, ws.path("direct_predictions"), DIRECT_PREDICTIONS)
    records = runlog.read_run_records(ws.spark, ws.path("run_log"))
    return {
        "price_trends": charts.price_trends(cleaned, cfg),
        "monthly_seasonality": charts.monthly_seasonality(cleaned, cfg),
        "split_daily": charts.split_daily(ws.split(), cfg),
        "prediction_extent": charts.prediction_extent(
            scored, cfg, "actual_modal_price", "predicted_modal_price"
        ),
        "importance": runlog.logged_importance(records),
    }


STEPS: dict[str, Callable[[Workspace], Reports]] = {
    "clean": clean,
    "granularity": granularity,
    "features": features,
    "verify": verify,
    "gaps": gaps,
    "audit": audit,
    "seasonality": seasonality,
    "baseline": baseline,
    "direct": direct,
    "residual": residual,
    "charts": chart_tables,
}
