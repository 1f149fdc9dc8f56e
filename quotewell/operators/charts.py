"""Tables behind the charts. Drawing them is left to the reader's own tool."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewell.config import PanelConfig
from quotewell.operators.cleaning import in_scope


def price_trends(quotes: DataFrame, cfg: PanelConfig) -> DataFrame:
    """National mean price per date and commodity."""
    rows = in_scope(quotes, cfg.commodity, cfg.all_commodities).where(F.col(cfg.date).isNotNull())
    return rows.groupBy(cfg.date, cfg.commodity).agg(F.avg(cfg.price).alias("mean_price"))


def monthly_seasonality(quotes: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Mean price per calendar month and commodity."""
    rows = in_scope(quotes, cfg.commodity, cfg.all_commodities).where(F.col(cfg.date).isNotNull())
    return rows.groupBy(F.month(cfg.date).alias("month"), cfg.commodity).agg(
        F.avg(cfg.price).alias("mean_price")
    )


def split_daily(split: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Daily mean over all places and commodities, marked as train or test."""
    return split.groupBy("is_train", cfg.date).agg(F.avg(cfg.price).alias("mean_price"))


def prediction_extent(
    scored: DataFrame, cfg: PanelConfig, actual: str, predicted: str
) -> DataFrame:
    """Smallest and largest of actual and predicted price per commodity."""
    return scored.groupBy(cfg.commodity).agg(
        F.least(F.min(actual), F.min(predicted)).alias("low"),
        F.greatest(F.max(actual), F.max(predicted)).alias("high"),
    )
