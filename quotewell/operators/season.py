"""Seasonality of the training period against the test window."""

from __future__ import annotations

import calendar
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewell.config import PanelConfig
from quotewell.functions.quantiles import exact_quantiles
from quotewell.functions.scalars import percent_change, round_half_up
from quotewell.sources.stages import Stages

MONTH_LABELS = {month: calendar.month_abbr[month] for month in range(1, 13)}


def year_month_means(split: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Mean training price per commodity and year, one column per month, all twelve present."""
    dated = split.where("is_train").withColumns(
        {"year": F.year(cfg.date), "month": F.month(cfg.date)}
    )
    means = dated.groupBy(cfg.commodity, "year").pivot("month", list(MONTH_LABELS)).agg(
        F.avg(cfg.price)
    )
    return means.select(
        cfg.commodity, "year",
        *[F.col(str(month)).alias(label) for month, label in MONTH_LABELS.items()],
    )


def test_month_means(split: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Mean test price per commodity and window month; months without test rows are there as NULL.

    Commodities that have no test rows at all are there with NULL in every month.
    """
    tested = ~F.col("is_train")
    means = split.groupBy(cfg.commodity).agg(
        *[
            F.avg(
                F.when(tested & (F.month(cfg.date) == month), F.col(cfg.price))
            ).alias(str(month))
            for month in cfg.season_months
        ]
    )
    rows = [
        F.struct(
            F.lit(month).alias("month"),
            F.lit(MONTH_LABELS[month]).alias("month_label"),
            F.col(str(month)).alias("mean_price"),
        )
        for month in cfg.season_months
    ]
    return means.select(cfg.commodity, F.inline(F.array(*rows)))


def season_windows(split: DataFrame, cfg: PanelConfig, stages: Stages) -> DataFrame:
    """Statistics of the window months per commodity: one row per training year, one for test.

    The test row has no year. ``is_full`` tells whether every window month occurs.
    """
    in_window = F.month(cfg.date).isin(*cfg.season_months)
    rows = split.where("is_train is not null").select(
        cfg.commodity,
        F.when(F.col("is_train"), F.lit("train")).otherwise(F.lit("test")).alias("part"),
        F.when(F.col("is_train"), F.year(cfg.date)).otherwise(F.lit(0)).alias("year"),
        F.when(in_window, F.month(cfg.date)).alias("month"),
        F.when(in_window, F.col(cfg.price)).alias("price"),
    )
    keys = [cfg.commodity, "part", "year"]
    stats = rows.groupBy(*keys).agg(
        F.count("month").alias("n_rows"),
        F.avg("price").alias("mean"),
        F.stddev_samp("price").alias("std"),
        F.count_distinct("month").alias("months_present"),
    )
    medians = exact_quantiles(rows, "price", {"median": 0.5}, keys, stages)
    return (
        stats.where((F.col("n_rows") > 0) | (F.col("part") == "test"))
        .join(medians, keys, "left")
        .select(
            cfg.commodity, "part",
            F.when(F.col("part") == "train", F.col("year")).alias("year"),
            "n_rows", "mean", "median", "std", "months_present",
            (F.col("months_present") == len(cfg.season_months)).alias("is_full"),
        )
    )


def season_window_report(windows: DataFrame) -> DataFrame:
    """The windows with mean, median and deviation rounded to one digit, and a period label."""
    return windows.withColumns(
        {
            **{name: round_half_up(F.col(name), 1) for name in ("mean", "median", "std")},
            "period": F.when(F.col("part") == "test", F.lit("window (test)")).otherwise(
                F.concat(
                    F.lit("window "), F.col("year").cast("string"), F.lit(" (train)"),
                    F.when(F.col("is_full"), F.lit("")).otherwise(
                        F.concat(F.lit(" partial "), F.col("months_present").cast("string"))
                    ),
                )
            ),
        }
    )


def season_delta(split: DataFrame, windows: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Change of the test window against the latest full training window, and of that window
    against the whole training mean, in percent, per commodity.

    The test mean enters rounded to one digit, the training means unrounded.
    """
    full = (F.col("part") == "train") & F.col("is_full")
    sides = windows.groupBy(cfg.commodity).agg(
        F.max(F.when(full, F.col("year"))).alias("prior_year"),
        F.max_by(F.when(full, F.col("mean")), F.when(full, F.col("year"))).alias("prior_mean"),
        round_half_up(F.max(F.when(F.col("part") == "test", F.col("mean"))), 1).alias("test_mean"),
    )
    train_means = split.where("is_train").groupBy(cfg.commodity).agg(
        F.avg(cfg.price).alias("train_mean")
    )
    return (
        train_means.join(sides, cfg.commodity, "left")
        .withColumns(
            {
                "delta_pct": percent_change(F.col("test_mean"), F.col("prior_mean")),
                "prior_vs_train_pct": percent_change(F.col("prior_mean"), F.col("train_mean")),
            }
        )
    )
