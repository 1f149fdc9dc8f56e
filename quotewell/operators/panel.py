"""The daily (state, commodity, date) panel and its features."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quotewell.config import PanelConfig
from quotewell.functions.scalars import month_cos, month_sin
from quotewell.sources.stages import Stages

FIRST_DAY = "0001-01-01"


def daily_panel(quotes: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Mean price per state, commodity and date; rows with a missing key are dropped.

    Averages are combined before the shuffle, so a hot group sends one row per date and task.
    """
    keys = [*cfg.keys, cfg.date]
    complete = reduce(and_, [F.col(key).isNotNull() for key in keys])
    return quotes.where(complete).groupBy(*keys).agg(F.avg(cfg.price).alias(cfg.price))


def report_order(cfg: PanelConfig) -> WindowSpec:
    """Reports of one (state, commodity) in date order.

    The daily panel has one row per group and date, so the order is total and the largest
    group is no longer than the calendar, however skewed the quotes are.
    """
    return Window.partitionBy(*cfg.keys).orderBy(cfg.date)


def add_lags(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Price of the n-th prior report, not of n calendar days ago."""
    reports = report_order(cfg)
    return panel.withColumns({f"lag_{n}": F.lag(cfg.price, n).over(reports) for n in cfg.lags})


def add_rolling(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Mean and sample deviation of the prior reports; the current price is not in the frame."""
    columns = {}
    for size in cfg.windows:
        prior = report_order(cfg).rowsBetween(-size, -1)
        enough = F.count(cfg.price).over(prior) >= cfg.min_periods
        columns[f"rolling_mean_{size}"] = F.when(enough, F.avg(cfg.price).over(prior))
        columns[f"rolling_std_{size}"] = F.when(enough, F.stddev_samp(cfg.price).over(prior))
    return panel.withColumns(columns)


def add_calendar(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Cyclic month, weekday (Monday = 0) and day of year."""
    date = F.col(cfg.date)
    return panel.withColumns(
        {
            "month_sin": month_sin(date),
            "month_cos": month_cos(date),
            "day_of_week": F.weekday(date),
            "day_of_year": F.dayofyear(date),
        }
    )


def add_reference_ratio(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Price relative to the reference price of its commodity; NULL where there is none."""
    label = F.lower(cfg.commodity)
    ratio = F.lit(None).cast("double")
    for commodity, reference in cfg.reference_prices.items():
        ratio = F.when(label == commodity.lower(), F.col(cfg.price) / reference).otherwise(ratio)
    return panel.withColumn("price_vs_msp", ratio)


def reference_ratio(
    panel: DataFrame, references: DataFrame, cfg: PanelConfig, stages: Stages
) -> DataFrame:
    """Price relative to the reference price in force on the row's date, from a table.

    ``references`` has the panel's commodity column (any case), ``reference_price`` and, if prices
    change, ``valid_from`` (DATE): a price holds until the next one of its commodity begins; one
    without ``valid_from`` holds from the start. Before the first price, for unknown and NULL
    commodities, and for NULL or zero reference prices the ratio is NULL. Further columns are
    ignored. Two prices of one commodity from the same day on are an error. The table is staged,
    so that its true size decides between a broadcast and a shuffled join.
    """
    begins = F.col("valid_from").cast("date") if "valid_from" in references.columns \
        else F.lit(None).cast("date")
    priced = references.where(F.col(cfg.commodity).isNotNull()).select(
        F.lower(cfg.commodity).alias("ref_label"),
        F.coalesce(begins, F.lit(FIRST_DAY).cast("date")).alias("ref_begins"),
        F.col("reference_price").cast("double").alias("ref_price"),
    )
    next_begins = F.lead("ref_begins").over(Window.partitionBy("ref_label").orderBy("ref_begins"))
    staged = stages.write(priced.withColumn("ref_ends", next_begins), "references")
    repeated = staged.where("ref_begins = ref_ends").select("ref_label", "ref_begins").limit(5)
    if found := [f"{r.ref_label} from {r.ref_begins}" for r in repeated.collect()]:
        raise ValueError(f"more than one reference price: {', '.join(found)}")
    date = F.col(cfg.date)
    in_force = (F.lower(panel[cfg.commodity]) == F.col("ref_label")) \
        & (date >= F.col("ref_begins")) \
        & (F.col("ref_ends").isNull() | (date < F.col("ref_ends")))
    rated = panel.join(staged, in_force, "left")
    ratio = F.try_divide(F.col(cfg.price), F.col("ref_price"))
    kept = [name for name in panel.columns if name != "price_vs_msp"]
    return rated.select(*[panel[name] for name in kept], ratio.alias("price_vs_msp"))


def in_report_order(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Sorted for reading. The windows bring their own order and do not need it."""
    return panel.orderBy(*cfg.keys, cfg.date)


def feature_panel(
    quotes: DataFrame,
    cfg: PanelConfig,
    references: DataFrame | None = None,
    stages: Stages | None = None,
) -> DataFrame:
    """Cleaned quotes to the 17-column panel: one aggregation, then one sort for all windows.

    Reference prices are those of ``references`` if given, else those of the configuration.
    """
    panel = daily_panel(quotes, cfg)
    dated = add_calendar(add_rolling(add_lags(panel, cfg), cfg), cfg)
    if references is None:
        return add_reference_ratio(dated, cfg)
    return reference_ratio(dated, references, cfg, stages or Stages(quotes.sparkSession))
