"""From raw quotes to cleaned quotes."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewell.config import PanelConfig
from quotewell.functions.quantiles import exact_quantiles
from quotewell.functions.scalars import (
    all_numbers,
    equals_ignoring_case,
    normalise_name,
    round_half_up,
    strip,
    to_date,
    to_number,
)
from quotewell.sources.schemas import require_columns
from quotewell.sources.stages import Stages


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalise_name(name) for name in df.columns])


def _lacks(df: DataFrame, column: str, step: str) -> bool:
    """Whether an optional step has to be skipped for want of its column; says so if it has."""
    if column in df.columns:
        return False
    warnings.warn(f"no column {column!r}: {step} skipped", stacklevel=3)
    return True


def parse_date_column(df: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Text dates to DATE; rows whose date cannot be read are kept with NULL.

    A column that is a date or a timestamp already is only brought to DATE.
    """
    if _lacks(df, cfg.date, "date parsing"):
        return df
    date = F.col(cfg.date)
    if isinstance(df.schema[cfg.date].dataType, T.StringType):
        return df.withColumn(cfg.date, to_date(date, cfg.date_formats))
    return df.withColumn(cfg.date, date.cast("date"))


def unreadable_dates(raw: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Rows per form of a date text that no format fits: digits as 9, letters as a."""
    text = F.col(cfg.date).cast("string")
    form = F.regexp_replace(F.regexp_replace(text, "[0-9]", "9"), "[A-Za-z]", "a")
    return (
        normalise_headers(raw)
        .where(text.isNotNull() & to_date(text, cfg.date_formats).isNull())
        .groupBy(form.alias("form"))
        .agg(F.count("*").alias("n"))
    )


def coerce_prices(df: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Text prices to DOUBLE; a row with any unreadable price is dropped."""
    require_columns(df, cfg.price_columns)
    numeric = df.withColumns({name: to_number(F.col(name)) for name in cfg.price_columns})
    return numeric.na.drop(subset=cfg.price_columns)


def price_rules(cfg: PanelConfig) -> Column:
    """min <= max, min <= modal <= max (inclusive), and every price above zero.

    0 < min <= modal <= max says all of it with each price read as few times as possible,
    which matters because Catalyst repeats the parsing expression wherever a price occurs.
    A missing price makes the rule NULL, so the row fails it.
    """
    low, high, modal = (F.col(name) for name in cfg.price_columns)
    return (low > 0) & (low <= modal) & (modal <= high)


def drop_invalid_prices(df: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Numeric prices of the rows that have three readable prices and keep the price rules."""
    require_columns(df, cfg.price_columns)
    readable = df.where(all_numbers(*cfg.price_columns))
    numeric = readable.withColumns(
        {name: F.col(name).try_cast("double") for name in cfg.price_columns}
    )
    return numeric.where(price_rules(cfg))


def blank_to_missing(df: DataFrame, column: str) -> DataFrame:
    """Empty text to NULL, as it is in a quote file. A table is not stored by an empty label."""
    if _lacks(df, column, "marking blank labels"):
        return df
    return df.withColumn(column, F.nullif(F.col(column), F.lit("")))


def drop_category(df: DataFrame, column: str, label: str) -> DataFrame:
    """Drop one category in any letter case; rows without a category stay."""
    if _lacks(df, column, f"dropping {label}"):
        return df
    return df.where(~equals_ignoring_case(F.col(column), label))


def in_scope(df: DataFrame, column: str, labels: Iterable[str]) -> DataFrame:
    return df.where(F.col(column).isin(*labels))


def in_scope_ignoring_case(df: DataFrame, column: str, labels: Iterable[str]) -> DataFrame:
    return df.where(F.lower(column).isin(*[label.lower() for label in labels]))


def in_months(df: DataFrame, date: str, months: Iterable[int]) -> DataFrame:
    return df.where(F.month(date).isin(*months))


def canonicalise_labels(
    df: DataFrame, column: str, aliases: Mapping[str, str] | DataFrame
) -> DataFrame:
    """Strip labels and merge known spellings; unknown labels pass, no row is added or lost.

    ``aliases`` is a dictionary, which becomes part of the plan, or a staged table (alias,
    canonical) with unique aliases, which Catalyst broadcasts only when its files are small.
    """
    if _lacks(df, column, "label merging"):
        return df
    stripped = strip(F.col(column))
    if not isinstance(aliases, DataFrame):
        if not aliases:
            return df.withColumn(column, stripped)
        entries = F.create_map(*[F.lit(text) for pair in aliases.items() for text in pair])
        return df.withColumn(column, F.coalesce(F.try_element_at(entries, stripped), stripped))
    return (
        df.withColumn(column, stripped)
        .join(aliases, F.col(column) == F.col("alias"), "left")
        .withColumn(column, F.coalesce("canonical", column))
        .select(*df.columns)
    )


def price_bounds(valid: DataFrame, cfg: PanelConfig, stages: Stages) -> DataFrame:
    """Per commodity the exact quartiles of the price and the asymmetric outlier bounds.

    The result is a staged table, so joins against it are planned by its true size.
    """
    quartiles = exact_quantiles(
        valid, cfg.price, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [cfg.commodity], stages
    )
    spread = F.col("q3") - F.col("q1")
    return stages.write(
        quartiles.withColumns(
            {
                "lower_bound": F.col("q1") - cfg.lower_iqr_factor * spread,
                "upper_bound": F.col("q3") + cfg.upper_iqr_factor * spread,
            }
        ),
        "price-bounds",
    )


def outlier_profile(valid: DataFrame, bounds: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Upper bound, median and number of rows above the bound, per commodity."""
    limits = bounds.select(cfg.commodity, "upper_bound", "median")
    return (
        valid.select(cfg.commodity, cfg.price)
        .join(limits, cfg.commodity)
        .groupBy(cfg.commodity)
        .agg(
            round_half_up(F.max("upper_bound"), 2).alias("upper_bound"),
            round_half_up(F.max("median"), 2).alias("median"),
            F.count_if(F.col(cfg.price) > F.col("upper_bound")).alias("outlier_rows"),
        )
    )


def remove_outliers(valid: DataFrame, bounds: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Keep prices within the bounds of their commodity; rows without a commodity drop out."""
    limits = bounds.select(cfg.commodity, "lower_bound", "upper_bound")
    return (
        valid.join(limits, cfg.commodity)
        .where(F.col(cfg.price).between(F.col("lower_bound"), F.col("upper_bound")))
        .select(*valid.columns)
    )


def valid_quotes(raw: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Every cleaning step before the outlier filter, as one projection and filter."""
    dated = parse_date_column(normalise_headers(raw), cfg)
    priced = drop_invalid_prices(dated, cfg)
    labelled = blank_to_missing(priced, cfg.commodity)
    kept = drop_category(labelled, cfg.commodity, cfg.dropped_commodity)
    return canonicalise_labels(kept, cfg.state, cfg.state_aliases)


def clean_quotes(raw: DataFrame, cfg: PanelConfig, stages: Stages) -> DataFrame:
    """The whole cleaning pipeline; the wide rows are filtered in place and never shuffled."""
    valid = valid_quotes(raw, cfg)
    if not _lacks(valid, cfg.commodity, "outlier removal"):
        valid = remove_outliers(valid, price_bounds(valid, cfg, stages), cfg)
    return valid.drop(cfg.low_price, cfg.high_price)


def cleaning_steps(raw: DataFrame, bounds: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Rows left after each cleaning step, counted in one pass: (step, n)."""
    numeric = normalise_headers(raw).select(
        cfg.commodity, *[to_number(F.col(name)).alias(name) for name in cfg.price_columns]
    ).join(bounds.select(cfg.commodity, "lower_bound", "upper_bound"), cfg.commodity, "left")
    valid = price_rules(cfg)
    kept = valid & ~equals_ignoring_case(F.col(cfg.commodity), cfg.dropped_commodity)
    within = F.col(cfg.price).between(F.col("lower_bound"), F.col("upper_bound"))
    steps = {
        "raw": F.lit(True),
        "price rules": valid,
        "category drop": kept,
        "outlier removal": kept & within,
    }
    counts = numeric.agg(*[F.count_if(left).alias(step) for step, left in steps.items()])
    return counts.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(step).alias("step"), F.col(step).alias("n")) for step in steps]
            )
        )
    )
