"""Counts, distributions, missing values and coverage of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.config import PanelConfig
from quotewell.functions.quantiles import summary
from quotewell.functions.scalars import month_start, round_half_up, to_number
from quotewell.sources.stages import Stages


def category_counts(df: DataFrame, column: str, keep_missing: bool = False) -> DataFrame:
    """Rows per label, most frequent first; the missing label only on request."""
    rows = df if keep_missing else df.where(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def top_categories(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent labels; ties are broken by label."""
    return category_counts(df, column).limit(k)


def labels_long(df: DataFrame, **columns: Column) -> DataFrame:
    """Several label columns below each other: (name, label), one row per input row and name."""
    pairs = [
        F.struct(F.lit(name).alias("name"), label.alias("label"))
        for name, label in columns.items()
    ]
    return df.select(F.inline(F.array(*pairs)))


def label_cardinality(df: DataFrame, **columns: Column) -> DataFrame:
    """Distinct labels per column, without and with the missing label, and the row count."""
    counted = labels_long(df, **columns).groupBy("name", "label").agg(F.count("*").alias("n"))
    return counted.groupBy("name").agg(
        F.count("label").alias("n_labels"),
        F.count("*").alias("n_labels_with_missing"),
        F.sum("n").alias("n_rows"),
    )


def date_ranges(df: DataFrame, cfg: PanelConfig, commodities: Sequence[str]) -> DataFrame:
    """Rows and first and last date of each listed commodity."""
    return (
        df.where(F.col(cfg.commodity).isin(*commodities))
        .groupBy(cfg.commodity)
        .agg(
            F.count("*").alias("n"),
            F.min(cfg.date).alias("first_date"),
            F.max(cfg.date).alias("last_date"),
        )
    )


def date_span(df: DataFrame, cfg: PanelConfig) -> DataFrame:
    """First and last date and the days between them, in one row."""
    return df.agg(
        F.min(cfg.date).alias("date_min"),
        F.max(cfg.date).alias("date_max"),
        F.datediff(F.max(cfg.date), F.min(cfg.date)).alias("total_days"),
    )


def describe(df: DataFrame, value: str, by: Sequence[str], stages: Stages) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of one column per group."""
    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    found = summary(df.select(*by, value), value, probs, by, stages)
    return found.select(*by, "n", "mean", "std", "min", *probs, "max")


def coverage(quotes: DataFrame, cfg: PanelConfig) -> DataFrame:
    """How densely groups cover the date span, at market and at state level.

    One scan serves both levels. A group's days are bits of words of 64 days each, set where the
    rows are read and merged by OR, so that a task sends one row per group and word and not one
    per group and day. The median runs over at most as many different values as the span has days.
    """
    day = F.unix_date(cfg.date)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), day.bitwiseAND(63))
    levels = F.array(
        F.struct(F.lit("market_commodity").alias("granularity"), F.col(cfg.market).alias("place")),
        F.struct(F.lit("state_commodity").alias("granularity"), F.col(cfg.state).alias("place")),
    )
    groups = (
        quotes.select(F.inline(levels), cfg.commodity, cfg.date)
        .groupBy("granularity", "place", cfg.commodity, F.shiftright(day, 6).alias("word"))
        .agg(
            F.bit_or(bit).alias("days"),
            F.min(cfg.date).alias("first_date"),
            F.max(cfg.date).alias("last_date"),
        )
        .groupBy("granularity", "place", cfg.commodity)
        .agg(
            F.coalesce(F.sum(F.bit_count("days")), F.lit(0)).alias("n_dates"),
            F.min("first_date").alias("first_date"),
            F.max("last_date").alias("last_date"),
        )
    )
    named = F.col("place").isNotNull() & F.col(cfg.commodity).isNotNull()
    return (
        groups.groupBy("granularity")
        .agg(
            F.percentile(F.when(named, F.col("n_dates")), 0.5).alias("median_dates"),
            F.datediff(F.max("last_date"), F.min("first_date")).alias("total_days"),
            F.count_if(named).alias("n_groups"),
        )
        .withColumn("pct", F.try_divide("median_dates", "total_days") * 100)
        .select("granularity", "median_dates", "total_days", "pct", "n_groups")
    )


def coverage_verdict(covered: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Per level: near the expected coverage, dense enough for lags, and which level to use."""
    levels = {
        "market_commodity": cfg.market_ballpark_pct,
        "state_commodity": cfg.state_ballpark_pct,
    }
    wide = covered.agg(
        *[
            F.max(F.when(F.col("granularity") == level, F.col("pct"))).alias(level)
            for level in levels
        ]
    )
    market_viable = F.col("market_commodity") >= cfg.viable_pct
    state_viable = F.col("state_commodity") >= cfg.viable_pct
    recommendation = (
        F.when(market_viable, "market_commodity")
        .when(state_viable, "state_commodity")
        .otherwise("resample")
    )
    rows = [
        F.struct(
            F.lit(level).alias("granularity"),
            F.col(level).alias("pct"),
            F.lit(ballpark).alias("ballpark_pct"),
            (F.abs(F.col(level) - ballpark) > cfg.ballpark_tolerance).alias("flagged"),
            (F.col(level) >= cfg.viable_pct).alias("viable"),
            recommendation.alias("recommendation"),
        )
        for level, ballpark in levels.items()
    ]
    return wide.select(F.inline(F.array(*rows)))


def monthly_rows(df: DataFrame, cfg: PanelConfig, commodities: Sequence[str]) -> DataFrame:
    """Rows per commodity and month; undated rows do not count."""
    return (
        df.where(F.col(cfg.commodity).isin(*commodities) & F.col(cfg.date).isNotNull())
        .groupBy(cfg.commodity, month_start(F.col(cfg.date)).alias("month"))
        .agg(F.count("*").alias("n"))
    )


def monthly_states(df: DataFrame, cfg: PanelConfig, commodities: Sequence[str]) -> DataFrame:
    """Distinct reporting states per commodity and month."""
    return (
        df.where(F.col(cfg.commodity).isin(*commodities) & F.col(cfg.date).isNotNull())
        .groupBy(cfg.commodity, month_start(F.col(cfg.date)).alias("month"))
        .agg(F.count_distinct(cfg.state).alias("n_states"))
    )


def gap_verdict(
    raw: DataFrame, cleaned: DataFrame, cfg: PanelConfig, commodities: Sequence[str]
) -> DataFrame:
    """Whether a commodity's reports end in the source already or through the cleaning."""

    def last_dates(df: DataFrame, name: str) -> DataFrame:
        return date_ranges(df, cfg, commodities).select(
            cfg.commodity, F.col("last_date").alias(name)
        )

    return (
        last_dates(raw, "raw_last_date")
        .join(last_dates(cleaned, "cleaned_last_date"), cfg.commodity, "left")
        .withColumn(
            "gap_source",
            F.when(F.col("raw_last_date") == F.col("cleaned_last_date"), "raw data")
            .otherwise("pipeline"),
        )
    )


def null_totals(df: DataFrame) -> DataFrame:
    """Missing values per column of the whole table, in one pass."""
    counts = df.agg(
        *[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns]
    )
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("column_name"), F.col(name).alias("n_null"))
                    for name in df.columns
                ]
            )
        )
    )


def null_audit(split: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values per column with type, in train and in test, in one pass."""
    parts = {"train": F.col("is_train"), "test": ~F.col("is_train")}
    counts = split.agg(
        *[F.count_if(part).alias(f"rows_{tag}") for tag, part in parts.items()],
        *[
            F.count_if(part & F.col(name).isNull()).alias(f"{name}_{tag}")
            for tag, part in parts.items()
            for name in columns
        ],
    )
    types = dict(split.dtypes)

    def row(name: str) -> Column:
        fields = [F.lit(name).alias("feature"), F.lit(types[name]).alias("type")]
        for tag in parts:
            nulls = F.col(f"{name}_{tag}")
            share = F.try_divide(nulls, F.col(f"rows_{tag}")) * 100
            fields += [
                nulls.alias(f"nulls_{tag}"),
                round_half_up(share, 2).alias(f"nulls_{tag}_pct"),
            ]
        return F.struct(*fields)

    return counts.select(F.inline(F.array(*[row(name) for name in columns])))


def text_in_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cells of text columns that should be numbers and are not, per column."""
    return df.agg(
        *[
            F.count_if(F.col(name).isNotNull() & to_number(F.col(name)).isNull()).alias(name)
            for name in columns
        ]
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("column_name"), F.col(name).alias("n_text"))
                    for name in columns
                ]
            )
        )
    )


def spot_sample(df: DataFrame, keys: Sequence[str], seed: int, n: int = 3) -> DataFrame:
    """``n`` rows in the order of a seeded hash of their keys: the same rows on every run."""
    texts = [F.col(key).cast("string") for key in keys]
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *texts))).limit(n)
