"""Temporal split and the audits that precede training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewell.config import PanelConfig
from quotewell.functions.scalars import (
    close_to,
    date_micros,
    micros_to_date,
    month_cos,
    month_sin,
    percent_change,
    round_half_up,
)
from quotewell.operators.panel import reference_ratio
from quotewell.operators.profile import labels_long
from quotewell.sources.schemas import FEATURES, schema_problems
from quotewell.sources.stages import Stages


def cutoff(df: DataFrame, cfg: PanelConfig) -> DataFrame:
    """One row: date range and the moment at the train share of the elapsed span.

    The cutoff is a point in time (microseconds since 1970), usually within a day; it is a
    share of the span of dates, not of the rows.
    """
    first, last = date_micros(F.min(cfg.date)), date_micros(F.max(cfg.date))
    micros = first + F.floor((last - first) * F.lit(cfg.train_ratio))
    return df.agg(
        F.min(cfg.date).alias("date_min"),
        F.max(cfg.date).alias("date_max"),
        F.datediff(F.max(cfg.date), F.min(cfg.date)).alias("span_days"),
        micros.alias("cutoff_us"),
        micros_to_date(micros).alias("cutoff_date"),
    )


def with_split(df: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Add ``is_train``: the date is not after the cutoff. The cutoff is a scalar subquery,
    evaluated once on the executors; no value travels through the caller."""
    limit = cutoff(df, cfg).select("cutoff_us").scalar()
    return df.withColumn("is_train", date_micros(F.col(cfg.date)) <= limit)


def split_by_date(split: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Train and test rows per date: the small table behind the split audits."""
    return split.groupBy(cfg.date).agg(
        F.count_if(F.col("is_train")).alias("n_train"),
        F.count_if(~F.col("is_train")).alias("n_test"),
    )


def split_audit(split: DataFrame, cfg: PanelConfig) -> DataFrame:
    """One row: sizes, ranges, shared dates and whether the split is free of leakage."""
    date = F.col(cfg.date)
    in_train, in_test = F.col("n_train") > 0, F.col("n_test") > 0
    audit = split_by_date(split, cfg).agg(
        F.coalesce(F.sum("n_train"), F.lit(0)).alias("n_train"),
        F.coalesce(F.sum("n_test"), F.lit(0)).alias("n_test"),
        F.min(F.when(in_train, date)).alias("train_min"),
        F.max(F.when(in_train, date)).alias("train_max"),
        F.min(F.when(in_test, date)).alias("test_min"),
        F.max(F.when(in_test, date)).alias("test_max"),
        F.count_if(in_train & in_test).alias("shared_dates"),
    )
    n_rows = F.col("n_train") + F.col("n_test")
    return audit.withColumns(
        {
            "train_ratio": round_half_up(F.try_divide("n_train", n_rows), 4),
            "test_ratio": round_half_up(F.try_divide("n_test", n_rows), 4),
            "ok": F.coalesce(
                (F.col("train_max") < F.col("test_min")) & (F.col("shared_dates") == 0),
                F.lit(False),
            ),
        }
    )


def shared_dates(df: DataFrame, flag: Column, cfg: PanelConfig) -> DataFrame:
    """Dates that occur both among the rows with the flag and among those without."""
    return (
        df.where(flag).select(cfg.date).intersect(df.where(~flag).select(cfg.date))
    )


def scope_audit(df: DataFrame, cfg: PanelConfig, allowed: Sequence[str]) -> DataFrame:
    """Rows per commodity and whether the commodity is allowed (missing counts as not)."""
    return (
        df.groupBy(cfg.commodity)
        .agg(F.count("*").alias("n"))
        .withColumn(
            "expected", F.coalesce(F.col(cfg.commodity).isin(*allowed), F.lit(False))
        )
    )


def unexpected_categories(df: DataFrame, cfg: PanelConfig, allowed: Sequence[str]) -> DataFrame:
    return scope_audit(df, cfg, allowed).where(~F.col("expected")).select(cfg.commodity)


def _label_table(df: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    schema = T.StructType([T.StructField(column, T.StringType())])
    return df.sparkSession.createDataFrame([(label,) for label in labels], schema)


def missing_groups(split: DataFrame, cfg: PanelConfig, allowed: Sequence[str]) -> DataFrame:
    """For each allowed commodity: test rows, last date, and why it has no test rows."""
    seen = split.groupBy(F.lower(cfg.commodity).alias("_label")).agg(
        F.count_if(~F.col("is_train")).alias("n_test"),
        F.max(cfg.date).alias("last_date"),
    )
    n_test = F.coalesce("n_test", F.lit(0))
    status = (
        F.when(F.col("_label").isNull(), "absent")
        .when(n_test == 0, "no test rows")
        .otherwise("present")
    )
    return (
        _label_table(split, cfg.commodity, allowed)
        .join(seen, F.lower(cfg.commodity) == F.col("_label"), "left")
        .select(cfg.commodity, n_test.alias("n_test"), "last_date", status.alias("status"))
    )


def split_representation(split: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Train and test rows per commodity and test rows in percent of train rows."""
    counts = split.where(F.col(cfg.commodity).isNotNull()).groupBy(cfg.commodity).agg(
        F.count_if(F.col("is_train")).alias("n_train"),
        F.count_if(~F.col("is_train")).alias("n_test"),
    )
    share = F.try_divide("n_test", "n_train") * 100
    return counts.withColumn("test_share_pct", round_half_up(share, 1))


def mean_shift(split: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Mean price in train and test per commodity and the change in percent.

    Commodities without rows on either side are left out."""
    means = split.groupBy(cfg.commodity).agg(
        F.avg(F.when(F.col("is_train"), F.col(cfg.price))).alias("train_mean"),
        F.avg(F.when(~F.col("is_train"), F.col(cfg.price))).alias("test_mean"),
    )
    return means.na.drop().withColumn(
        "shift_pct", percent_change(F.col("test_mean"), F.col("train_mean"))
    )


def category_plan(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per label of each categorical feature, the missing label included."""
    return (
        labels_long(df, **{name: F.col(name) for name in columns})
        .groupBy("name", "label")
        .agg(F.count("*").alias("n"))
    )


def category_cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return category_plan(df, columns).groupBy("name").agg(F.count("*").alias("cardinality"))


def unseen_categories(split: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per categorical feature: labels known from train, and test rows with another label."""
    labels = split.select(
        "is_train",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("name"), F.col(name).alias("label"))
                    for name in columns
                ]
            )
        ),
    )
    counts = labels.groupBy("name", "label").agg(
        F.count_if(F.col("is_train")).alias("n_train"),
        F.count_if(~F.col("is_train")).alias("n_test"),
    )
    known = (F.col("n_train") > 0) & F.col("label").isNotNull()
    return counts.groupBy("name").agg(
        F.count_if(known).alias("n_train_labels"),
        F.sum(F.when(known, F.lit(0)).otherwise(F.col("n_test"))).alias("n_unseen_test_rows"),
    )


def leakage_audit(panel: DataFrame, cfg: PanelConfig, features: Sequence[str]) -> DataFrame:
    """Check rows: the target is no feature, and the history features among ``features`` equal
    those worked out again from the reports with smaller numbers.

    The arithmetic is the audit's own: reports are numbered by date, a frame is a range of those
    numbers, and mean and deviation come from the listed prices of that frame.
    """
    return check_rows(_leaks(panel, cfg, features))


def _leaks(panel: DataFrame, cfg: PanelConfig, features: Sequence[str]) -> DataFrame:
    """One row with the number of violations per check of ``leakage_audit``."""
    group = Window.partitionBy(*cfg.keys)
    by_number = group.orderBy("_report")
    fresh: dict[str, Column] = {}
    for n in cfg.lags:
        fresh[f"lag_{n}"] = F.max(cfg.price).over(by_number.rangeBetween(-n, -n))
    for size in cfg.windows:
        prices = F.collect_list(cfg.price).over(by_number.rangeBetween(-size, -1))
        enough = F.size(prices) >= cfg.min_periods
        mean = _total(prices) / F.size(prices)
        squares = _total(F.transform(prices, lambda price: (price - mean) * (price - mean)))
        fresh[f"rolling_mean_{size}"] = F.when(enough, mean)
        fresh[f"rolling_std_{size}"] = F.when(enough, F.sqrt(squares / (F.size(prices) - 1)))
    fresh = {name: column for name, column in fresh.items() if name in features}
    numbered = panel.select(*cfg.keys, cfg.date, cfg.price, *fresh).withColumn(
        "_report", F.row_number().over(group.orderBy(cfg.date))
    )
    compared = numbered.withColumns({f"_fresh_{name}": fresh[name] for name in fresh})

    def differs(name: str) -> Column:
        old, new = F.col(name), F.col(f"_fresh_{name}")
        same = F.coalesce(close_to(old, new, cfg.tolerance), old.isNull() & new.isNull())
        return F.count_if(~same)

    return compared.agg(
        F.lit(int(cfg.price in features)).cast("bigint").alias("target_in_features"),
        *[differs(name).alias(name) for name in fresh],
    )


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0.0), lambda total, number: total + number)


def check_rows(counts: DataFrame) -> DataFrame:
    """A one-row table of violation counts as rows (check_name, violations, ok)."""
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.col(name).alias("violations"),
            (F.col(name) == 0).alias("ok"),
        )
        for name in counts.columns
    ]
    return counts.select(F.inline(F.array(*rows)))


def panel_integrity(
    panel: DataFrame,
    cfg: PanelConfig,
    references: DataFrame | None = None,
    stages: Stages | None = None,
) -> DataFrame:
    """Types, date window and plausibility of every row of the feature panel.

    With a table of reference prices the ratio is worked out again and compared.
    """
    date = F.col(cfg.date)
    mistyped = {problem.split(":")[0] for problem in schema_problems(panel, FEATURES)}
    first_year, last_year = cfg.expected_years
    ratio = F.col("price_vs_msp")
    if references is None:
        labels = [name.lower() for name in cfg.reference_prices]
        wrong_ratio = ratio.isNotNull() != F.lower(cfg.commodity).isin(*labels)
    else:
        given = panel.withColumn("given_ratio", ratio)
        panel = reference_ratio(given, references, cfg, stages or Stages(panel.sparkSession))
        off = ~close_to(F.col("given_ratio"), ratio, cfg.tolerance)
        wrong_ratio = (F.col("given_ratio").isNull() != ratio.isNull()) | F.coalesce(off, F.lit(False))

    def implausible(name: str) -> Column:
        price = F.col(name)
        return ~((price > 0) & (price < cfg.plausible_price_limit))

    violations = {
        "date_window": ~F.year(date).between(first_year, last_year),
        "month_sin": ~close_to(F.col("month_sin"), month_sin(date), cfg.tolerance),
        "month_cos": ~close_to(F.col("month_cos"), month_cos(date), cfg.tolerance),
        "reference_ratio": wrong_ratio,
        "lag_1": implausible("lag_1"),
        "lag_7": implausible("lag_7"),
    }
    counts = panel.agg(
        *[
            F.lit(int(name in mistyped)).cast("bigint").alias(f"type_{name}")
            for name in FEATURES.names
        ],
        *[F.count_if(broken).alias(name) for name, broken in violations.items()],
    )
    return check_rows(counts)


def findings(
    split: DataFrame, cfg: PanelConfig, features: Sequence[str], allowed: Sequence[str]
) -> DataFrame:
    """The audits' outcome as six rows (check_id, ok, detail)."""
    nulls = sum((F.col(name).isNull().cast("bigint") for name in features), F.lit(0))
    summary = split.agg(
        F.count_if(~F.coalesce(F.col(cfg.commodity).isin(*allowed), F.lit(False))).alias("stray"),
        F.coalesce(F.sum(nulls), F.lit(0)).alias("nulls"),
    )
    audit = split_audit(split, cfg)
    cards = category_plan(split, cfg.categorical_features).groupBy("name").agg(
        F.count("label").alias("cardinality")
    )
    leaks = _leaks(split, cfg, features).drop("target_in_features")
    history_leaks = leaks.select(
        sum((F.col(name) for name in leaks.columns), F.lit(0)).cast("bigint")
    )
    summary = summary.withColumns(
        {
            "audit": audit.select(F.struct("*")).scalar(),
            "cards": cards.agg(
                F.map_from_entries(F.collect_list(F.struct("name", "cardinality")))
            ).scalar(),
            "limit": cutoff(split, cfg).select(F.col("cutoff_date").cast("string")).scalar(),
            "shift": mean_shift(split, cfg).agg(F.max(F.abs("shift_pct"))).scalar(),
            "leaks": history_leaks.scalar(),
        }
    )

    def card(name: str) -> Column:
        return F.col("cards")[name].cast("string")

    def of_audit(name: str) -> Column:
        return F.col(f"audit.{name}")

    target_used = cfg.price in features
    rows = {
        "F1 scope": (
            F.col("stray") == 0,
            F.concat(F.lit("rows out of scope "), F.col("stray").cast("string")),
        ),
        "F2 split": (
            of_audit("ok"),
            F.concat_ws(
                " ", F.lit("cutoff"), F.col("limit"),
                *[
                    part
                    for side in ("train", "test")
                    for part in (
                        F.lit(side), of_audit(f"n_{side}").cast("string"),
                        F.lit("from"), of_audit(f"{side}_min").cast("string"),
                        F.lit("to"), of_audit(f"{side}_max").cast("string"),
                    )
                ],
            ),
        ),
        "F3 no leakage": (
            F.lit(not target_used) & (F.col("leaks") == 0),
            F.concat(
                F.lit("target is a feature" if target_used else "target is no feature"),
                F.lit(", history values that differ "), F.col("leaks").cast("string"),
            ),
        ),
        "F4 missing values": (
            F.lit(True),
            F.concat(F.col("nulls").cast("string"), F.lit(" kept as missing")),
        ),
        "F5 encoding": (
            F.lit(True),
            F.concat_ws(
                " ",
                *[
                    part
                    for name in cfg.categorical_features
                    for part in (F.lit(name), card(name))
                ],
            ),
        ),
        "F6 distribution": (
            F.lit(True),
            F.concat(
                F.lit("largest mean shift in tenths of a percent "),
                F.floor(round_half_up(F.col("shift"), 1) * 10 + 0.5).cast("string"),
            ),
        ),
    }
    structs = [
        F.struct(F.lit(key).alias("check_id"), ok.alias("ok"), detail.alias("detail"))
        for key, (ok, detail) in rows.items()
    ]
    return summary.select(F.inline(F.array(*structs)))
