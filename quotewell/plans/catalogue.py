"""The registered queries: one per operator or pipeline, over the tables of a folder.

Averages and deviations are rounded at the very end, because two engines that add in different
orders differ in the last bits.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.config import PanelConfig, TreeParams
from quotewell.functions import scalars
from quotewell.functions.scalars import rounded
from quotewell.operators import charts, cleaning, forecast, metrics, panel, profile, season, split
from quotewell.plans import training
from quotewell.plans.pipeline import Pipeline
from quotewell.plans.training import DIRECT, NAIVE, RESIDUAL
from quotewell.sources import runlog, tables
from quotewell.sources.fixtures import FIXTURE_CONFIG, raw_quotes
from quotewell.sources.schemas import BASELINE_PREDICTIONS, CLEANED, FEATURES
from quotewell.sources.stages import Stages

CFG = FIXTURE_CONFIG
TREES = TreeParams()
RESUMED = TreeParams(n_trees=15)
STUMP_STEP, STUMP_BANDS = 5000, 20

AVERAGES = [
    "rolling_mean_7", "rolling_std_7", "rolling_mean_30", "rolling_std_30",
]
LAGS = [f"lag_{n}" for n in CFG.lags]
PRICES = [CFG.price, *LAGS, *AVERAGES]
SUMMARY = ["mean", "std", "min", "p25", "p50", "p75", "max"]
MESSY_HEADERS = [
    " State", "District Name", "Market Name", "Commodity", "Variety", "Grade ",
    "Min. Price", "Max. Price", "Modal Price", "Price Date",
]
AUDITED = ("ECONOMY", "STANDARD", "PROMO", "SMALL", "TIN")

# Ways to write a date, for the query that reads them all.
SPELLINGS = (
    "yyyy-MM-dd", "M/d/yyyy", "MM-dd-yyyy", "yyyyMMdd", "M/d/yy", "dd-MMM-yyyy", "d MMMM yyyy",
    "MMM d, yyyy", "MMMM d, yyyy HH:mm", "EEEE, d MMM yyyy", "dd-MMM-yy", "yyyy MMM dd",
)

_pipelines: dict[tuple[str, str], Pipeline] = {}
_lock = threading.Lock()


def pipeline_for(spark: SparkSession, folder: str) -> Pipeline:
    """The pipeline over one folder; its stage tables are shared by the session's queries.

    The derived raw quotes stand for the source file.
    """
    context = spark.sparkContext
    key = (context.applicationId, folder)
    with _lock:
        if key not in _pipelines:
            stages = Stages(spark)
            raw = raw_quotes(spark, folder)
            raw = stages.write(raw, "raw")
            _pipelines[key] = Pipeline(spark, raw, CFG, TREES, stages)
        return _pipelines[key]


QUERIES: dict[str, Callable[[Pipeline], DataFrame]] = {}


def query(build: Callable[[Pipeline], DataFrame]) -> Callable[[Pipeline], DataFrame]:
    QUERIES[build.__name__] = build
    return build


# ---- cleaning ----


@query
def coerce_dates_prices(p: Pipeline) -> DataFrame:
    return cleaning.coerce_prices(p.dated, CFG)


@query
def date_spellings(p: Pipeline) -> DataFrame:
    """Each quote's date written in one of twelve ways and read again; rows per text."""
    day = F.to_date(F.when(F.col(CFG.date).rlike("^[0-9]"), F.col(CFG.date)))
    way = F.pmod(F.unix_date(day), F.lit(len(SPELLINGS)))
    spelled = F.coalesce(*[F.when(way == k, F.date_format(day, fmt))
                           for k, fmt in enumerate(SPELLINGS)], F.col(CFG.date))
    return (
        p.raw.groupBy(spelled.alias("spelled")).agg(F.count("*").alias("n"))
        .withColumn("read_as", scalars.to_date(F.col("spelled"), PanelConfig().date_formats))
    )


@query
def unreadable_dates(p: Pipeline) -> DataFrame:
    return cleaning.unreadable_dates(p.raw, CFG)


@query
def price_rules_filter(p: Pipeline) -> DataFrame:
    return cleaning.drop_invalid_prices(p.raw, CFG)


@query
def header_standardise(p: Pipeline) -> DataFrame:
    named = cleaning.normalise_headers(p.raw.toDF(*MESSY_HEADERS))
    return named.drop("min_price", "max_price", "not_there").select(
        "state", "district_name", "market_name", "commodity", "variety", "grade",
        F.col("modal_price").alias("quoted_price"),
        F.col("price_date").alias("quoted_on"),
    )


@query
def drop_category_ci(p: Pipeline) -> DataFrame:
    kept = cleaning.drop_category(p.raw, CFG.commodity, CFG.dropped_commodity)
    return kept.select("state", "market_name", "commodity", "modal_price", "price_date")


@query
def scope_filter(p: Pipeline) -> DataFrame:
    exact = cleaning.in_scope(p.cleaned, CFG.commodity, CFG.scope)
    any_case = cleaning.in_scope_ignoring_case(exact, CFG.commodity, ["Economy"])
    return any_case.select("state", "market_name", "commodity", "modal_price", "price_date")


@query
def month_window_filter(p: Pipeline) -> DataFrame:
    return cleaning.in_months(p.cleaned, CFG.date, CFG.season_months).select(
        "state", "market_name", "commodity", "modal_price", "price_date"
    )


@query
def canonicalise_labels(p: Pipeline) -> DataFrame:
    rows = p.raw.select(F.col("state").alias("raw_state"), "state")
    return (
        cleaning.canonicalise_labels(rows, "state", CFG.state_aliases)
        .groupBy("raw_state", "state")
        .agg(F.count("*").alias("n"))
    )


@query
def iqr_bounds(p: Pipeline) -> DataFrame:
    bounds = cleaning.price_bounds(p.valid, CFG, p.stages)
    return rounded(bounds, 4, "q1", "median", "q3", "lower_bound", "upper_bound")


@query
def iqr_outlier_profile(p: Pipeline) -> DataFrame:
    return cleaning.outlier_profile(p.valid, p.bounds, CFG)


@query
def iqr_filter(p: Pipeline) -> DataFrame:
    return cleaning.remove_outliers(p.valid, p.bounds, CFG).select(
        "market_name", "commodity", "modal_price", "price_date"
    )


@query
def clean_pipeline(p: Pipeline) -> DataFrame:
    return cleaning.clean_quotes(p.raw, CFG, p.stages)


@query
def cleaning_steps(p: Pipeline) -> DataFrame:
    return cleaning.cleaning_steps(p.raw, p.bounds, CFG)


# ---- profiles ----


@query
def category_counts(p: Pipeline) -> DataFrame:
    def tagged(df: DataFrame, column: str, tag: str) -> DataFrame:
        return df.select(F.lit(tag).alias("column_name"), F.col(column).alias("label"), "n")

    return tagged(
        profile.category_counts(p.raw, "commodity", keep_missing=True), "commodity", "commodity"
    ).unionByName(tagged(profile.category_counts(p.cleaned, "state"), "state", "state"))


@query
def top10_categories(p: Pipeline) -> DataFrame:
    return profile.top_categories(p.cleaned, "variety", 10)


@query
def label_cardinality(p: Pipeline) -> DataFrame:
    rows = p.raw.withColumn("raw_state", F.col("state"))
    rows = cleaning.canonicalise_labels(rows, "state", CFG.state_aliases)
    return profile.label_cardinality(
        rows,
        raw_state=F.col("raw_state"), state=F.col("state"), commodity=F.col("commodity"),
    )


@query
def describe_price(p: Pipeline) -> DataFrame:
    return rounded(profile.describe(p.cleaned, CFG.price, [], p.stages), 4, *SUMMARY)


@query
def describe_split(p: Pipeline) -> DataFrame:
    by_commodity = profile.describe(p.split, CFG.price, ["commodity", "is_train"], p.stages)
    overall = profile.describe(p.split, CFG.price, ["is_train"], p.stages)
    both = by_commodity.unionByName(overall.withColumn("commodity", F.lit(metrics.OVERALL)))
    return rounded(both, 2, *SUMMARY)


@query
def describe_residual(p: Pipeline) -> DataFrame:
    rows = p.residual_split.where("is_train")
    return rounded(profile.describe(rows, "residual", [], p.stages), 2, *SUMMARY)


@query
def null_audit(p: Pipeline) -> DataFrame:
    return profile.null_audit(p.split, CFG.model_features)


@query
def null_totals(p: Pipeline) -> DataFrame:
    return profile.null_totals(p.features)


@query
def text_in_numbers(p: Pipeline) -> DataFrame:
    return profile.text_in_numbers(p.raw, CFG.price_columns)


@query
def coverage_by_granularity(p: Pipeline) -> DataFrame:
    return rounded(profile.coverage(p.cleaned, CFG), 4, "pct")


@query
def coverage_verdict(p: Pipeline) -> DataFrame:
    verdict = profile.coverage_verdict(profile.coverage(p.cleaned, CFG), CFG)
    return rounded(verdict, 4, "pct")


def _both_sources(p: Pipeline, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    raw = build(p.dated).withColumn("source", F.lit("raw"))
    return raw.unionByName(build(p.cleaned).withColumn("source", F.lit("cleaned")))


@query
def gap_date_ranges(p: Pipeline) -> DataFrame:
    return _both_sources(p, lambda df: profile.date_ranges(df, CFG, CFG.all_commodities))


@query
def gap_monthly_rows(p: Pipeline) -> DataFrame:
    return _both_sources(p, lambda df: profile.monthly_rows(df, CFG, CFG.gap_commodities))


@query
def gap_monthly_states(p: Pipeline) -> DataFrame:
    return profile.monthly_states(p.cleaned, CFG, CFG.gap_commodities)


@query
def gap_verdict(p: Pipeline) -> DataFrame:
    return profile.gap_verdict(p.dated, p.cleaned, CFG, CFG.gap_commodities)


# ---- panel and features ----


@query
def daily_panel(p: Pipeline) -> DataFrame:
    averaged = panel.in_report_order(panel.daily_panel(p.cleaned, CFG), CFG)
    return rounded(averaged, 4, CFG.price)


@query
def scalar_dates(p: Pipeline) -> DataFrame:
    date = F.col(CFG.date)
    first = p.features.agg(F.min(CFG.date)).scalar()
    return p.features.select("state", "commodity", CFG.date).select(
        "*",
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        scalars.month_start(date).alias("month_start"),
        F.date_format(date, "MMM").alias("month_label"),
        F.weekday(date).alias("day_of_week"),
        F.dayofyear(date).alias("day_of_year"),
        F.datediff(date, first).alias("days_since_first"),
    )


@query
def scalar_numeric(p: Pipeline) -> DataFrame:
    change = F.col(CFG.price) - F.col("lag_1")
    rows = p.features.select(
        "state", "commodity", CFG.date,
        F.abs(change).alias("abs_change"),
        F.sqrt(change * change).alias("root_square_change"),
        scalars.percent_change(F.col(CFG.price), F.col("lag_1")).alias("change_pct"),
        F.col("lag_1").isNull().alias("no_prior_report"),
        scalars.close_to(F.col(CFG.price), F.col("lag_1"), CFG.tolerance).alias("unchanged"),
    )
    return rounded(rows, 1, "root_square_change").transform(
        lambda df: rounded(df, 2, "abs_change", "change_pct")
    )


def _with_keys(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("state", "commodity", CFG.date, *columns)


@query
def lag_features(p: Pipeline) -> DataFrame:
    lagged = panel.add_lags(panel.daily_panel(p.cleaned, CFG), CFG)
    return rounded(_with_keys(lagged, *LAGS), 4, *LAGS)


@query
def rolling_features(p: Pipeline) -> DataFrame:
    rolled = panel.add_rolling(panel.daily_panel(p.cleaned, CFG), CFG)
    return rounded(_with_keys(rolled, *AVERAGES), 4, *AVERAGES)


@query
def calendar_features(p: Pipeline) -> DataFrame:
    dated = panel.add_calendar(panel.daily_panel(p.cleaned, CFG), CFG)
    columns = ["month_sin", "month_cos", "day_of_week", "day_of_year"]
    return rounded(_with_keys(dated, *columns), 4, "month_sin", "month_cos")


@query
def reference_ratio(p: Pipeline) -> DataFrame:
    rated = panel.add_reference_ratio(panel.daily_panel(p.cleaned, CFG), CFG)
    return rounded(_with_keys(rated, "price_vs_msp"), 4, "price_vs_msp")


@query
def reference_table_ratio(p: Pipeline) -> DataFrame:
    """Prices over a table of reference prices: the lowest price of each commodity in an even
    year, from the next year on."""
    daily = panel.daily_panel(p.cleaned, CFG)
    year = F.year(CFG.date)
    references = (
        daily.where(year % 2 == 0).groupBy(F.upper(CFG.commodity).alias(CFG.commodity),
                                           F.make_date(year + 1, F.lit(1), F.lit(1)).alias("valid_from"))
        .agg(F.min(CFG.price).alias("reference_price"))
    )
    rated = panel.reference_ratio(daily, references, CFG, p.stages)
    return rounded(_with_keys(rated, "price_vs_msp"), 4, "price_vs_msp")


@query
def feature_panel(p: Pipeline) -> DataFrame:
    features = panel.feature_panel(p.cleaned, CFG)
    return rounded(features, 4, *PRICES, "month_sin", "month_cos", "price_vs_msp")


@query
def panel_integrity(p: Pipeline) -> DataFrame:
    return split.panel_integrity(p.features, CFG)


@query
def spot_sample(p: Pipeline) -> DataFrame:
    rows = _with_keys(p.features, CFG.price, "lag_1", "lag_7", "month_sin", "month_cos")
    sample = profile.spot_sample(rows, ["state", "commodity", CFG.date], CFG.seed)
    return rounded(sample, 4, CFG.price, "lag_1", "lag_7", "month_sin", "month_cos")


# ---- split and audits ----


@query
def time_split(p: Pipeline) -> DataFrame:
    return _with_keys(p.split, "is_train")


@query
def split_cutoff(p: Pipeline) -> DataFrame:
    return split.cutoff(p.split, CFG)


@query
def split_audit(p: Pipeline) -> DataFrame:
    return split.split_audit(p.split, CFG)


@query
def scope_audit(p: Pipeline) -> DataFrame:
    return split.scope_audit(p.features, CFG, CFG.scope)


@query
def unexpected_categories(p: Pipeline) -> DataFrame:
    return split.unexpected_categories(p.features, CFG, CFG.scope)


@query
def leakage_audit(p: Pipeline) -> DataFrame:
    return split.leakage_audit(p.features, CFG, CFG.model_features)


@query
def leakage_audit_planted(p: Pipeline) -> DataFrame:
    """The audit of a panel whose rolling columns include the price of the row itself."""
    leaky = p.features
    for size in CFG.windows:
        frame = panel.report_order(CFG).rowsBetween(1 - size, 0)
        enough = F.count(CFG.price).over(frame) >= CFG.min_periods
        leaky = leaky.withColumns(
            {
                f"rolling_mean_{size}": F.when(enough, F.avg(CFG.price).over(frame)),
                f"rolling_std_{size}": F.when(enough, F.stddev_samp(CFG.price).over(frame)),
            }
        )
    return split.leakage_audit(leaky, CFG, CFG.model_features)


@query
def findings(p: Pipeline) -> DataFrame:
    return split.findings(p.split, CFG, CFG.model_features, CFG.scope)


@query
def missing_groups(p: Pipeline) -> DataFrame:
    wide = CFG.with_changes(scope=AUDITED)
    return split.missing_groups(forecast.model_split(p.features, wide), wide, AUDITED)


@query
def shared_dates(p: Pipeline) -> DataFrame:
    """Of the true split (none), and of a flag that does leak: one commodity against the rest."""
    flags = {"split": F.col("is_train"), "commodity": F.col("commodity") == CFG.scope[0]}
    parts = [
        split.shared_dates(p.split, flag, CFG).withColumn("flag", F.lit(name))
        for name, flag in flags.items()
    ]
    return parts[0].unionByName(parts[1])


@query
def categorical_plan(p: Pipeline) -> DataFrame:
    return split.category_plan(p.split, CFG.categorical_features)


@query
def categorical_cardinality(p: Pipeline) -> DataFrame:
    return split.category_cardinality(p.split, CFG.categorical_features)


@query
def unseen_categories(p: Pipeline) -> DataFrame:
    columns = [*CFG.categorical_features, "month_label"]
    dated = p.split.withColumn("month_label", F.date_format(CFG.date, "yyyy-MM"))
    return split.unseen_categories(dated, columns)


@query
def split_representation(p: Pipeline) -> DataFrame:
    wide = CFG.with_changes(scope=AUDITED)
    return split.split_representation(forecast.model_split(p.features, wide), wide)


@query
def mean_shift(p: Pipeline) -> DataFrame:
    return rounded(
        split.mean_shift(p.split, CFG), 4, "train_mean", "test_mean", "shift_pct"
    )


# ---- forecasts and their errors ----


@query
def naive_forecast(p: Pipeline) -> DataFrame:
    return rounded(forecast.naive_forecast(p.features, CFG), 4, CFG.price, "predicted")


@query
def naive_summary(p: Pipeline) -> DataFrame:
    return forecast.naive_summary(p.features, CFG)


@query
def naive_metrics(p: Pipeline) -> DataFrame:
    return metrics.forecast_metrics(
        forecast.naive_forecast(p.features, CFG), CFG.price, {NAIVE: "predicted"},
        CFG.commodity, CFG.scope,
    )


def _moving_average_metrics(rows: DataFrame) -> DataFrame:
    """The naive model and two moving-average models, whose errors can be written in SQL."""
    scored = rows.where(~F.col("is_train")).withColumn(
        "blend", (F.col("lag_1") + F.col("rolling_mean_7")) / 2
    )
    return metrics.forecast_metrics(
        scored, CFG.price,
        {NAIVE: "lag_1", "MEAN7": "rolling_mean_7", "BLEND": "blend"},
        CFG.commodity, CFG.scope,
    )


@query
def metrics_improvement(p: Pipeline) -> DataFrame:
    return metrics.compare_models(_moving_average_metrics(p.split), NAIVE, "MEAN7")


@query
def three_way_comparison(p: Pipeline) -> DataFrame:
    return metrics.compare_three(
        _moving_average_metrics(p.residual_split), NAIVE, "MEAN7", "BLEND"
    )


@query
def forecast_verdict(p: Pipeline) -> DataFrame:
    compared = metrics.compare_three(
        _moving_average_metrics(p.residual_split), NAIVE, "MEAN7", "BLEND"
    )
    return metrics.beats_base(
        compared, "mae_resid_vs_base_pct", "mape_pct_resid_vs_base_pct"
    ).select("group_label", "mae_resid_vs_base_pct", "mape_pct_resid_vs_base_pct", "beats")


@query
def run_log_commits(p: Pipeline) -> DataFrame:
    """Records of four runs after repeated appends and a compaction in between."""
    path, spark = p.stages.path("commits"), p.spark
    scores = metrics.forecast_metrics(
        forecast.naive_forecast(p.features, CFG), CFG.price, {NAIVE: "predicted"},
        CFG.commodity, CFG.scope,
    )

    def record(run_id: str) -> DataFrame:
        return runlog.run_record(
            runlog.metric_map(scores, NAIVE), None, params={"kind": "naive"},
            columns={"model": NAIVE, "run_id": run_id},
        )

    for run_id in ("a", "b", "a"):
        runlog.append_run_record(record(run_id), path)
    runlog.compact_run_records(spark, path)
    for run_id in ("b", "c", "d", "d"):
        runlog.append_run_record(record(run_id), path)
    found = runlog.logged_metrics(runlog.read_run_records(spark, path))
    return rounded(found.select("run_id", "metric", "value"), 2, "value")


@query
def run_log_metrics(p: Pipeline) -> DataFrame:
    """Errors logged as a run record, read back and set beside freshly computed ones."""
    scores = _moving_average_metrics(p.split)
    record = runlog.run_record(
        runlog.metric_map(scores, "MEAN7"), None, params={"window": "7"},
        columns={"model": "MEAN7", "model_features": ["rolling_mean_7"]},
    )
    path = p.stages.path("run-log")
    runlog.append_run_record(record, path)
    logged = runlog.logged_metrics(runlog.read_run_records(p.spark, path))
    return metrics.cross_check(scores, logged, "MEAN7")


@query
def residual_target(p: Pipeline) -> DataFrame:
    return rounded(_with_keys(p.residual_split, "is_train", "residual"), 4, "residual")


@query
def residual_reconstruct(p: Pipeline) -> DataFrame:
    rows = p.residual_split
    constant = rows.where("is_train").groupBy("commodity").agg(
        F.avg("residual").alias("predicted_residual")
    )
    scored = rows.where(~F.col("is_train")).join(constant, "commodity")
    rebuilt = forecast.reconstruct_price(scored, "predicted_residual")
    return rounded(_with_keys(rebuilt, "lag_1", "predicted"), 4, "lag_1", "predicted")


# ---- seasonality ----


@query
def seasonal_pivot(p: Pipeline) -> DataFrame:
    return rounded(season.year_month_means(p.split, CFG), 1, *season.MONTH_LABELS.values())


@query
def seasonal_test_months(p: Pipeline) -> DataFrame:
    return rounded(season.test_month_means(p.split, CFG), 4, "mean_price")


@query
def seasonal_windows(p: Pipeline) -> DataFrame:
    return season.season_window_report(season.season_windows(p.split, CFG, p.stages))


@query
def seasonal_delta(p: Pipeline) -> DataFrame:
    windows = season.season_windows(p.split, CFG, p.stages)
    delta = season.season_delta(p.split, windows, CFG)
    return rounded(
        delta, 4, "train_mean", "prior_mean", "test_mean", "delta_pct", "prior_vs_train_pct"
    )


# ---- chart tables ----


@query
def price_trends(p: Pipeline) -> DataFrame:
    return rounded(charts.price_trends(p.cleaned, CFG), 4, "mean_price")


@query
def monthly_seasonality(p: Pipeline) -> DataFrame:
    return rounded(charts.monthly_seasonality(p.cleaned, CFG), 4, "mean_price")


@query
def split_daily(p: Pipeline) -> DataFrame:
    return rounded(charts.split_daily(p.split, CFG), 4, "mean_price")


@query
def pred_extent(p: Pipeline) -> DataFrame:
    scored = forecast.naive_forecast(p.features, CFG)
    return rounded(charts.prediction_extent(scored, CFG, CFG.price, "predicted"), 4, "low", "high")


# ---- files ----


@query
def csv_line_breaks(p: Pipeline) -> DataFrame:
    """Quotes whose market cells hold line breaks, quotes and commas, through one CSV file."""
    path = p.stages.path("breaks")
    stall = F.concat(F.col("market_name"), F.lit('\nstall "'), F.col("grade"), F.lit('", '),
                     F.col("variety"), F.lit("\n\n"))
    broken = F.when(F.col("grade") != "N", stall).otherwise(F.col("market_name"))
    one = p.raw.withColumn("market_name", broken).coalesce(1)
    tables.write_table(one, path, "csv")
    return tables.read_raw_quotes(p.spark, path, p.stages).select(
        "state", "market_name", "commodity", "modal_price", "price_date")


@query
def csv_mixed_headers(p: Pipeline) -> DataFrame:
    """Quotes of three files: the usual header, other order and spelling, a column less."""
    path = p.stages.path("mixed")
    other = dict(zip(p.raw.columns, MESSY_HEADERS, strict=True))
    plain, varied = F.col("grade") == "N", F.col("grade") == "R"
    parts = [
        p.raw.where(plain),
        p.raw.where(varied).select(*[F.col(name).alias(other[name])
                                     for name in reversed(p.raw.columns)]),
        p.raw.where(~plain & ~varied).drop("variety"),
    ]
    for k, rows in enumerate(parts):
        tables.write_table(rows, f"{path}/{k}", "csv")
    return cleaning.normalise_headers(
        tables.read_raw_quotes(p.spark, f"{path}/*", p.stages)
    ).select("state", "commodity", "variety", "grade", "modal_price", "price_date")


@query
def io_roundtrip(p: Pipeline) -> DataFrame:
    """Rows and price totals (in cents) after each stage went through files and back."""
    spark, folder = p.spark, p.stages.path("files")

    def totals(name: str, df: DataFrame, price: str) -> DataFrame:
        cents = F.floor(scalars.round_half_up(F.col(price), 2) * 100 + 0.5)
        return df.agg(F.count("*").alias("n"), F.sum(cents).alias("cents")).select(
            F.lit(name).alias("stage"), "n", "cents"
        )

    tables.write_table(p.raw.toDF(*MESSY_HEADERS), f"{folder}/raw", "csv")
    raw = cleaning.normalise_headers(tables.read_raw_quotes(spark, f"{folder}/raw"))
    numeric = cleaning.coerce_prices(raw, CFG)

    tables.write_table(p.cleaned, f"{folder}/cleaned", "csv")
    cleaned = tables.read_table(spark, f"{folder}/cleaned", CLEANED, "csv")

    tables.write_table(p.features, f"{folder}/features", partition_by=[CFG.commodity])
    features = tables.read_table(
        spark, f"{folder}/features", FEATURES, partitioned_by=[CFG.commodity]
    )

    predictions = forecast.naive_forecast(features, CFG)
    tables.write_baseline_predictions(predictions, f"{folder}/baseline")
    saved = tables.read_table(spark, f"{folder}/baseline", BASELINE_PREDICTIONS)
    tables.write_direct_predictions(saved, f"{folder}/direct", CFG)
    renamed = spark.read.parquet(f"{folder}/direct")
    return (
        totals("raw csv", numeric, "modal_price")
        .unionByName(totals("cleaned csv", cleaned, "modal_price"))
        .unionByName(totals("baseline predictions", saved, "predicted"))
        .unionByName(totals("renamed predictions", renamed, "predicted_modal_price"))
        .unionByName(totals("feature panel", features, "lag_1"))
    )


# ---- rounding ----


@query
def round_ties(p: Pipeline) -> DataFrame:
    """Prices with planted ties, to two digits in both ways, on their shortest decimal form."""
    planted = F.explode(F.array(F.lit(0.005), F.lit(0.125), F.lit(-2.675), F.lit(1.0)))
    price = F.col(CFG.price)
    signed = (F.round(price) + F.col("tie")) * F.when(price % 2 < 1, 1).otherwise(-1)
    rows = p.cleaned.select(CFG.price, planted.alias("tie"))
    ties = rows.select(signed.alias("value")).distinct()
    return ties.select(
        "value",
        scalars.round_shortest(F.col("value"), 2).alias("half_even"),
        scalars.round_shortest(F.col("value"), 2, "up").alias("half_up"),
    )


# ---- boosted trees ----


@query
def gbt_direct(p: Pipeline) -> DataFrame:
    return tables.direct_prediction_columns(p.predictions(DIRECT), CFG)


@query
def gbt_residual(p: Pipeline) -> DataFrame:
    return _with_keys(
        p.predictions(RESIDUAL), CFG.price, "lag_1", "predicted_residual", "predicted"
    )


@query
def gbt_comparison(p: Pipeline) -> DataFrame:
    scores = metrics.forecast_metrics(
        p.predictions(DIRECT), CFG.price, {NAIVE: "lag_1", DIRECT: "predicted"},
        CFG.commodity, CFG.scope,
    )
    return metrics.compare_models(scores, NAIVE, DIRECT)


@query
def gbt_three_way(p: Pipeline) -> DataFrame:
    return metrics.compare_three(p.three_way_metrics(), NAIVE, DIRECT, RESIDUAL)


@query
def gbt_importance(p: Pipeline) -> DataFrame:
    p.train(DIRECT, RESIDUAL)
    return p.importance(DIRECT).unionByName(p.importance(RESIDUAL))


@query
def gbt_save_load(p: Pipeline) -> DataFrame:
    """Test rows, and whether fitted model and model read back from disk predict the same."""
    reloaded = training.load(DIRECT, CFG, p.trained(DIRECT).path)
    scored = training.score(reloaded, p.predictions(DIRECT), CFG, "predicted_after_load")
    same = F.col("predicted") == F.col("predicted_after_load")
    return rounded(
        _with_keys(scored, CFG.price, same.alias("same_prediction")), 4, CFG.price
    )


@query
def gbt_reconstruction(p: Pipeline) -> DataFrame:
    """Test rows of the residual model, and whether price and change add up."""
    adds_up = F.col("predicted") == F.col("lag_1") + F.col("predicted_residual")
    return rounded(
        _with_keys(p.predictions(RESIDUAL), "lag_1", adds_up.alias("adds_up")), 4, "lag_1"
    )


@query
def gbt_scored_rows(p: Pipeline) -> DataFrame:
    """The rows that each model scores, and whether they have a finite prediction."""
    def rows(kind: str) -> DataFrame:
        finite = F.coalesce(F.abs("predicted") < F.lit(float("inf")), F.lit(False))
        scored = p.predictions(kind).withColumn("model", F.lit(kind))
        return _with_keys(scored, "model", CFG.price, finite.alias("scored"))

    p.train(DIRECT, RESIDUAL)
    return rounded(rows(DIRECT).unionByName(rows(RESIDUAL)), 4, CFG.price)


@query
def gbt_model_errors(p: Pipeline) -> DataFrame:
    """The base errors of both comparisons, and whether the model's own error beside them is that
    of the predictions that its query returns."""
    def checked(name: str, comparison: DataFrame, error: str, kind: str) -> DataFrame:
        gap = F.abs(F.col(CFG.price) - F.col("predicted"))
        own = p.predictions(kind).rollup(CFG.commodity).agg(F.avg(gap).alias("own"))
        own = own.withColumn("group_label", F.coalesce(CFG.commodity, F.lit(metrics.OVERALL)))
        agrees = F.coalesce(F.abs(F.col("own") - F.col(error)) <= 0.005001, F.lit(False))
        return comparison.join(own, "group_label", "left").select(
            F.lit(name).alias("comparison"), "group_label", "n",
            "mae_base", "rmse_base", "mape_pct_base", agrees.alias("agrees"),
        )

    p.train(DIRECT, RESIDUAL)
    return checked("direct", gbt_comparison(p), "mae_model", DIRECT).unionByName(
        checked("three-way", gbt_three_way(p), "mae_resid", RESIDUAL)
    )


@query
def gbt_importance_shares(p: Pipeline) -> DataFrame:
    """Each model's features and the sum of their shares."""
    shares = gbt_importance(p)
    totals = shares.groupBy("model").agg(F.sum("gain_pct").alias("total_pct"))
    return rounded(shares.select("model", "feature").join(totals, "model"), 4, "total_pct")


@query
def gbt_resume(p: Pipeline) -> DataFrame:
    """Test rows, and the gap between a fit in one go and one stopped after its first round."""
    train = p.stages.once("resume-train", lambda: p.split.where("is_train").select(
        CFG.price, *CFG.model_features))
    folder = p.stages.path("resume")

    def fitted(name: str, stop_after: int | None = None):
        return forecast.fit_trees(
            train, CFG.price, CFG.model_features, CFG, RESUMED, name, f"{folder}/{name}",
            trees_per_round=RESUMED.n_trees // 3, stop_after=stop_after,
        )

    whole = fitted("whole")
    stopped = fitted("resumed", stop_after=1)
    kept = F.lit(len(forecast.saved_rounds(p.spark, f"{folder}/resumed")))
    rows = p.split.where("NOT is_train")
    both = forecast.predict(
        fitted("resumed"), forecast.predict(whole, rows, CFG.model_features, CFG),
        CFG.model_features, CFG,
    )
    gap = F.round(F.abs(F.col("whole") - F.col("resumed")), 6)
    return _with_keys(both, F.lit(stopped is None).alias("was_stopped"),
                      kept.cast("bigint").alias("rounds_kept"), gap.alias("gap"))


@query
def gbt_stump(p: Pipeline) -> DataFrame:
    """One split of all training rows: feature, cut, side of missing values, gain, both leaves."""
    band = F.least(F.floor(F.col("lag_30") / STUMP_STEP), F.lit(STUMP_BANDS)).cast("double")
    rows = p.split.withColumns({
        "lag_band": band, "weekday": F.weekday(CFG.date).cast("double"),
    })
    features = ["weekday", "lag_band"]
    cfg = CFG.with_changes(categorical_features=())
    train = p.stages.write(rows.where("is_train").select(CFG.price, *features), "stump-train")
    path = p.stages.path("stump")
    model = forecast.fit_trees(
        train, CFG.price, features, cfg, TreeParams(n_trees=1, max_depth=1), "predicted",
        f"{path}-rounds",
    )
    forecast.save_model(model, path)
    split = forecast.first_split(p.spark, model, path, features)
    leaves = forecast.predict(model, train, features, cfg).groupBy("predicted").agg(
        F.count("*").alias("n"))
    row = split.select(F.struct("*")).scalar()
    both = leaves.withColumn("split", row).select("predicted", "n", "split.*")
    return rounded(rounded(both, 4, "predicted"), 0, "gain")


@query
def gbt_cross_check(p: Pipeline) -> DataFrame:
    """The direct model's logged errors beside those on the rows all models share."""
    path = p.stages.path("run-log")
    p.train(DIRECT, RESIDUAL)
    own_rows = metrics.forecast_metrics(
        p.predictions(DIRECT), CFG.price, {DIRECT: "predicted"}, CFG.commodity, CFG.scope
    )
    p.log_run(DIRECT, own_rows, path)
    logged = runlog.logged_metrics(runlog.read_run_records(p.spark, path))
    return metrics.cross_check(p.three_way_metrics(), logged, DIRECT)


@query
def run_log_roundtrip(p: Pipeline) -> DataFrame:
    """Run records of both models, read back as one row per logged value."""
    path = p.stages.path("run-log")
    scores = p.three_way_metrics()
    for kind in (DIRECT, RESIDUAL):
        p.log_run(kind, scores, path)
    records = runlog.read_run_records(p.spark, path)
    gains = runlog.logged_importance(records).select(
        "model", F.concat(F.lit("gain_pct "), "feature").alias("metric"),
        F.col("gain_pct").alias("value"),
    )
    return runlog.logged_metrics(records).drop("timestamp_utc", "run_id").unionByName(gains)


@query
def run_record_names(p: Pipeline) -> DataFrame:
    """The names of all values in the run records, with the number of rows they are about."""
    about = F.when(F.col("metric") == "n_test_overall", F.col("value"))
    return run_log_roundtrip(p).select("model", "metric", about.alias("n_test"))


@query
def saved_row_counts(p: Pipeline) -> DataFrame:
    """Rows of a saved table, and of one that is not there."""
    path = p.stages.path("saved")
    tables.write_baseline_predictions(forecast.naive_forecast(p.features, CFG), path)
    counts = [
        (name, tables.saved_row_count(p.spark, place, BASELINE_PREDICTIONS))
        for name, place in (("saved", path), ("absent", f"{path}-absent"))
    ]
    return p.spark.createDataFrame(counts, "name string, n long")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query as a function of (spark, folder)."""

    def bind(build: Callable[[Pipeline], DataFrame]):
        return lambda spark, folder: build(pipeline_for(spark, folder))

    return {name: bind(build) for name, build in QUERIES.items()}
