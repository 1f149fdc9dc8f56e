"""Forecast errors and like-for-like comparison of models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.functions.scalars import round_half_up
from quotewell.sources.runlog import METRIC_SUFFIXES

ERRORS = ("mae", "rmse", "mape_pct")
OVERALL = "OVERALL"


def mae(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual - predicted))


def rmse(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg((actual - predicted) * (actual - predicted)))


def mape(actual: Column, predicted: Column) -> Column:
    """Mean absolute error in percent of the actual value; rows with actual = 0 are skipped."""
    return F.avg(F.when(actual != 0, F.abs(actual - predicted) / actual)) * 100


def forecast_metrics(
    scored: DataFrame,
    actual: str,
    models: Mapping[str, str],
    category: str,
    focus: Sequence[str],
) -> DataFrame:
    """Errors of several prediction columns, overall and per focus category, in one pass.

    ``models`` maps a model name to its prediction column. Categories are matched in any
    letter case and named as in ``focus``; a category without rows has no result row. ``n``
    counts all rows of the group, also those without a prediction.
    """
    names = F.create_map(*[F.lit(text) for name in focus for text in (name.lower(), name)])
    label = F.try_element_at(names, F.lower(category))
    truth = F.col(actual)
    aggregates = [F.count("*").alias("n"), F.grouping("group_label").alias("_overall")]
    for model, predicted in models.items():
        for error, formula in zip(ERRORS, (mae, rmse, mape)):
            aggregates.append(
                round_half_up(formula(truth, F.col(predicted)), 2).alias(f"{model}_{error}")
            )
    wide = (
        scored.withColumn("group_label", label)
        .rollup("group_label")
        .agg(*aggregates)
        .where((F.col("_overall") == 1) | F.col("group_label").isNotNull())
        .where(F.col("n") > 0)
        .withColumn("group_label", F.coalesce("group_label", F.lit(OVERALL)))
    )
    rows = [
        F.struct(
            F.lit(model).alias("model"),
            "group_label",
            "n",
            *[F.col(f"{model}_{error}").alias(error) for error in ERRORS],
        )
        for model in models
    ]
    return wide.select(F.inline(F.array(*rows)))


def improvement(base: Column, model: Column) -> Column:
    """By how many percent the model's error is below the base error; NULL for a zero base."""
    return round_half_up(F.try_divide(base - model, base) * 100, 1)


def _by_model(metrics: DataFrame, models: Mapping[str, str]) -> DataFrame:
    """One row per group with the errors of each model side by side; ``models`` maps the
    suffix of the output columns to the model name."""
    columns = []
    for suffix, model in models.items():
        chosen = F.col("model") == model
        columns.append(F.max(F.when(chosen, F.col("n"))).alias(f"n_{suffix}"))
        for error in ERRORS:
            columns.append(F.max(F.when(chosen, F.col(error))).alias(f"{error}_{suffix}"))
    return metrics.groupBy("group_label").agg(*columns)


def compare_models(metrics: DataFrame, base: str, model: str) -> DataFrame:
    """Errors of a model beside the base model's; groups that lack either are left out.

    The improvement is taken from the already rounded errors.
    """
    sides = _by_model(metrics, {"base": base, "model": model})
    columns = [F.col("n_model").alias("n")]
    for error in ERRORS:
        old, new = F.col(f"{error}_base"), F.col(f"{error}_model")
        columns += [old, new, improvement(old, new).alias(f"{error}_imp_pct")]
    return sides.where(
        F.col("n_base").isNotNull() & F.col("n_model").isNotNull()
    ).select("group_label", *columns)


def compare_three(metrics: DataFrame, base: str, direct: str, residual: str) -> DataFrame:
    """Base, direct and residual model side by side; a missing direct model leaves NULLs."""
    sides = _by_model(metrics, {"base": base, "direct": direct, "resid": residual})
    columns = [F.col("n_resid").alias("n")]
    for error in ERRORS:
        old, new = F.col(f"{error}_base"), F.col(f"{error}_resid")
        columns += [
            old, F.col(f"{error}_direct"), new,
            improvement(old, new).alias(f"{error}_resid_vs_base_pct"),
        ]
    return sides.where(
        F.col("n_base").isNotNull() & F.col("n_resid").isNotNull()
    ).select("group_label", *columns)


def beats_base(comparison: DataFrame, *improvements: str) -> DataFrame:
    """The overall row with ``beats``: every listed improvement is above zero."""
    better = F.lit(True)
    for name in improvements:
        better = better & F.coalesce(F.col(name) > 0, F.lit(False))
    return comparison.where(F.col("group_label") == OVERALL).withColumn("beats", better)


def cross_check(metrics: DataFrame, logged: DataFrame, model: str) -> DataFrame:
    """Re-scored overall errors of one model beside those of its latest run record."""
    fresh = metrics.where(
        (F.col("model") == model) & (F.col("group_label") == OVERALL)
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(f"{model}_{OVERALL}_{suffix}").alias("metric"),
                        F.col(error).alias("rescored"),
                    )
                    for error, suffix in METRIC_SUFFIXES.items()
                ]
            )
        )
    )
    run = F.struct("timestamp_utc", "run_id")
    of_model = logged.where(F.col("model") == model)
    latest = of_model.where(run.eqNullSafe(of_model.agg(F.max(run)).scalar()))
    return fresh.join(latest.select("metric", F.col("value").alias("logged")), "metric", "left")
