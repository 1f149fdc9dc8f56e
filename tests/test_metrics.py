from __future__ import annotations

import math

import pytest

from quotewell.operators import metrics

SCHEMA = "commodity string, actual double, predicted double"


def scores(spark, rows, focus=("Onion", "Potato")):
    df = spark.createDataFrame(rows, SCHEMA)
    result = metrics.forecast_metrics(df, "actual", {"M": "predicted"}, "commodity", focus)
    return {r.group_label: r for r in result.collect()}


def test_errors_overall_and_per_category(spark):
    rows = [("onion", 10.0, 12.0), ("Onion", 20.0, 20.0), ("Tomato", 5.0, 0.0)]
    found = scores(spark, rows)
    assert set(found) == {"OVERALL", "Onion"}  # Potato has no rows, Tomato is no focus
    assert (found["Onion"].n, found["Onion"].mae, found["Onion"].mape_pct) == (2, 1.0, 10.0)
    assert found["Onion"].rmse == round(math.sqrt(2), 2)
    assert found["OVERALL"].n == 3
    assert found["OVERALL"].mae == round(7 / 3, 2)


def test_zero_actual_and_missing_prediction(spark):
    found = scores(spark, [("Onion", 0.0, 1.0), ("Onion", 10.0, 11.0), ("Onion", 10.0, None)])
    assert (found["Onion"].n, found["Onion"].mae, found["Onion"].mape_pct) == (3, 1.0, 10.0)


def test_perfect_prediction(spark):
    found = scores(spark, [("Onion", 10.0, 10.0)])
    assert (found["OVERALL"].mae, found["OVERALL"].rmse, found["OVERALL"].mape_pct) == (0, 0, 0)


def test_no_rows_no_result(spark):
    assert scores(spark, []) == {}


METRICS = "model string, group_label string, n bigint, mae double, rmse double, mape_pct double"


def test_improvement_uses_rounded_errors_and_skips_unmatched(spark):
    df = spark.createDataFrame(
        [
            ("B", "OVERALL", 5, 10.0, 0.0, 3.0), ("X", "OVERALL", 5, 9.0, 1.0, 3.3),
            ("B", "Onion", 5, 10.0, 1.0, 1.0), ("X", "Potato", 5, 10.0, 1.0, 1.0),
        ],
        METRICS,
    )
    rows = metrics.compare_models(df, "B", "X").collect()
    assert len(rows) == 1
    assert (rows[0].mae_imp_pct, rows[0].rmse_imp_pct, rows[0].mape_pct_imp_pct) == (10.0, None, -10.0)
    same = metrics.compare_models(df, "B", "B").where("group_label = 'OVERALL'").first()
    assert (same.mae_imp_pct, same.mape_pct_imp_pct) == (0.0, 0.0)
    verdict = metrics.beats_base(metrics.compare_models(df, "B", "X"), "mae_imp_pct")
    assert verdict.first().beats is True
    undecided = metrics.beats_base(metrics.compare_models(df, "B", "X"), "rmse_imp_pct")
    assert undecided.first().beats is False


@pytest.mark.parametrize("with_direct", [True, False])
def test_three_way_tolerates_a_missing_direct_model(spark, with_direct):
    rows = [("B", "OVERALL", 5, 10.0, 10.0, 10.0), ("R", "OVERALL", 5, 5.0, 20.0, 10.0)]
    if with_direct:
        rows.append(("D", "OVERALL", 5, 7.0, 7.0, 7.0))
    row = metrics.compare_three(spark.createDataFrame(rows, METRICS), "B", "D", "R").first()
    assert row.mae_direct == (7.0 if with_direct else None)
    assert (row.mae_resid_vs_base_pct, row.rmse_resid_vs_base_pct) == (50.0, -100.0)
    assert row.n == 5


def test_cross_check_takes_one_record_not_a_mix(spark):
    scores = spark.createDataFrame(
        [("M", "OVERALL", 9, 1.0, 2.0, 3.0)],
        "model string, group_label string, n bigint, mae double, rmse double, mape_pct double",
    )
    logged = spark.createDataFrame(
        [
            ("2024-01-01T00:00:00", "a", "M", "M_OVERALL_MAE", 10.0),
            ("2024-01-01T00:00:00", "a", "M", "M_OVERALL_RMSE", 20.0),
            ("2024-01-01T00:00:00", "b", "M", "M_OVERALL_MAE", 11.0),
            ("2024-01-02T00:00:00", "c", "other", "M_OVERALL_MAE", 12.0),
        ],
        "timestamp_utc string, run_id string, model string, metric string, value double",
    )
    rows = {r.metric: r.logged for r in metrics.cross_check(scores, logged, "M").collect()}
    assert rows == {"M_OVERALL_MAE": 11.0, "M_OVERALL_RMSE": None, "M_OVERALL_MAPE_pct": None}
