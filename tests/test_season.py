from __future__ import annotations

import datetime

import pytest

from quotewell.config import PanelConfig
from quotewell.operators import season

CFG = PanelConfig()


@pytest.fixture
def split(spark):
    rows = []
    for month in range(1, 13):  # 2023 complete
        rows.append(("Onion", datetime.date(2023, month, 1), 100.0 * month, True))
    for day in (1, 2, 3):  # January 2024 only: not a full window
        rows.append(("Onion", datetime.date(2024, 1, day), 9999.0, True))
    for month in (2, 3, 8):
        rows.append(("Onion", datetime.date(2024, month, 5), 385.06, False))
    rows.append(("Potato", datetime.date(2024, 8, 5), 50.0, False))
    rows.append(("Potato", datetime.date(2023, 8, 5), 50.0, True))
    return spark.createDataFrame(
        rows, "commodity string, price_date date, modal_price double, is_train boolean"
    )


def test_windows_and_partial_years(split, stages):
    windows = season.season_windows(split, CFG, stages)
    rows = {(r.commodity, r.part, r.year): r for r in windows.collect()}
    full = rows["Onion", "train", 2023]
    assert (full.n_rows, full.mean, full.median, full.months_present) == (6, 350.0, 350.0, 6)
    assert full.is_full is True
    partial = rows["Onion", "train", 2024]
    assert (partial.n_rows, partial.months_present, partial.is_full) == (3, 1, False)
    test = rows["Onion", "test", None]
    assert (test.n_rows, test.mean) == (2, 385.06)
    empty = rows["Potato", "test", None]  # test rows, but none in the window months
    assert (empty.n_rows, empty.mean, empty.median) == (0, None, None)
    assert ("Potato", "train", 2023) not in rows
    labels = {r.period for r in season.season_window_report(windows).collect()}
    assert {"window 2023 (train)", "window 2024 (train) partial 1", "window (test)"} == labels


def test_delta_ignores_partial_windows(split, stages):
    windows = season.season_windows(split, CFG, stages)
    rows = {r.commodity: r for r in season.season_delta(split, windows, CFG).collect()}
    onion = rows["Onion"]
    assert (onion.prior_year, onion.prior_mean, onion.test_mean) == (2023, 350.0, 385.1)
    assert onion.delta_pct == pytest.approx((385.1 - 350) / 350 * 100)
    train_mean = (7800 + 3 * 9999) / 15
    assert onion.prior_vs_train_pct == pytest.approx((350 - train_mean) / train_mean * 100)
    assert rows["Potato"].prior_year is None
    assert rows["Potato"].delta_pct is None


def test_all_months_are_present(split):
    wide = season.year_month_means(split, CFG).where("commodity = 'Onion' and year = 2024").first()
    assert wide["Jan"] == 9999.0
    assert wide["Dec"] is None
    months = season.test_month_means(split, CFG).where("commodity = 'Onion'").collect()
    assert [(r.month_label, r.mean_price) for r in sorted(months, key=lambda r: r.month)] == [
        ("Jan", None), ("Feb", 385.06), ("Mar", 385.06), ("Apr", None), ("May", None), ("Jun", None),
    ]
