from __future__ import annotations

import datetime
import random

import numpy as np
import pandas as pd
import pytest

from quotewell.config import PanelConfig
from quotewell.operators import panel, profile, split

CFG = PanelConfig()
SCHEMA = "state string, commodity string, price_date date, modal_price double"
HISTORY = [f"lag_{n}" for n in CFG.lags] + [
    f"rolling_{kind}_{size}" for size in CFG.windows for kind in ("mean", "std")
]


def irregular_rows(seed: int = 0) -> list[tuple]:
    """Two groups of 40 reports, 1 to 20 days apart, in random order."""
    rng = random.Random(seed)
    rows = []
    for state, commodity in (("Kerala", "Onion"), ("Goa", "Wheat")):
        day = datetime.date(2023, 6, 6)
        for _ in range(40):
            rows.append((state, commodity, day, round(rng.uniform(500, 3000), 2)))
            day += datetime.timedelta(days=rng.randint(1, 20))
    rng.shuffle(rows)
    return rows


def brute_force(rows: list[tuple]) -> pd.DataFrame:
    """History features by plain slicing of each group's prior reports."""
    out = []
    frame = pd.DataFrame(rows, columns=["state", "commodity", "price_date", "modal_price"])
    for (state, commodity), group in frame.groupby(["state", "commodity"]):
        prices = group.sort_values("price_date")["modal_price"].tolist()
        dates = sorted(group["price_date"])
        for i, date in enumerate(dates):
            row = {"state": state, "commodity": commodity, "price_date": date}
            for n in CFG.lags:
                row[f"lag_{n}"] = prices[i - n] if i >= n else None
            for size in CFG.windows:
                prior = prices[max(0, i - size):i]
                enough = len(prior) >= CFG.min_periods
                row[f"rolling_mean_{size}"] = np.mean(prior) if enough else None
                row[f"rolling_std_{size}"] = np.std(prior, ddof=1) if enough else None
            out.append(row)
    return pd.DataFrame(out)


def features(spark, rows):
    quotes = spark.createDataFrame(rows, SCHEMA)
    return panel.feature_panel(quotes, CFG).orderBy(*CFG.keys, CFG.date)


def test_history_counts_reports_not_days(spark):
    rows = irregular_rows()
    found = features(spark, rows).toPandas()
    expected = brute_force(rows).sort_values(["state", "commodity", "price_date"])
    for name in HISTORY:
        a = found[name].astype(float).to_numpy()
        b = expected[name].astype(float).to_numpy()
        assert (np.isnan(a) == np.isnan(b)).all(), name
        assert np.allclose(a, b, rtol=1e-10, equal_nan=True), name


def test_own_price_does_not_enter_own_history(spark):
    rows = sorted(irregular_rows(), key=lambda r: (r[0], r[2]))
    changed = list(rows)
    changed[20] = (*rows[20][:3], 99999.0)
    before = features(spark, rows).toPandas()
    after = features(spark, changed).toPandas()
    at = (before["state"] == rows[20][0]) & (before["price_date"] == rows[20][2])
    pd.testing.assert_frame_equal(before.loc[at, HISTORY], after.loc[at, HISTORY])
    assert not before[HISTORY].equals(after[HISTORY])


def test_features_do_not_depend_on_input_order(spark):
    rows = irregular_rows()
    shuffled = spark.createDataFrame(rows[::-1], SCHEMA).repartition(7)
    again = panel.feature_panel(shuffled, CFG).orderBy(*CFG.keys, CFG.date).collect()
    assert again == features(spark, rows).collect()


def test_daily_panel_drops_missing_keys_and_averages(spark):
    day = datetime.date(2024, 1, 1)
    rows = [
        ("A", "Onion", day, 1.0), ("A", "Onion", day, 2.0), (None, "Onion", day, 3.0),
        ("A", None, day, 4.0), ("A", "Onion", None, 5.0),
    ]
    result = panel.daily_panel(spark.createDataFrame(rows, SCHEMA), CFG).collect()
    assert [tuple(r) for r in result] == [("A", "Onion", day, 1.5)]


def test_calendar_and_reference_ratio(spark):
    rows = [
        ("A", "wheat", datetime.date(2024, 1, 1), 2425.0),  # a Monday
        ("A", "Wheat", datetime.date(2024, 12, 29), 4850.0),  # a Sunday
        ("A", "Onion", datetime.date(2024, 3, 1), 10.0),
    ]
    found = {r.price_date: r for r in features(spark, rows).collect()}
    monday = found[datetime.date(2024, 1, 1)]
    assert (monday.day_of_week, monday.day_of_year, monday.price_vs_msp) == (0, 1, 1.0)
    sunday = found[datetime.date(2024, 12, 29)]
    assert (sunday.day_of_week, sunday.day_of_year, sunday.price_vs_msp) == (6, 364, 2.0)
    march = found[datetime.date(2024, 3, 1)]
    assert march.price_vs_msp is None
    assert march.month_sin == pytest.approx(1.0)
    assert march.month_cos == pytest.approx(0.0, abs=1e-12)


def test_integrity_finds_each_defect(spark):
    good = features(spark, irregular_rows())
    assert all(r.ok for r in split.panel_integrity(good, CFG).collect())
    bad = good.selectExpr(
        "state", "commodity",
        "case when day_of_year % 2 = 0 then date'2031-01-01' else price_date end as price_date",
        "modal_price", "-1.0D as lag_1", "2e6D as lag_7", "lag_14", "lag_30",
        "rolling_mean_7", "rolling_std_7", "rolling_mean_30", "rolling_std_30",
        "month_sin + 0.5 as month_sin", "month_cos", "cast(day_of_week as string) as day_of_week",
        "1.0D as price_vs_msp",
    )
    failed = {r.check_name for r in split.panel_integrity(bad, CFG).collect() if not r.ok}
    assert {"date_window", "month_sin", "reference_ratio", "lag_1", "lag_7",
            "type_day_of_week", "type_day_of_year"} <= failed
    assert "type_lag_14" not in failed


def test_leakage_audit_finds_a_leak(spark):
    good = features(spark, irregular_rows())
    assert all(r.ok for r in split.leakage_audit(good, CFG, CFG.model_features).collect())
    leaky = good.withColumn("rolling_mean_7", good["modal_price"])
    failed = {
        r.check_name
        for r in split.leakage_audit(leaky, CFG, [*CFG.model_features, "modal_price"]).collect()
        if not r.ok
    }
    assert failed == {"target_in_features", "rolling_mean_7"}


def test_spot_sample_is_stable(spark):
    rows = features(spark, irregular_rows())
    keys = ["state", "commodity", "price_date"]
    first = sorted(profile.spot_sample(rows, keys, 42).collect())
    assert first == sorted(profile.spot_sample(rows.repartition(5), keys, 42).collect())
    assert len(first) == 3
    assert first != sorted(profile.spot_sample(rows, keys, 43).collect())


REFERENCES = "commodity string, reference_price double, valid_from date, state string"


def test_reference_prices_from_a_table(spark, stages):
    day = datetime.date
    rows = [
        ("A", "Wheat", day(2023, 12, 31), 100.0), ("A", "Wheat", day(2024, 1, 1), 100.0),
        ("A", "wheat", day(2024, 6, 1), 100.0), ("A", "Onion", day(2024, 1, 1), 100.0),
        ("A", "Rye", day(2024, 1, 1), 100.0), ("A", "Oats", day(2024, 1, 1), 100.0),
        ("A", None, day(2024, 1, 1), 100.0),
    ]
    prices = [
        ("WHEAT", 50.0, day(2024, 1, 1), "x"), ("wheat", 200.0, day(2024, 6, 1), "x"),
        ("Rye", 0.0, None, "x"), ("Oats", 25.0, None, "x"), (None, 1.0, None, "x"),
        (None, 2.0, None, "x"), ("Corn", None, None, "x"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    references = spark.createDataFrame(prices, REFERENCES)
    found = panel.reference_ratio(frame, references, CFG, stages)
    assert found.columns == [*frame.columns, "price_vs_msp"]
    assert {(r.commodity, r.price_date): r.price_vs_msp for r in found.collect()} == {
        ("Wheat", day(2023, 12, 31)): None, ("Wheat", day(2024, 1, 1)): 2.0,
        ("wheat", day(2024, 6, 1)): 0.5, ("Onion", day(2024, 1, 1)): None,
        ("Rye", day(2024, 1, 1)): None, ("Oats", day(2024, 1, 1)): 4.0,
        (None, day(2024, 1, 1)): None,
    }
    none = panel.reference_ratio(frame, references.limit(0), CFG, stages).collect()
    assert len(none) == len(rows) and all(r.price_vs_msp is None for r in none)
    timeless = references.where("commodity = 'Oats'").select("commodity", "reference_price")
    assert panel.reference_ratio(frame.limit(0), timeless, CFG, stages).count() == 0
    with pytest.raises(ValueError, match="oats"):
        panel.reference_ratio(frame, timeless.union(timeless), CFG, stages)


def test_integrity_with_a_table_of_reference_prices(spark, stages):
    quotes = spark.createDataFrame(irregular_rows(), SCHEMA)
    name = quotes.first().commodity
    references = spark.createDataFrame(
        [(name, 7.0, datetime.date(1900, 1, 1), "x")], REFERENCES
    )
    good = panel.feature_panel(quotes, CFG, references, stages)
    assert good.where("price_vs_msp IS NOT NULL").count() > 0

    def ok(rows):
        checks = split.panel_integrity(rows, CFG, references, stages).collect()
        return {r.check_name: r.ok for r in checks}["reference_ratio"]

    assert ok(good)
    assert not ok(good.withColumn("price_vs_msp", good["price_vs_msp"] * 2))
    assert not ok(good.selectExpr("* EXCEPT (price_vs_msp)", "cast(null AS double) price_vs_msp"))
