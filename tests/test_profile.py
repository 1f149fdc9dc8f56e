from __future__ import annotations

import datetime
import random

import numpy as np
import pandas as pd
import pytest

from quotewell.config import PanelConfig
from quotewell.operators import profile

CFG = PanelConfig()
SCHEMA = "market_name string, state string, commodity string, price_date date"


def quotes(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for _ in range(600):
        market = rng.randint(0, 8)
        day = datetime.date(2024, 1, 1) + datetime.timedelta(days=rng.randint(0, 90))
        rows.append((
            f"M{market}" if rng.random() > 0.05 else None,
            f"S{market % 3}",
            rng.choice(["Onion", "Potato", None]),
            day if rng.random() > 0.05 else None,
        ))
    return rows


def test_coverage_equals_brute_force(spark):
    rows = quotes()
    frame = pd.DataFrame(rows, columns=["market_name", "state", "commodity", "price_date"])
    frame["price_date"] = pd.to_datetime(frame["price_date"])
    days = (frame["price_date"].max() - frame["price_date"].min()).days
    found = {r.granularity: r for r in profile.coverage(
        spark.createDataFrame(rows, SCHEMA), CFG).collect()}
    for level, place in (("market_commodity", "market_name"), ("state_commodity", "state")):
        counts = frame.groupby([place, "commodity"])["price_date"].nunique()
        row = found[level]
        assert (row.median_dates, row.total_days, row.n_groups) == (counts.median(), days, len(counts))
        assert row.pct == pytest.approx(counts.median() / days * 100)


@pytest.mark.parametrize(
    ("market", "state", "advice"),
    [(17.0, 42.9, "state_commodity"), (35.0, 10.0, "market_commodity"), (5.0, 29.9, "resample")],
)
def test_coverage_verdict(spark, market, state, advice):
    covered = spark.createDataFrame(
        [("market_commodity", market), ("state_commodity", state)],
        "granularity string, pct double",
    )
    rows = {r.granularity: r for r in profile.coverage_verdict(covered, CFG).collect()}
    assert {r.recommendation for r in rows.values()} == {advice}
    assert rows["market_commodity"].flagged is (abs(market - 17) > 10)
    assert rows["state_commodity"].viable is (state >= 30)


def test_describe_equals_brute_force(spark, stages):
    rng = np.random.default_rng(5)
    rows = [("a", float(x)) for x in rng.normal(10, 3, 101)] + [("b", 1.0), ("b", None), ("c", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    found = {r.k: r for r in profile.describe(df, "x", ["k"], stages).collect()}
    expected = pd.Series([x for k, x in rows if k == "a"]).describe()
    assert np.allclose(tuple(found["a"])[1:], expected.to_numpy())
    assert tuple(found["b"])[1:] == (1, 1.0, None, 1.0, 1.0, 1.0, 1.0, 1.0)
    assert found["c"].n == 0
    whole = profile.describe(df, "x", [], stages).first()
    assert whole.n == 102


def test_counts_and_cardinality(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "x string")
    assert [tuple(r) for r in profile.category_counts(df, "x").collect()] == [
        ("a", 2), ("b", 1), ("c", 1),
    ]
    assert profile.category_counts(df, "x", keep_missing=True).count() == 4
    assert [r.x for r in profile.top_categories(df, "x", 2).collect()] == ["a", "b"]
    row = profile.label_cardinality(df, x=df["x"]).first()
    assert (row.n_labels, row.n_labels_with_missing, row.n_rows) == (3, 4, 5)


def test_gap_verdict_tells_source_from_pipeline(spark):
    def rows(last_tomato):
        return spark.createDataFrame(
            [("S", "Tomato", datetime.date(2023, 11, last_tomato)),
             ("S", "Wheat", datetime.date(2024, 2, 6)),
             ("S", "Wheat", None), ("S", "Onion", datetime.date(2025, 1, 1))],
            "state string, commodity string, price_date date",
        )

    found = profile.gap_verdict(rows(6), rows(5), CFG, CFG.gap_commodities).collect()
    assert {r.commodity: r.gap_source for r in found} == {"Tomato": "pipeline", "Wheat": "raw data"}
    months = profile.monthly_rows(rows(6), CFG, CFG.gap_commodities).collect()
    assert {(r.commodity, r.month, r.n) for r in months} == {
        ("Tomato", datetime.date(2023, 11, 1), 1), ("Wheat", datetime.date(2024, 2, 1), 1),
    }


def test_text_in_numbers_and_null_totals(spark):
    df = spark.createDataFrame([("1", "x"), ("2", None), ("y", "")], "a string, b string")
    assert {r.column_name: r.n_text for r in profile.text_in_numbers(df, ["a", "b"]).collect()} == {
        "a": 1, "b": 2,
    }
    assert {r.column_name: r.n_null for r in profile.null_totals(df).collect()} == {"a": 0, "b": 1}
