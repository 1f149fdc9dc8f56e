from __future__ import annotations

import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quotewell.config import PanelConfig
from quotewell.operators import forecast, panel, profile, split

CFG = PanelConfig()
DAY = datetime.date(2023, 6, 6)


def dates(spark, offsets):
    rows = [(DAY + datetime.timedelta(days=i), 1.0) for i in offsets]
    return spark.createDataFrame(rows, "price_date date, modal_price double")


@pytest.mark.parametrize(
    ("last", "cutoff_date", "hours", "n_train"),
    [
        (5, DAY + datetime.timedelta(days=4), 0, 5),  # on a whole day: that day is train
        (736, datetime.date(2025, 1, 14), 19.2, 589),  # within a day
        (0, DAY, 0, 1),  # a single date: everything is train
    ],
)
def test_cutoff_is_a_share_of_the_span(spark, last, cutoff_date, hours, n_train):
    df = dates(spark, range(last + 1))
    row = split.cutoff(df, CFG).first()
    assert row.cutoff_date == cutoff_date
    midnight = (cutoff_date - datetime.date(1970, 1, 1)).days * 86_400_000_000
    assert row.cutoff_us - midnight == pytest.approx(hours * 3_600_000_000, abs=1)
    parted = split.with_split(df, CFG)
    assert parted.where("is_train").count() == n_train
    assert parted.count() == last + 1
    audit = split.split_audit(parted, CFG).first()
    assert (audit.n_train, audit.n_test) == (n_train, last + 1 - n_train)
    assert audit.ok is (last > 0)


def test_cutoff_depends_on_dates_not_on_rows(spark):
    crowded = dates(spark, [0] * 1000 + [10])
    assert split.cutoff(crowded, CFG).first().cutoff_date == DAY + datetime.timedelta(days=8)


def test_a_planted_leak_is_found(spark):
    df = dates(spark, [0, 1, 2, 3, 3]).withColumn(
        "is_train", F.monotonically_increasing_id() % 2 == 0
    )
    leaky = dates(spark, [0, 3]).withColumn("is_train", F.lit(True)).unionByName(
        dates(spark, [3, 4]).withColumn("is_train", F.lit(False))
    )
    audit = split.split_audit(leaky, CFG).first()
    assert (audit.shared_dates, audit.ok) == (1, False)
    shared = split.shared_dates(leaky, F.col("is_train"), CFG).collect()
    assert [r.price_date for r in shared] == [DAY + datetime.timedelta(days=3)]
    assert df.count() == 5


def parted(spark):
    rows = [
        ("Onion", "A", 0, 10.0, True), ("Onion", "B", 1, 20.0, True), ("Onion", "C", 2, 30.0, False),
        ("Tomato", "A", 0, 5.0, True), ("Potato", "A", 2, 7.0, False), (None, "A", 2, 1.0, False),
    ]
    rows = [(c, s, DAY + datetime.timedelta(days=i), p, t) for c, s, i, p, t in rows]
    return spark.createDataFrame(
        rows,
        "commodity string, state string, price_date date, modal_price double, is_train boolean",
    )


def test_representation_keeps_empty_sides(spark):
    rows = {r.commodity: r for r in split.split_representation(parted(spark), CFG).collect()}
    assert (rows["Onion"].n_train, rows["Onion"].n_test, rows["Onion"].test_share_pct) == (2, 1, 50.0)
    assert (rows["Tomato"].n_test, rows["Tomato"].test_share_pct) == (0, 0.0)
    assert (rows["Potato"].n_train, rows["Potato"].test_share_pct) == (0, None)
    assert set(rows) == {"Onion", "Tomato", "Potato"}


def test_missing_groups_say_why(spark):
    found = {
        r.commodity: (r.n_test, r.last_date, r.status)
        for r in split.missing_groups(
            parted(spark), CFG, ["ONION", "Tomato", "Wheat"]
        ).collect()
    }
    assert found == {
        "ONION": (1, DAY + datetime.timedelta(days=2), "present"),
        "Tomato": (0, DAY, "no test rows"),
        "Wheat": (0, None, "absent"),
    }


def test_scope_audit_counts_missing_as_unexpected(spark):
    stray = split.unexpected_categories(parted(spark), CFG, CFG.scope).collect()
    assert {r[0] for r in stray} == {"Tomato", None}


def test_unseen_categories(spark):
    rows = {
        r["name"]: (r.n_train_labels, r.n_unseen_test_rows)
        for r in split.unseen_categories(parted(spark), ["state", "commodity"]).collect()
    }
    assert rows == {"state": (2, 1), "commodity": (2, 2)}


def test_mean_shift_needs_both_sides(spark):
    rows = split.mean_shift(parted(spark), CFG).collect()
    assert [(r.commodity, r.train_mean, r.test_mean, r.shift_pct) for r in rows] == [
        ("Onion", 15.0, 30.0, 100.0)
    ]


def test_null_audit(spark):
    rows = {
        r.feature: r
        for r in profile.null_audit(parted(spark), ["commodity", "modal_price"]).collect()
    }
    assert (rows["commodity"].nulls_train, rows["commodity"].nulls_test) == (0, 1)
    assert rows["commodity"].nulls_test_pct == 33.33
    assert rows["modal_price"].type == "double"


def test_naive_split_drops_before_the_cutoff_and_residual_after(spark):
    rows = [
        ("Onion", "A", DAY + datetime.timedelta(days=i), float(i), None if i == 0 else float(i - 1))
        for i in range(11)
    ]
    panel = spark.createDataFrame(
        rows,
        "commodity string, state string, price_date date, modal_price double, lag_1 double",
    )
    naive = split.cutoff(forecast.naive_split(panel, CFG), CFG).first()
    shared = split.cutoff(forecast.model_split(panel, CFG), CFG).first()
    assert naive.date_min == DAY + datetime.timedelta(days=1)
    assert shared.date_min == DAY
    residual = forecast.residual_target(forecast.model_split(panel, CFG), CFG)
    assert residual.count() == 10
    assert {r.residual for r in residual.collect()} == {1.0}
    rebuilt = forecast.reconstruct_price(residual, "residual")
    assert rebuilt.where("predicted <> modal_price").count() == 0
    summary = forecast.naive_summary(panel, CFG).first()
    assert (summary.n_dropped, summary.n) == (1, 10)


def history(spark, frame):
    """Two groups of 40 reports each with the history columns; rolling ones from ``frame``."""
    rows = [
        (state, "Onion", DAY + datetime.timedelta(days=2 * i), float((i * 37) % 11 + i))
        for state in ("A", "B") for i in range(40)
    ]
    df = spark.createDataFrame(
        rows, "state string, commodity string, price_date date, modal_price double"
    )
    df = panel.add_lags(df, CFG)
    for size in CFG.windows:
        first, last = frame(size)
        over = panel.report_order(CFG).rowsBetween(first, last)
        enough = F.count("modal_price").over(over) >= CFG.min_periods
        df = df.withColumns(
            {
                f"rolling_mean_{size}": F.when(enough, F.avg("modal_price").over(over)),
                f"rolling_std_{size}": F.when(enough, F.stddev_samp("modal_price").over(over)),
            }
        )
    return df


def test_leakage_audit_passes_prior_reports_and_finds_a_frame_with_the_price_itself(spark):
    def violations(rows):
        audit = split.leakage_audit(rows, CFG, CFG.model_features).collect()
        return {r.check_name: r.violations for r in audit}

    clean = history(spark, lambda size: (-size, -1))
    assert set(violations(clean).values()) == {0}
    leaky = violations(history(spark, lambda size: (1 - size, 0)))
    assert [leaky[f"lag_{n}"] for n in CFG.lags] == [0, 0, 0, 0]
    prices = pd.Series([float((i * 37) % 11 + i) for i in range(40)])

    def differ(old, new):
        return 2 * int((~(((old - new).abs() < 1e-6) | (old.isna() & new.isna()))).sum())

    for size in CFG.windows:
        own, prior = (p.rolling(size, min_periods=3) for p in (prices, prices.shift(1)))
        assert leaky[f"rolling_mean_{size}"] == differ(own.mean(), prior.mean()) > 0
        assert leaky[f"rolling_std_{size}"] == differ(own.std(), prior.std()) > 0
    shifted = clean.withColumn("lag_7", F.col("lag_1"))
    assert violations(shifted)["lag_7"] == differ(prices.shift(1), prices.shift(7)) > 0


def test_findings_report_a_stray_commodity(spark):
    rows = parted(spark)
    features = ["state", "commodity"]
    found = {
        r.check_id: r for r in split.findings(rows, CFG, features, CFG.scope).collect()
    }
    assert found["F1 scope"].ok is False
    assert found["F1 scope"].detail == "rows out of scope 2"
    assert found["F3 no leakage"].ok is True
    leaky = split.findings(rows, CFG, [*features, "modal_price"], CFG.scope).collect()
    assert {r.check_id: r.ok for r in leaky}["F3 no leakage"] is False
