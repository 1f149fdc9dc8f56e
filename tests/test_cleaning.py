from __future__ import annotations

import datetime
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotewell.config import PanelConfig
from quotewell.functions.scalars import round_half_up, to_number
from quotewell.operators import cleaning
from quotewell.sources.schemas import MissingColumnError, SchemaError

CFG = PanelConfig()
PRICES = "min_price string, max_price string, modal_price string"


def test_headers_are_normalised(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], [" Modal Price ", "Price.Date", "STATE", "Min. Price"])
    assert cleaning.normalise_headers(df).columns == [
        "modal_price", "pricedate", "state", "min_price",
    ]


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("12.5", 12.5), (" 7 ", 7.0), (".5", 0.5), ("5.", 5.0), ("1e3", 1000.0), ("-2", -2.0),
        ("+4", 4.0), ("abc", None), ("", None), (None, None), ("NaN", None), ("12d", None),
        ("1,000", None), ("0x1p3", None), ("inf", float("inf")), ("1 2", None),
    ],
)
def test_numbers_are_coerced_without_errors(spark, text, number):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(to_number(F.col("x"))).first()[0] == number


def test_dates_are_coerced_and_bad_ones_kept_as_missing(spark):
    rows = [("2024-02-29",), ("6/7/2023",), ("2023-02-30",), ("junk",), (None,), (" 2024-01-01 ",)]
    parsed = cleaning.parse_date_column(spark.createDataFrame(rows, "price_date string"), CFG)
    assert [r[0] for r in parsed.collect()] == [
        datetime.date(2024, 2, 29), datetime.date(2023, 6, 7), None, None, None,
        datetime.date(2024, 1, 1),
    ]


def test_typed_dates_are_kept(spark):
    noon = datetime.datetime(2024, 2, 29, 12, 30)
    for value, kind in ((noon.date(), "date"), (noon, "timestamp"), (noon, "timestamp_ntz")):
        df = spark.createDataFrame([(value,)], f"price_date {kind}")
        assert cleaning.parse_date_column(df, CFG).first()[0] == noon.date()


PRICE_ROWS = [
    ("1", "3", "2"),  # fine
    ("2", "2", "2"),  # every boundary equal
    ("3", "1", "2"),  # min > max
    ("2", "3", "1"),  # modal below
    ("1", "2", "3"),  # modal above
    ("0", "2", "1"),  # not positive
    ("-1", "2", "1"),
    ("1", None, "1"),
    ("x", "2", "1"),
    ("1|2", None, "3"),  # looks like three numbers when glued together
]


def test_price_rules(spark):
    df = spark.createDataFrame(PRICE_ROWS, PRICES)
    kept = cleaning.drop_invalid_prices(df, CFG)
    assert sorted(map(tuple, kept.collect())) == [(1.0, 3.0, 2.0), (2.0, 2.0, 2.0)]


def test_price_rules_accept_numeric_columns(spark):
    df = spark.createDataFrame(
        [(1.0, 3.0, 2.0), (float("nan"), 3.0, 2.0), (1e7, 3e7, 2e7)],
        PRICES.replace("string", "double"),
    )
    assert cleaning.drop_invalid_prices(df, CFG).count() == 2


def test_missing_price_column_is_an_error(spark):
    df = spark.createDataFrame([("1", "2")], "min_price string, max_price string")
    with pytest.raises(MissingColumnError):
        cleaning.drop_invalid_prices(df, CFG)
    with pytest.raises(KeyError):
        cleaning.coerce_prices(df, CFG)
    assert issubclass(MissingColumnError, SchemaError)


def test_other_missing_columns_only_warn(spark):
    df = spark.createDataFrame([(1,)], "x int")
    for step in (
        lambda: cleaning.parse_date_column(df, CFG),
        lambda: cleaning.drop_category(df, "commodity", "rice"),
        lambda: cleaning.canonicalise_labels(df, "state", CFG.state_aliases),
    ):
        with warnings.catch_warnings(record=True) as caught:
            warnings.simplefilter("always")
            assert step().columns == ["x"]
        assert len(caught) == 1


def test_category_drop_ignores_case_and_keeps_missing(spark):
    df = spark.createDataFrame([("Rice",), ("RICE",), ("Rice Bran",), (None,)], "commodity string")
    kept = cleaning.drop_category(df, "commodity", "rice")
    assert {r[0] for r in kept.collect()} == {"Rice Bran", None}


def test_blank_category_is_missing(spark):
    df = spark.createDataFrame([("",), ("Onion",), (None,)], "commodity string")
    marked = cleaning.blank_to_missing(df, "commodity")
    assert [r[0] for r in marked.collect()] == [None, "Onion", None]


LABELS = [(" Punjab",), ("Tamilnadu",), ("Tamilnadu \t",), ("Gao",), ("Kerala",), (None,), ("",)]
CANONICAL = ["Punjab", "Tamil Nadu", "Tamil Nadu", "Goa", "Kerala", None, ""]


@pytest.mark.parametrize("how", ["map", "table", "long"])
def test_labels_are_merged_and_rows_kept(spark, stages, how):
    df = spark.createDataFrame(LABELS, "state string")
    aliases = dict(CFG.state_aliases)
    if how == "long":
        aliases |= {f"alias {i}": f"label {i}" for i in range(200)}
    if how == "table":
        aliases = stages.write(
            spark.createDataFrame(list(aliases.items()), "alias string, canonical string"),
            "aliases",
        )
    once = cleaning.canonicalise_labels(df, "state", aliases)
    twice = cleaning.canonicalise_labels(once, "state", aliases)
    key = lambda text: (text is None, text or "")
    for result in (once, twice):
        assert sorted((r[0] for r in result.collect()), key=key) == sorted(CANONICAL, key=key)


def test_outlier_bounds_are_asymmetric_and_inclusive(spark, stages):
    prices = list(range(100, 201))  # q1 = 125, q3 = 175, bounds 50 and 325
    rows = [("A", float(p)) for p in prices]
    q1, q3 = np.percentile(prices, [25, 75])
    # the rows at the bounds shift the quartiles, so the bounds are read back
    rows += [("A", 49.0), ("A", 400.0), (None, 150.0), ("single", 7.0)]
    df = spark.createDataFrame(rows, "commodity string, modal_price double")
    bounds = cleaning.price_bounds(df, CFG, stages)
    a = bounds.where("commodity = 'A'").first()
    expected = np.percentile([p for c, p in rows if c == "A"], [25, 50, 75])
    assert np.allclose([a.q1, a.median, a.q3], expected)
    assert np.isclose(a.lower_bound, a.q1 - 1.5 * (a.q3 - a.q1))
    assert np.isclose(a.upper_bound, a.q3 + 3 * (a.q3 - a.q1))

    edges = [a.lower_bound, a.upper_bound, np.nextafter(a.lower_bound, 0),
             np.nextafter(a.upper_bound, 1e9)]
    probe = spark.createDataFrame([("A", float(e)) for e in edges] + [(None, 150.0)], df.schema)
    assert sorted(r.modal_price for r in cleaning.remove_outliers(probe, bounds, CFG).collect()) \
        == sorted(edges[:2])
    kept = cleaning.remove_outliers(df, bounds, CFG)
    assert kept.where("commodity = 'single'").count() == 1
    assert kept.where("commodity is null").count() == 0
    profile = cleaning.outlier_profile(df, bounds, CFG).where("commodity = 'A'").first()
    assert profile.outlier_rows == 1


def test_cleaning_keeps_bad_dates_and_drops_bound_columns(spark, stages):
    rows = [
        ("Kerala", "d", "m", "Onion", "v", "g", "9", "11", "10", "not a date"),
        ("Kerala", "d", "m", "Rice", "v", "g", "9", "11", "10", "2024-01-01"),
        ("Kerala", "d", "m", "Onion", "v", "g", "9", "11", "x", "2024-01-01"),
    ]
    raw = spark.createDataFrame(rows, [
        "State", "District Name", "Market Name", "Commodity", "Variety", "Grade",
        "Min. Price", "Max. Price", "Modal Price", "Price Date",
    ])
    cleaned = cleaning.clean_quotes(raw, CFG, stages)
    assert cleaned.columns == [
        "state", "district_name", "market_name", "commodity", "variety", "grade", "modal_price",
        "price_date",
    ]
    assert [tuple(r)[-2:] for r in cleaned.collect()] == [(10.0, None)]


@pytest.mark.parametrize(
    ("value", "digits", "expected"),
    [
        (0.125, 2, 0.13), (0.12499999999999997, 2, 0.13), (0.1249, 2, 0.12), (-0.125, 2, -0.12),
        (2.5, 0, 3.0), (1234.56, 1, 1234.6), (5e12, 2, 5e12), (None, 2, None),
    ],
)
def test_rounding(spark, value, digits, expected):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(round_half_up(F.col("x"), digits)).first()[0] == expected


def test_dates_with_a_time_unpadded_dates_and_unreadable_ones(spark):
    texts = [
        "2024-01-05", "2024-1-5", "2024-01-05 00:00:00", "2024-01-05T10:30", "1/5/2024",
        "01-05-2024", "2024/01/05", " 1/5/2024 9:15 AM ", "2024-01-05 10:30:00.250+05:30",
    ]
    bad = ["2024-13-40", "soon", "2023-02-30", "soon", "5 Jan"]
    df = spark.createDataFrame([(t,) for t in [*texts, *bad, None]], "`Price Date` string")
    df = cleaning.normalise_headers(df)
    parsed = cleaning.parse_date_column(df, CFG).collect()
    day = datetime.date(2024, 1, 5)
    assert [r.price_date for r in parsed] == [day] * len(texts) + [None] * 6
    forms = {r.form: r.n for r in cleaning.unreadable_dates(df, CFG).collect()}
    assert forms == {"9999-99-99": 2, "aaaa": 2, "9 aaa": 1}


def test_dates_with_month_names_two_digit_years_and_without_separators(spark):
    expected = {
        "05-Jan-2024": (2024, 1, 5), "5 january 2024": (2024, 1, 5), "JAN 5, 2024": (2024, 1, 5),
        "January 5, 2024 10:30": (2024, 1, 5), "Friday, 5 Jan 2024": (2024, 1, 5),
        "Fri 5th Jan 2024": (2024, 1, 5), "2024-Jan-05": (2024, 1, 5), "20240105": (2024, 1, 5),
        "2024.1.5": (2024, 1, 5), "1/5/24": (2024, 1, 5), "01-05-24": (2024, 1, 5),
        "5-Sept-1999": (1999, 9, 5), "1/5/68": (2068, 1, 5), "1/5/69": (1969, 1, 5),
        "29-Feb-72": (1972, 2, 29), "2/29/23": None, "30-Feb-2024": None, "5 Janu 2024": None,
        "202401": None, "Mon": None, "": None, "5th": None,
    }
    df = spark.createDataFrame([(t,) for t in expected], "price_date string")
    found = {
        r.text: r.price_date
        for r in cleaning.parse_date_column(df.selectExpr("*", "price_date AS text"), CFG).collect()
    }
    assert found == {t: d and datetime.date(*d) for t, d in expected.items()}
