"""Declared schemas of the stage tables and checks against them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TEXT, NUMBER, DATE, INT, LONG = (
    T.StringType(), T.DoubleType(), T.DateType(), T.IntegerType(), T.LongType()
)

CLEANED = _struct(
    state=TEXT, district_name=TEXT, market_name=TEXT, commodity=TEXT, variety=TEXT, grade=TEXT,
    modal_price=NUMBER, price_date=DATE,
)
FEATURES = _struct(
    state=TEXT, commodity=TEXT, price_date=DATE, modal_price=NUMBER,
    lag_1=NUMBER, lag_7=NUMBER, lag_14=NUMBER, lag_30=NUMBER,
    rolling_mean_7=NUMBER, rolling_std_7=NUMBER, rolling_mean_30=NUMBER, rolling_std_30=NUMBER,
    month_sin=NUMBER, month_cos=NUMBER, day_of_week=INT, day_of_year=INT, price_vs_msp=NUMBER,
)
BASELINE_PREDICTIONS = _struct(
    state=TEXT, commodity=TEXT, price_date=DATE, modal_price=NUMBER, predicted=NUMBER,
)
DIRECT_PREDICTIONS = _struct(
    price_date=DATE, state=TEXT, commodity=TEXT,
    actual_modal_price=NUMBER, predicted_modal_price=NUMBER,
)
RUN_RECORD = _struct(
    timestamp_utc=TEXT, run_id=TEXT, model=TEXT, target=TEXT, inference=TEXT,
    params=T.MapType(TEXT, TEXT),
    metrics=T.MapType(TEXT, NUMBER),
    feature_importance_gain=T.MapType(TEXT, NUMBER),
    model_path=TEXT, cutoff=TEXT, n_train=LONG, n_test=LONG,
    model_features=T.ArrayType(TEXT), excluded_features=T.ArrayType(TEXT),
)


class SchemaError(ValueError):
    """A table lacks a column or has it with another type."""


class MissingColumnError(SchemaError, KeyError):
    """A table lacks a column that a step cannot do without."""


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise MissingColumnError(f"missing columns: {missing}")
    return df


def schema_problems(df: DataFrame, expected: T.StructType) -> list[str]:
    """One text per expected column that is absent or typed otherwise."""
    actual = {column.name: column.dataType for column in df.schema}
    problems = []
    for column in expected:
        found = actual.get(column.name)
        if found is None:
            problems.append(f"{column.name}: missing")
        elif found != column.dataType:
            problems.append(
                f"{column.name}: {found.simpleString()} instead of "
                f"{column.dataType.simpleString()}"
            )
    return problems


def require_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    problems = schema_problems(df, expected)
    if problems:
        raise SchemaError("; ".join(problems))
    return df
