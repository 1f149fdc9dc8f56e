from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotewell.functions import quantiles
from quotewell.functions.quantiles import exact_quantiles, value_counts

PROBS = {"p0": 0.0, "p10": 0.1, "q1": 0.25, "median": 0.5, "q3": 0.75, "p999": 0.999, "p100": 1.0}


def _rows(seed: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    rows = [("hot", float(v)) for v in np.round(rng.lognormal(5, 2, 4000), 2)]
    rows += [("hot", 42.0)] * 3000  # one price in a large share of the rows
    rows += [("narrow", 1000 + float(v)) for v in rng.integers(0, 3, 500)]
    rows += [("negative", float(v)) for v in rng.normal(-50, 30, 777)]
    rows += [("single", 5.0), ("pair", 1.0), ("pair", 2.0)]
    return rows


@pytest.fixture(params=[(1, 1 << 22, 1), (7, 128, 16), (64, 1 << 22, 4)])
def ranges(request, spark, monkeypatch):
    """So many shuffle partitions, values that a task may sort, and finer cells of a cell."""
    partitions, rows, finer = request.param
    monkeypatch.setattr(quantiles, "CELL_ROWS", rows)
    monkeypatch.setattr(quantiles, "FINER", finer)
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, setting in settings.items():
        spark.conf.set(name, setting)
    yield partitions
    for name, setting in before.items():
        spark.conf.set(name, setting)


def test_equals_brute_force(spark, stages, ranges):
    rows = _rows(ranges)
    noise = [("hot", None), (None, 3.0), ("only missing", None)]
    df = spark.createDataFrame(rows + noise, "k string, x double").repartition(5)
    result = exact_quantiles(df, "x", PROBS, ["k"], stages)
    found = {r.k: tuple(r)[1:] for r in result.collect()}
    assert set(found) == {"hot", "narrow", "negative", "single", "pair"}
    for key, values in found.items():
        expected = np.quantile([x for k, x in rows if k == key], list(PROBS.values()))
        assert np.allclose(values, expected, rtol=1e-12, atol=0), key


def test_without_groups(spark, stages, ranges):
    rows = _rows(1)
    df = spark.createDataFrame(rows, "k string, x double")
    result = exact_quantiles(df, "x", {"q1": 0.25, "q3": 0.75}, [], stages)
    expected = np.quantile([x for _, x in rows], [0.25, 0.75])
    assert result.columns == ["q1", "q3"]
    assert np.allclose(tuple(result.first()), expected, rtol=1e-12)


def test_rows_are_spread_over_cells_in_order(spark, stages):
    df = spark.createDataFrame(_rows(2), "k string, x double")
    counts = value_counts(df, "x", ["k"], stages)
    rows = counts.orderBy("k", "_value").collect()
    numbers = [(row.k, row._cell) for row in rows]
    assert numbers == sorted(numbers)
    assert len(set(numbers)) > len(rows) // 2
    assert sum(row._n for row in rows) == len(_rows(2))


def test_cells_keep_the_order_of_doubles(spark):
    rng = np.random.default_rng(4)
    bits = rng.integers(-(1 << 63), (1 << 63) - 1, 20_000)
    values = [float(v) for v in bits.view(np.float64) if not np.isnan(v)]
    values += [float(np.nextafter(v, np.inf)) for v in values]
    values += [0.0, 5e-324, -5e-324, float("inf"), -float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double").select(
        "x", quantiles.cell(F.col("x")).alias("cell"))
    cells = [row.cell for row in df.orderBy("x").collect()]
    assert cells == sorted(cells)


def test_values_close_together_and_far_apart(spark, stages, monkeypatch):
    monkeypatch.setattr(quantiles, "CELL_ROWS", 8)
    values = [1.7e9 + i for i in range(700)] + [-1.7e308, 1.7e308, 0.0, 5e-324, 1e-323]
    values += [float("inf")] * 2
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = exact_quantiles(df, "x", PROBS, [], stages).first()
    expected = df.agg(F.percentile("x", list(PROBS.values()))).first()[0]
    assert list(found) == expected


def test_same_bits_as_percentile(spark, stages, ranges):
    df = spark.createDataFrame(_rows(2), "k string, x double")
    found = exact_quantiles(df, "x", PROBS, ["k"], stages)
    built_in = df.groupBy("k").agg(F.percentile("x", list(PROBS.values())).alias("q"))
    expected = [(row.k, *row.q) for row in built_in.collect()]
    assert sorted(map(tuple, found.collect())) == sorted(expected)
