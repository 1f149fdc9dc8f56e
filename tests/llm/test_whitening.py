"""Whitening against covariances of exact fractions."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import SMALL

from quotewell.llm import queries, whitening


def brute_force(vectors: list[list[float]]):
    """n, deviations, means and the covariance, from exact integers."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(row[i] for row in x) for i in range(d)]
    off = [[n * row[i] - sums[i] for i in range(d)] for row in x]
    deviations = [sum(o * o for o in row) for row in off]
    cov = np.array([[float(Fraction(sum(o[i] * o[j] for o in off), n**3)) for j in range(d)]
                    for i in range(d)])
    return n, deviations, np.array([[float(Fraction(o, n)) for o in row] for row in off]), cov


def test_query(spark):
    table = pq.read_table(f"{SMALL}/embeddings.parquet").to_pylist()
    n, deviations, centred, cov = brute_force([r["embedding"] for r in table])
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(-values)[:8]
    rows = queries.QUERIES["op13_whitening"](spark, SMALL).collect()
    assert len(rows) == 8 * n
    found = {(r.vec_id, r.component): r for r in rows}
    for k, at in enumerate(order):
        expected = centred @ axes[:, at] / np.sqrt(values[at])
        actual = np.array([found[r["vec_id"], k + 1].whitened for r in table])
        sign = np.sign(expected @ actual)
        assert np.allclose(actual, sign * expected, atol=1e-7)
        assert found[table[0]["vec_id"], k + 1].explained == pytest.approx(
            values[at] / np.trace(cov), rel=1e-9)
    for row, deviation in zip(table, deviations, strict=True):
        assert found[row["vec_id"], 1].deviation == deviation
    assert {r.n for r in rows} == {n}
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-8


def test_odd_rows(spark, stages):
    nan, inf = float("nan"), float("inf")
    good = [[0.5, -0.25, 1.0], [0.1, 0.2, 0.3], [0.1, 0.2, 0.3], [-3.0, 2.0, 9.5], [0.0, 0.0, 0.0]]
    bad = [None, [nan, 0.0, 0.0], [0.0, inf, 0.0], [None, 0.0, 0.0], [1e30, 0.0, 0.0]]
    rows = [(i, v, "w", 7, "v") for i, v in enumerate(good)]
    rows += [(None, good[1], None, None, None)] + [(9, v, "w", 7, "v") for v in bad]
    schema = "vec_id long, embedding array<double>, whitened string, deviation int, vector string"
    made, model, error = whitening.whiten(spark.createDataFrame(rows, schema), stages)
    listed = [*good, good[1]]
    n, deviations, centred, cov = brute_force(listed)
    assert model.n == n == made.count() and error < 1e-9
    assert made.columns == ["vec_id", "embedding", "vector", "deviation", "whitened"]
    found = sorted(made.collect(), key=lambda r: (r.vec_id is None, r.vec_id))
    assert [r.deviation for r in found] == deviations
    for k in range(3):
        expected = centred @ model.vectors[k] / np.sqrt(model.values[k])
        assert np.allclose([r.whitened[k] for r in found], expected)
        assert np.allclose(cov @ model.vectors[k], model.values[k] * model.vectors[k])


def test_no_variance(spark, stages):
    schema = "vec_id long, embedding array<double>"
    rows = [(1, [0.5, 0.25]), (2, [0.5, 0.25])]
    made, model, error = whitening.whiten(spark.createDataFrame(rows, schema), stages)
    assert error is None and model.explained() == [None, None]
    assert [(r.deviation, r.whitened) for r in made.collect()] == [(0, [None, None])] * 2
    made, _, error = whitening.whiten(
        spark.createDataFrame([(1, [0.0, 1.0]), (2, [0.0, 2.0])], schema), stages)
    assert sorted(r.whitened[0] for r in made.collect()) == pytest.approx([-1, 1])
    assert {r.whitened[1] for r in made.collect()} == {None} and error < 1e-12


def test_empty_and_mixed(spark, stages):
    schema = "vec_id long, embedding array<float>"
    made, model, error = whitening.whiten(spark.createDataFrame([(1, None)], schema), stages)
    assert model is None and error is None and made.count() == 0
    assert made.columns == ["vec_id", "embedding", "deviation", "whitened"]
    with pytest.raises(ValueError, match="1 to 2 entries"):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], schema), stages)


def test_large_entries_are_exact(spark, stages):
    vectors = [[2.0**39, -(2.0**38)], [1.0, 2.0**39], [0.5, 0.25]]
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id int, embedding array<double>")
    n, deviations, centred, cov = brute_force(vectors)
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    assert whitening._summed(frame.selectExpr("embedding AS vector"), 2, None) == [
        sum(column) for column in zip(*x)]
    made, model, _ = whitening.whiten(frame, stages)
    assert [r.deviation for r in made.orderBy("vec_id").collect()] == [
        v if v < 1 << 63 else None for v in deviations]
    assert np.allclose(cov @ model.vectors[0], model.values[0] * model.vectors[0], rtol=1e-12)
