from __future__ import annotations

import numpy as np
import pytest

from quotewell.config import PanelConfig, TreeParams
from quotewell.operators import boosting, forecast, histograms

CFG = PanelConfig(model_features=("lag_1", "lag_7", "day_of_week", "commodity", "state"))
SCHEMA = "modal_price double, lag_1 double, lag_7 double, day_of_week int, commodity string, " \
    "state string"


@pytest.fixture(scope="module")
def rows(spark, stages):
    """Two files: more distinct values than bins, gaps, NaN, missing and rare labels."""
    rng = np.random.default_rng(5)
    data = []
    for i in range(5000):
        lag, week = float(rng.normal(1000, 300)), int(rng.integers(0, 7))
        state = None if i % 41 == 0 else f"S{int(rng.integers(0, 12)) if i % 500 else 99}"
        seventh = None if i % 5 == 0 else float("nan") if i % 7 == 0 else round(lag, -1)
        data.append((lag * 1.1 + 30 * week + float(rng.normal(0, 40)), lag, seventh, week,
                     "Onion" if i % 3 else "Potato", state))
    return stages.write(spark.createDataFrame(data, SCHEMA).coalesce(2), "rows")


def fit(rows, stages, n_trees, **more):
    return forecast.fit_trees(
        rows, "modal_price", CFG.model_features, CFG, TreeParams(n_trees=n_trees, max_depth=4),
        "predicted", stages.path("rounds"), **more)


def test_one_task_fits_the_trees_of_mllib(spark, rows, stages, monkeypatch):
    held = fit(rows, stages, 6, trees_per_round=4)
    monkeypatch.setattr(boosting, "TASK_CELLS", 0)
    expected = fit(rows, stages, 6, trees_per_round=4)
    # The line with the tree's own id apart.
    one, other = ([tree.toDebugString.split("\n", 1)[1] for tree in model.stages[-1].trees]
                  for model in (held, expected))
    assert one == other
    assert held.stages[-1].treeWeights == expected.stages[-1].treeWeights
    nodes = []
    for model in (held, expected):
        path = stages.path("model")
        forecast.save_model(model, path)
        nodes.append(forecast.saved_nodes(spark, model, path).orderBy(
            "treeID", "nodeData.id").collect())
    assert nodes[0] == nodes[1]


def test_a_small_fit_starts_few_jobs(spark, rows, stages):
    context = spark.sparkContext
    context.setJobGroup("small-fit", "")
    try:
        model = fit(rows, stages, 12)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(model.stages[-1].trees) == 12
    # One job for each level of each tree would be 48.
    assert len(context.statusTracker().getJobIdsForGroup("small-fit")) < 40


def test_thresholds_lie_at_even_strides():
    values = np.repeat(np.arange(40.0), np.arange(1, 41))
    cuts, through, target, at = [], 1.0, len(values) / 8, 1
    while at < 40:  # value after value, as MLlib goes through them
        before, through = through, through + at + 1
        if abs(before - target) < abs(through - target):
            cuts.append(at - 0.5)
            target += len(values) / 8
        at += 1
    assert histograms.thresholds(values, 7).tolist() == cuts
    assert histograms.thresholds(np.array([3.0, 1.0, 3.0]), 7).tolist() == [2.0]
    assert histograms.thresholds(np.zeros(5), 7).tolist() == []


def test_values_that_no_split_parts():
    data = histograms.Binned([np.ones(4), np.zeros(4)], {1: 1}, 256)
    root, predicted = histograms.grow(data, np.array([1.0, 2.0, 3.0, 6.0]), 3)
    assert root.left is None and root.prediction == 3.0 and predicted.tolist() == [3.0] * 4


def test_values_that_are_not_finite_are_refused(spark, rows, stages):
    endless = rows.limit(50).selectExpr(
        "double('Infinity') AS modal_price", *rows.columns[1:])
    with pytest.raises(Exception, match="finite"):
        fit(stages.write(endless, "endless"), stages, 1)
