from __future__ import annotations

import datetime
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotewell.config import PanelConfig, TreeParams
from quotewell.operators import forecast
from quotewell.plans import training
from quotewell.sources import runlog

CFG = PanelConfig(model_features=("lag_1", "lag_7", "commodity", "state"))
SCHEMA = "commodity string, state string, price_date date, modal_price double, lag_1 double, " \
    "lag_7 double"


@pytest.fixture(scope="module")
def rows(spark, stages):
    rng = np.random.default_rng(11)
    data = []
    for i in range(300):
        lag = float(rng.integers(1, 12)) * 100
        state = "ABC"[i % 3] if i < 250 else "D"  # D occurs in the test part only
        price = lag * 1.5 + {"A": 0, "B": 400, "C": -50, "D": 0}[state] + float(rng.integers(0, 9))
        data.append((
            "Onion" if i % 2 else "Potato", state,
            datetime.date(2024, 1, 1) + datetime.timedelta(days=i), price,
            lag, None if i % 5 == 0 else float(rng.integers(1, 9)),
        ))
    return stages.write(spark.createDataFrame(data, SCHEMA), "rows")


def best_split(x: np.ndarray, y: np.ndarray) -> float:
    """Smallest squared error that one threshold on one feature can reach."""
    best = float(((y - y.mean()) ** 2).sum())
    for column in x.T:
        for cut in np.unique(column)[:-1]:
            left, right = y[column <= cut], y[column > cut]
            error = ((left - left.mean()) ** 2).sum() + ((right - right.mean()) ** 2).sum()
            best = min(best, float(error))
    return best


def test_one_stump_equals_brute_force(rows, stages):
    cfg = CFG.with_changes(model_features=("lag_1", "lag_7", "state"), categorical_features=("state",))
    model = forecast.fit_trees(
        rows, "modal_price", cfg.model_features, cfg,
        TreeParams(n_trees=1, max_depth=1), "predicted", stages.path("rounds"),
    )
    scored = forecast.predict(model, rows, cfg.model_features, cfg).toPandas()
    y = scored["modal_price"].to_numpy()
    numeric = np.column_stack([
        scored[["lag_1", "lag_7"]].fillna(side).to_numpy()
        for side in (forecast.BELOW, forecast.ABOVE)
    ])
    # every way to send some of the states to the left
    states = sorted(scored["state"].unique())
    sides = [
        scored["state"].isin(chosen).to_numpy(float)
        for size in range(1, len(states))
        for chosen in itertools.combinations(states, size)
    ]
    expected = best_split(np.column_stack([numeric, *sides]), y)
    assert ((scored["predicted"] - y) ** 2).sum() == pytest.approx(expected, rel=1e-9)


@pytest.mark.parametrize("belongs_right", [True, False])
def test_missing_values_go_where_they_fit(spark, stages, belongs_right):
    # Prices step up at lag_7 = 5; rows without it belong to the named side.
    data = [("Onion", "A", datetime.date(2024, 1, 1), 900.0 if k >= 5 else 100.0, 1.0, float(k))
            for k in range(10)] * 5
    missing = 900.0 if belongs_right else 100.0
    data += [("Onion", "A", datetime.date(2024, 1, 1), missing, 1.0, gap)
             for gap in [None, float("nan")] * 10]
    planted = stages.write(spark.createDataFrame(data, SCHEMA), "planted")
    cfg = CFG.with_changes(model_features=("lag_1", "lag_7"), categorical_features=())
    path = stages.path("one-split")
    model = forecast.fit_trees(
        planted, "modal_price", cfg.model_features, cfg, TreeParams(n_trees=1, max_depth=1),
        "predicted", f"{path}-rounds",
    )
    scored = forecast.predict(model, planted, cfg.model_features, cfg)
    assert scored.where("abs(predicted - modal_price) > 1e-9").count() == 0
    forecast.save_model(model, path)
    split = forecast.first_split(spark, model, path, cfg.model_features).first()
    assert (split.feature, split.cut, split.missing_left) == ("lag_7", 4.5, not belongs_right)
    shares = forecast.feature_importance(spark, model, path, cfg.model_features).collect()
    assert {r.feature: r.gain_pct for r in shares} == {"lag_7": 100.0, "lag_1": 0.0}


def test_a_stopped_fit_goes_on(spark, stages, rows):
    folder = stages.path("resumed")
    params = TreeParams(n_trees=7, max_depth=3)

    def fit(where, stop_after=None, source=rows):
        return forecast.fit_trees(
            source, "modal_price", CFG.model_features, CFG, params, "predicted", where,
            trees_per_round=3, stop_after=stop_after,
        )

    whole = fit(stages.path("whole"))
    assert fit(folder, stop_after=1) is None and fit(folder, stop_after=2) is None
    saved = forecast.saved_rounds(spark, folder)
    assert [path.rsplit("/", 1)[1] for path in saved] == ["round-00000", "round-00001"]
    # A writer that was lost leaves its staged folder; it does no harm.
    spark.range(1).write.parquet(saved[0].rsplit("/", 1)[0] + "/writing-lost/rows")
    resumed = fit(folder)
    # The line with the tree's own id apart, the first round's trees are the same.
    first, other = ([t.toDebugString.split("\n", 1)[1] for t in model.stages[-1].trees[:3]]
                    for model in (resumed, whole))
    assert first == other
    assert len(resumed.stages[-1].trees) == 7
    one = forecast.predict(whole, rows, CFG.model_features, CFG).toPandas()["predicted"]
    two = forecast.predict(resumed, rows, CFG.model_features, CFG).toPandas()["predicted"]
    assert np.allclose(one, two, rtol=1e-9)
    # Three rounds predict what their parts predict on the residuals, one after the other.
    error = ((rows.toPandas()["modal_price"] - one) ** 2).sum()
    short = forecast.fit_trees(
        rows, "modal_price", CFG.model_features, CFG, TreeParams(n_trees=3, max_depth=3),
        "predicted", stages.path("short"))
    three = forecast.predict(short, rows, CFG.model_features, CFG).toPandas()["predicted"]
    assert error < ((rows.toPandas()["modal_price"] - three) ** 2).sum()
    # Other rows are another fit.
    fit(folder, stop_after=1, source=stages.write(rows.limit(200), "fewer"))
    assert len(forecast.saved_rounds(spark, folder)) == 4


def test_missing_and_unseen_values_are_accepted(rows, stages):
    train = rows.where(F.col("state") != "D")
    model = forecast.fit_trees(
        train, "modal_price", CFG.model_features, CFG, TreeParams(n_trees=3), "predicted",
        stages.path("rounds"),
    )
    scored = forecast.predict(model, rows, CFG.model_features, CFG)
    assert scored.where("predicted is null or isnan(predicted)").count() == 0
    assert scored.where("state = 'D'").count() == 50
    assert scored.columns == [*rows.columns, "predicted"]


def test_more_labels_than_bins(spark, stages):
    data = [("Onion", f"S{i}", datetime.date(2024, 1, 1), float(i), 1.0, 1.0)
            for i in range(40)] * 3
    many = stages.write(spark.createDataFrame(data, SCHEMA), "many")
    model = forecast.fit_trees(
        many, "modal_price", CFG.model_features, CFG, TreeParams(n_trees=1, max_bins=8),
        "predicted", stages.path("rounds"),
    )
    assert forecast.predict(model, many, CFG.model_features, CFG).count() == 120


def test_train_save_load_log(spark, stages, rows):
    split = forecast.model_split(rows, CFG)
    params = TreeParams(n_trees=4, max_depth=3)
    models = {
        kind: training.train(split, kind, CFG, params, stages, stages.path(f"model-{kind}"))
        for kind in (training.DIRECT, training.RESIDUAL)
    }
    direct, residual = models[training.DIRECT], models[training.RESIDUAL]
    assert "lag_1" not in residual.features

    test = training.test_rows(split, training.DIRECT, CFG)
    fresh = training.score(direct, test, CFG, "predicted").orderBy("price_date").collect()
    loaded = training.load(training.DIRECT, CFG, direct.path)
    again = training.score(loaded, test, CFG, "predicted").orderBy("price_date").collect()
    assert fresh == again

    gains = training.importance(spark, direct).collect()
    assert [r.feature for r in gains] != [] and {r.feature for r in gains} == set(CFG.model_features)
    assert sum(r.gain_pct for r in gains) == pytest.approx(100)
    assert [r.gain for r in gains] == sorted((r.gain for r in gains), reverse=True)

    scores = training.three_way_metrics(split, residual, direct, CFG)
    without = training.three_way_metrics(split, residual, None, CFG)
    assert {r.model for r in without.collect()} == {training.NAIVE, training.RESIDUAL}
    sizes = {(r.group_label, r.n) for r in scores.collect()}
    assert len(sizes) == 3  # the same n for every model of a group

    path = stages.path("log")
    for trained in models.values():
        training.log_run(trained, split, scores, CFG, params, path)
    records = {r.model: r for r in runlog.read_run_records(spark, path).collect()}
    assert records["DIRECT"].params["n_trees"] == "4"
    assert records["DIRECT"].target is None
    assert records["RESIDUAL"].target == "residual = modal_price - lag_1"
    assert records["RESIDUAL"].excluded_features == ["lag_1", "price_vs_msp"]
    assert records["DIRECT"].n_train == split.where("is_train").count()
    assert set(records["DIRECT"].feature_importance_gain) == set(CFG.model_features)
    expected = {(r.model, r.group_label): r.mae for r in scores.collect()}
    assert records["DIRECT"].metrics["DIRECT_OVERALL_MAE"] == expected["DIRECT", "OVERALL"]
    assert records["RESIDUAL"].metrics["n_test_overall"] == records["RESIDUAL"].n_test
    listed = runlog.logged_importance(runlog.read_run_records(spark, path)).collect()
    assert len(listed) == 7
