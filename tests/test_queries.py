"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from compare import differences, duck_connection
from conftest import SMALL, plan

import __spark_entry__ as entry_points
from quotewell.config import TreeParams
from quotewell.plans import catalogue

# The code around the trees is tested, whatever their number.
catalogue.TREES = TreeParams(n_trees=20)

QUERIES = entry_points.queries()
ORACLE = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connection(SMALL)


@pytest.mark.parametrize("name", [name for name in QUERIES if name in ORACLE])
def test_equals_sql(spark, con, name):
    result = QUERIES[name](spark, SMALL)
    assert differences(result, con, ORACLE[name]) == []
    for node in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas"):
        assert node not in plan(result)


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in ORACLE])
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_is_the_feature_panel(spark):
    panel = entry_points.entry(spark)
    assert panel.count() == 3037
    assert len(panel.columns) == 17


@pytest.mark.parametrize(
    ("view", "rows"),
    [("raw", 4707), ("valid", 3195), ("cleaned", 3107), ("features", 3037)],
)
def test_stage_sizes(spark, view, rows):
    from quotewell.plans.catalogue import pipeline_for

    assert getattr(pipeline_for(spark, SMALL), view).count() == rows


def test_models_agree_on_the_rows_they_are_scored_on(spark):
    rows = QUERIES["gbt_three_way"](spark, SMALL).collect()
    naive = {r.group_label: r for r in QUERIES["three_way_comparison"](spark, SMALL).collect()}
    for row in rows:
        assert row.n == naive[row.group_label].n
        assert row.mae_base == naive[row.group_label].mae_base


def test_cross_check_reads_the_logged_errors(spark):
    rows = QUERIES["gbt_cross_check"](spark, SMALL).collect()
    own = {r.group_label: r for r in QUERIES["gbt_comparison"](spark, SMALL).collect()}
    logged = {r.metric: r.logged for r in rows}
    assert logged["DIRECT_OVERALL_MAE"] == own["OVERALL"].mae_model
    assert all(r.rescored is not None for r in rows)
