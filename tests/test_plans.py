"""The physical plans are the ones meant for large tables."""

from __future__ import annotations

import importlib.util

import pytest
from conftest import SMALL, plan

from quotewell.config import TreeParams
from quotewell.operators import cleaning, forecast, panel
from quotewell.plans import catalogue
from quotewell.plans.catalogue import CFG, pipeline_for


@pytest.fixture(scope="module")
def pipeline(spark):
    return pipeline_for(spark, SMALL)


def test_outlier_filter_moves_no_quote(pipeline):
    text = plan(cleaning.remove_outliers(pipeline.valid, pipeline.bounds, CFG))
    assert text.count("BroadcastHashJoin") == 1
    assert "hashpartitioning" not in text


def test_outlier_filter_shuffles_when_the_bounds_are_too_large(spark, pipeline):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        kept = cleaning.remove_outliers(pipeline.valid, pipeline.bounds, CFG)
        assert "BroadcastHashJoin" not in plan(kept)
        assert kept.count() == pipeline.cleaned.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_feature_panel_has_two_exchanges_and_one_sort(pipeline):
    text = plan(panel.feature_panel(pipeline.cleaned, CFG))
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("Sort [") == 1
    assert text.count("+- Window [") == 1
    assert "partial_avg" in text  # combined before the first exchange
    columns = "state:string,commodity:string,modal_price:double,price_date:date"
    assert f"ReadSchema: struct<{columns}>" in text


def test_scope_filter_skips_folders_and_reads_few_columns(pipeline):
    text = plan(forecast.model_split(pipeline.features, CFG).select("price_date", "is_train"))
    assert "PartitionFilters: [commodity" in text
    assert "ReadSchema: struct<price_date:date>" in text


def test_folders_get_few_files(spark, pipeline):
    stages = pipeline.stages
    scattered = pipeline.features.repartition(8)
    written = stages.write(scattered, "few-files", partition_by=[CFG.commodity])
    folders = written.select(CFG.commodity).distinct().count()
    assert len(written.inputFiles()) <= folders + 4  # not folders times tasks
    assert written.count() == scattered.count()


def test_registered_models_train_all_trees():
    # A fresh copy: other tests set fewer trees in the module.
    found = importlib.util.spec_from_file_location("fresh_catalogue", catalogue.__file__)
    fresh = importlib.util.module_from_spec(found)
    found.loader.exec_module(fresh)
    assert fresh.TREES == TreeParams() and TreeParams().n_trees == 300
