"""Run records that are committed as a whole."""

from __future__ import annotations

import threading

from pyspark.sql import functions as F

from quotewell.sources import folders, runlog


def record(spark, run_id: str, mae: float = 1.5):
    row = spark.range(1).select(F.create_map(F.lit("NAIVE_OVERALL_MAE"), F.lit(mae)).alias("metrics"))
    return runlog.run_record(row, None, params={"k": "v"},
                             columns={"model": "NAIVE", "run_id": run_id})


def ids(spark, path: str) -> list[str]:
    return sorted(r.run_id for r in runlog.read_run_records(spark, path).collect())


def test_no_log_is_an_empty_one(spark, stages):
    assert ids(spark, stages.path("no-log")) == []


def test_two_writers_at_once_and_a_repeated_append(spark, stages):
    path = stages.path("log")
    done: list[bool] = []
    writers = [threading.Thread(target=lambda run=run: done.append(
        runlog.append_run_record(record(spark, run), path))) for run in ("a", "b")]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    assert done == [True, True] and ids(spark, path) == ["a", "b"]
    assert runlog.append_run_record(record(spark, "a", 9.0), path) is False
    kept = {r.run_id: r.metrics for r in runlog.read_run_records(spark, path).collect()}
    assert kept["a"] == {"NAIVE_OVERALL_MAE": 1.5}


def test_a_record_that_is_not_committed_is_not_read(spark, stages):
    path = stages.path("log")
    runlog.append_run_record(record(spark, "a"), path)
    record(spark, "lost").write.json(f"{path}/_staged-lost")
    assert ids(spark, path) == ["a"]


def test_compaction(spark, stages):
    path = stages.path("log")
    for run in ("a", "b"):
        runlog.append_run_record(record(spark, run), path)
    assert runlog.compact_run_records(spark, path) == 2
    assert folders.names(spark, path) == ["pack-000000001"]
    assert runlog.append_run_record(record(spark, "b"), path) is False
    assert runlog.append_run_record(record(spark, "c"), path)
    assert ids(spark, path) == ["a", "b", "c"]
    # A compaction that was cut off after its commit leaves a run in both places.
    record(spark, "a").write.json(f"{path}/run-a")
    assert ids(spark, path) == ["a", "b", "c"]
    assert runlog.compact_run_records(spark, path) == 3 == runlog.compact_run_records(spark, path)
    assert folders.names(spark, path) == ["pack-000000002"] and ids(spark, path) == ["a", "b", "c"]


def test_a_taken_name_is_not_written_over(spark, stages):
    path = stages.path("taken")
    spark.range(3).write.json(f"{path}/first")
    spark.range(5).write.json(f"{path}/second")
    assert folders.commit(spark, f"{path}/first", f"{path}/final")
    assert not folders.commit(spark, f"{path}/second", f"{path}/final")
    assert folders.names(spark, path) == ["final"]
    assert spark.read.json(f"{path}/final").count() == 3
