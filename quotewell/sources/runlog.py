"""Run records: one row per training run, as JSON, each committed as a whole."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.sources import folders
from quotewell.sources.schemas import RUN_RECORD

# How the three errors are called in a run record's metric map.
METRIC_SUFFIXES = {"mae": "MAE", "rmse": "RMSE", "mape_pct": "MAPE_pct"}


def metric_map(metrics: DataFrame, model: str) -> DataFrame:
    """One row with a map ``<model>_<group>_<error> -> value`` for the rows of one model."""
    entries = F.array(
        *[
            F.struct(
                F.concat_ws("_", "model", "group_label", F.lit(suffix)).alias("key"),
                F.col(name).alias("value"),
            )
            for name, suffix in METRIC_SUFFIXES.items()
        ]
    )
    overall = F.max(F.when(F.col("group_label") == "OVERALL", F.col("n"))).cast("double")
    return (
        metrics.where(F.col("model") == model)
        .agg(F.flatten(F.collect_list(entries)).alias("entries"), overall.alias("n"))
        .select(
            F.map_concat(
                F.map_from_entries("entries"), F.create_map(F.lit("n_test_overall"), "n")
            ).alias("metrics")
        )
    )


def run_record(
    metrics: DataFrame,
    importance: DataFrame | None,
    *,
    params: dict[str, str],
    columns: dict[str, object],
) -> DataFrame:
    """A single row in the declared schema.

    ``metrics`` has one map column, ``importance`` (a model without features has none) has
    ``feature`` and ``gain_pct``, one row per feature of the model; the other
    columns (model, cutoff, row counts, ...) are plain values, or Columns such as a scalar
    subquery. Columns that are not given stay NULL.
    """
    given = {
        "timestamp_utc": datetime.now(timezone.utc).isoformat(timespec="microseconds"),
        "run_id": uuid.uuid4().hex,
        "params": F.create_map(*[F.lit(part) for pair in params.items() for part in pair]),
        **columns,
    }
    if importance is not None:
        given["feature_importance_gain"] = importance.agg(
            F.map_from_entries(F.collect_list(F.struct("feature", "gain_pct")))
        ).scalar()
    record = metrics.withColumns(
        {name: value if isinstance(value, Column) else _literal(value)
         for name, value in given.items()}
    )
    return record.select(
        *[
            (F.col(column.name) if column.name in record.columns else F.lit(None))
            .cast(column.dataType)
            .alias(column.name)
            for column in RUN_RECORD
        ]
    )


def _literal(value: object) -> Column:
    if isinstance(value, (list, tuple)):
        return F.array(*[F.lit(item) for item in value])
    return F.lit(value)


def append_run_record(record: DataFrame, path: str) -> bool:
    """Commit a run's one record to the log; False if that run is in the log already.

    The record is written aside and renamed, in one step, to the folder of its run, so that a
    reader sees whole records only and a repeated append changes nothing.
    """
    spark = record.sparkSession
    run_id = record.select("run_id").first().run_id
    compacted = {row.run_id for row in _compacted(spark, path).select("run_id").collect()}
    if run_id in compacted:
        return False
    staged = f"{path}/_staged-{uuid.uuid4().hex}"
    record.withColumn("run_id", F.lit(run_id)).coalesce(1).write.json(staged)
    return folders.commit(spark, staged, f"{path}/run-{run_id}")


def _compacted(spark: SparkSession, path: str) -> DataFrame:
    """Records of the newest compaction, an empty table without one."""
    packs = [name for name in folders.names(spark, path) if name.startswith("pack-")]
    if not packs:
        return spark.createDataFrame([], RUN_RECORD)
    return spark.read.schema(RUN_RECORD).json(f"{path}/{packs[-1]}")


def read_run_records(spark: SparkSession, path: str) -> DataFrame:
    """Committed run records, one per run, with their maps declared; inference would turn the maps
    into structs. Without any the table is empty."""
    names = folders.names(spark, path)
    runs = [f"{path}/{name}" for name in names if name.startswith("run-")]
    packed = _compacted(spark, path)
    if not runs:
        return packed
    single = spark.read.schema(RUN_RECORD).json(runs)
    # A run may be in both between the two steps of a compaction.
    return packed.join(single.select("run_id"), "run_id", "left_anti").select(
        *RUN_RECORD.names).unionByName(single)


def compact_run_records(spark: SparkSession, path: str) -> int:
    """Gather all committed records into one folder; returns how many it holds.

    The gathered records are committed before the folders they come from go, so that a reader
    finds every run once at any time. One compaction at a time; appends may go on meanwhile.
    """
    names = folders.names(spark, path)
    runs = [name for name in names if name.startswith("run-")]
    packs = [name for name in names if name.startswith("pack-")]
    if not runs:
        return _compacted(spark, path).count()
    staged = f"{path}/_staged-{uuid.uuid4().hex}"
    single = spark.read.schema(RUN_RECORD).json([f"{path}/{name}" for name in runs])
    gathered = _compacted(spark, path).join(
        single.select("run_id"), "run_id", "left_anti").select(*RUN_RECORD.names)
    gathered.unionByName(single).coalesce(1).write.json(staged)
    latest = int(packs[-1].removeprefix("pack-")) if packs else 0
    final = f"{path}/pack-{latest + 1:09d}"
    if not folders.commit(spark, staged, final):
        raise RuntimeError(f"another compaction has written {final}")
    for name in [*runs, *packs]:
        folders.delete(spark, f"{path}/{name}")
    return spark.read.schema(RUN_RECORD).json(final).count()


def logged_metrics(records: DataFrame) -> DataFrame:
    """Long form: one row per run, model and logged metric."""
    return records.select(
        "timestamp_utc", "run_id", "model", F.explode("metrics").alias("metric", "value")
    )


def logged_importance(records: DataFrame) -> DataFrame:
    """Long form: one row per run, model and feature, in ascending order of importance."""
    return records.select(
        "timestamp_utc", "model", F.explode("feature_importance_gain").alias("feature", "gain_pct")
    ).orderBy("model", "gain_pct", "feature")
