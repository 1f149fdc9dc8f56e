"""Sessions for local runs. On a cluster the session comes from the submitter."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def local_session(name: str, cpus: int | None = None) -> SparkSession:
    """A local session with one shuffle partition per core and adaptive execution.

    On a cluster leave ``spark.sql.shuffle.partitions`` a few times the number of cores;
    adaptive execution merges small partitions and splits skewed ones.
    """
    cpus = cpus or min(8, os.cpu_count() or 1)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    use_local_checkpoints(spark)
    return spark


def use_local_checkpoints(spark: SparkSession) -> None:
    """Name a folder for stage tables if a session of one machine has none.

    For tests and benches. A cluster has to name a folder that its executors share.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stages-"))


def ship_package(spark: SparkSession) -> None:
    """Give this package to the session's executors, once, for their Python workers."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).resolve().parent
        target = os.path.join(tempfile.mkdtemp(prefix="package-"), package.name)
        spark.sparkContext.addPyFile(
            shutil.make_archive(target, "zip", package.parent, package.name)
        )
        _shipped.add(application)
