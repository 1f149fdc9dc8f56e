"""Stage tables: Parquet in the folder that all executors share.

A stage cuts lineage, survives lost executors, and tells Catalyst the true size of what it
holds, so that a join against a staged table is broadcast only when its files are below
``spark.sql.autoBroadcastJoinThreshold`` and is shuffled, with skew handling, beyond that.
"""

from __future__ import annotations

import itertools
import threading
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else the session's checkpoint folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative fits a reliable checkpoint folder if the session has none yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")


def folder_writer(df: DataFrame, partition_by: Sequence[str]) -> DataFrameWriter:
    """A writer with one folder per value of the given columns.

    Rows are gathered by folder first, so that not every task writes a file to every folder;
    adaptive execution splits the gathered rows of a hot folder into evenly sized files.
    """
    if not partition_by:
        return df.write
    gathered = df.hint("rebalance", *[F.col(name) for name in partition_by])
    return gathered.write.partitionBy(*partition_by)


class Stages:
    """Named Parquet tables below one folder, each written once."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_folder(spark)}/quotewell-{uuid.uuid4().hex}"
        self._numbers = itertools.count()
        self._tables: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def path(self, name: str) -> str:
        return f"{self.root}/{next(self._numbers):04d}-{name}"

    def write(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write ``df`` to a new folder and return the table as read back from there."""
        path = self.path(name)
        folder_writer(df, partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def once(
        self, name: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """The table called ``name``, written on first use."""
        with self._lock:
            if name not in self._tables:
                self._tables[name] = self.write(build(), name, partition_by)
            return self._tables[name]

    def close(self) -> None:
        """Remove the stage tables. Frames that read them cannot be evaluated afterwards."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self._tables.clear()
