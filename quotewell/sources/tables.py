"""Reading and writing the pipeline's tables. CSV only at the edges, Parquet between stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewell.config import PanelConfig
from quotewell.sources.quoted_csv import read_quoted
from quotewell.sources.schemas import (
    BASELINE_PREDICTIONS,
    DIRECT_PREDICTIONS,
    require_columns,
    require_schema,
)
from quotewell.sources.stages import Stages, folder_writer

# Cell texts that mean "missing" in a quote file.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Blanks are kept, and a quote within a quoted cell is doubled.
_KEEP_BLANKS = {
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"',
}


def read_raw_quotes(spark: SparkSession, path: str, stages: Stages | None = None) -> DataFrame:
    """Raw quote CSV with a header row. Every column is text, in the first header's spelling.

    Files of one folder may have their columns in any order, and lack some. Quoted cells may hold
    line breaks; large files are read in splits all the same.
    """
    raw = read_quoted(spark, path, stages or Stages(spark), _KEEP_BLANKS)
    return raw.select(
        *[
            F.when(~F.col(f"`{name}`").isin(*MISSING_TEXTS), F.col(f"`{name}`")).alias(name)
            for name in raw.columns
        ]
    )


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    partitioned_by: Sequence[str] = (),
) -> DataFrame:
    """Re-read a stage output with its declared types; fails if a column has another type.

    Parquet files carry their types, which must equal the declared ones; only the columns that
    are folder names take the declared type. In a CSV every value is parsed as declared and
    the read fails on a value that does not fit, so a date can never silently stay text.
    """
    if fmt == "csv":
        reader = spark.read.schema(schema).options(
            header="true", mode="FAILFAST", enforceSchema="false", **_KEEP_BLANKS
        )
        return reader.csv(path)
    stored = spark.read.format(fmt).load(path)
    in_files = T.StructType([c for c in schema if c.name not in partitioned_by])
    require_schema(require_columns(stored, schema.names), in_files)
    return spark.read.schema(schema).format(fmt).load(path).select(*schema.names)


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Overwrite ``path`` with ``df``. CSV files get a header row."""
    writer = folder_writer(df, partition_by).mode("overwrite")
    if fmt == "csv":
        writer.options(header="true", **_KEEP_BLANKS).csv(path)
    else:
        writer.format(fmt).save(path)


def write_baseline_predictions(
    predictions: DataFrame, path: str, fmt: str = "parquet"
) -> None:
    write_table(predictions.select(*BASELINE_PREDICTIONS.names), path, fmt)


def direct_prediction_columns(
    predictions: DataFrame, cfg: PanelConfig, predicted: str = "predicted"
) -> DataFrame:
    """The five columns of the direct model's prediction table, with its two renames."""
    return predictions.select(
        cfg.date, cfg.state, cfg.commodity,
        F.col(cfg.price).alias("actual_modal_price"),
        F.col(predicted).alias("predicted_modal_price"),
    )


def write_direct_predictions(
    predictions: DataFrame, path: str, cfg: PanelConfig, fmt: str = "parquet"
) -> None:
    write_table(
        require_schema(direct_prediction_columns(predictions, cfg), DIRECT_PREDICTIONS), path, fmt
    )


def saved_row_count(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> int | None:
    """Rows of a saved table for information only; None when there is no such table."""
    try:
        return read_table(spark, path, schema, fmt).count()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
