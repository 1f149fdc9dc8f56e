"""Expressions and small helpers that the operators of this folder share."""

from __future__ import annotations

import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole_text(name: str) -> Column:
    """The text as it is; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Only A-Z become a-z. Spark's ``lower`` does just that where every character is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name in any case."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def without_ids(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in the one column of ``dropped``; null ids stay."""
    key = free_name(docs, "dropped_id")
    gone = dropped.toDF(key)
    return docs.join(gone, docs[id_col] == gone[key], "left_anti")


def lowest(
    rows: DataFrame, at: str, ties: str, limit: int, total: int, condition: Column | None = None
) -> pa.Table:
    """Column ``ties`` of the ``limit`` rows with the lowest 64-bit hashes ``at``, ties by ``ties``.

    ``total`` is the number of rows for which ``condition`` holds; only those count. Only rows below a hash that about twice as many rows as
    wanted are under take part in the ordering, so what reaches its one task does not grow with
    the table. If hashes are so uneven that too few rows lie there, all rows take part.
    """
    under = (2 * limit + 100) / max(1, total)
    bounds = [int(under * (1 << 64)) - (1 << 63)] if under < 1 else []
    for part in [*(rows.where(F.col(at) < bound) for bound in bounds), rows]:
        if condition is not None:  # asked after the bound, which costs less
            part = part.where(condition)
        chosen = part.orderBy(at, ties).limit(limit).select(ties).toArrow()
        if len(chosen) >= min(limit, total):
            break
    return chosen
