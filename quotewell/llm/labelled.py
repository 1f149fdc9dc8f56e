"""Labelled samples to fit classifiers on, and the split into training and held-out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.llm.common import whole_text
from quotewell.sources.stages import Stages

FIT_ROWS = 6_000
FIT_CHARS = 20_000


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds, F.lit(0))


def fit_sample(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    training: Column,
    stages: Stages,
    id_col: str = "doc_id",
    text_col: str = "text",
    fit_rows: int = FIT_ROWS,
    fit_chars: int = FIT_CHARS,
) -> list[tuple[str, int]]:
    """At most ``fit_rows`` (text, label) pairs of labelled training documents.

    Which documents are taken depends on a hash of their ids only. Documents longer than
    ``fit_chars`` are left out of the fit, so the sample is bounded in bytes as well. Ids with
    contradictory labels, null ids and null labels are left out; repeated label rows count once.
    A repeated document id is used once, with its longest text, the greatest if tied.
    """
    chosen = stages.write(
        _agreed(labels, label_col, training, id_col)
        .orderBy(F.xxhash64("id"), "id").limit(fit_rows).select("id", "label"),
        f"fit-{label_col}",
    )
    return _texts(docs, chosen, id_col, text_col, fit_chars)


def balanced_sample(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    training: Column,
    stages: Stages,
    id_col: str = "doc_id",
    text_col: str = "text",
    fit_rows: int = FIT_ROWS,
    fit_chars: int = FIT_CHARS,
) -> tuple[list[tuple[str, int]], tuple[float, float]]:
    """As ``fit_sample``, with up to half of the rows from each label, 0 and 1.

    A rare label is in the sample as long as any training document has it. Also returned: the
    shares of both labels among all labelled training documents.
    """
    agreed = stages.write(
        _agreed(labels, label_col, training, id_col).where("label IN (0, 1)")
        .select("id", F.col("label").cast("int").alias("label")),
        f"agreed-{label_col}",
    )
    sizes = {row.label: row["count"] for row in agreed.groupBy("label").count().collect()}
    total = max(1, sum(sizes.values()))
    parts = [
        agreed.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(fit_rows // 2)
        for label in (0, 1)
    ]
    chosen = stages.write(parts[0].unionByName(parts[1]), f"fit-{label_col}")
    shares = (sizes.get(0, 0) / total, sizes.get(1, 0) / total)
    return _texts(docs, chosen, id_col, text_col, fit_chars), shares


def labelled_texts(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    training: Column,
    stages: Stages,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row (id, label, text) for every labelled training document, whole and of any length.

    Labels are 0 and 1. What counts of repeated and contradictory rows is as in ``fit_sample``.
    """
    agreed = stages.write(
        _agreed(labels, label_col, training, id_col).where("label IN (0, 1)")
        .select("id", F.col("label").cast("int").alias("label")),
        f"agreed-{label_col}",
    )
    # Documents are shuffled at every size: a broadcast would hold a label for each of them.
    return _joined(docs.where(training), agreed.hint("merge"), id_col, text_col)


def _agreed(labels: DataFrame, label_col: str, training: Column, id_col: str) -> DataFrame:
    """Training ids that all their label rows agree on."""
    return (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & training)
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min(label_col).alias("label"), F.max(label_col).alias("other"))
        .where("label = other")
    )


def _joined(
    docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, fit_chars: int | None = None
) -> DataFrame:
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    if fit_chars is not None:
        texts = texts.where(F.char_length("text") <= fit_chars)
    return (
        texts.join(chosen, "id")
        .groupBy("id", "label")
        .agg(F.max(F.struct(F.char_length("text"), F.col("text"))).alias("row"))
        .select("id", "label", F.col("row.text"))
    )


def _texts(
    docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, fit_chars: int
) -> list[tuple[str, int]]:
    found = _joined(docs, chosen, id_col, text_col, fit_chars)
    rows = sorted((r.id, r.text, int(r.label)) for r in found.toLocalIterator())
    return [(text, label) for _, text, label in rows]
