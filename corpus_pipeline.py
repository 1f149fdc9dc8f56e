"""A corpus pipeline: each stage is one operator of ``quotewell.llm`` over what the last one kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.llm import exact_dedup, minhash, packing, quality, secret_scan
from quotewell.llm.common import free_name
from quotewell.llm.labelled import fit_sample, fold
from quotewell.sources.stages import Stages


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking puts below its threshold go.

    The ranking is fitted to labelled rows of ``documents`` outside the held-out third. Without
    any labelled row nothing is known of quality, and all documents stay.
    """
    held_out = fold("doc_id", 3) == 1
    source = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    sample = fit_sample(source, labels, "quality", ~held_out, Stages(spark))
    if not sample:
        return docs
    model = quality.fit(sample)
    score = free_name(docs, "quality_score")
    return quality.score(docs, model, score).where(F.col(score) >= 0.5).drop(score)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, that with the largest id."""
    return exact_dedup.drop_copies(docs, Stages(spark))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id."""
    return minhash.drop_near_copies(docs, Stages(spark))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by the name of its kind; ``n_chars``, if there, follows the text."""
    name = free_name(docs, "clean_text")
    found = secret_scan.clean(docs, secret_scan.fit(docs), clean_col=name)
    clean = F.col(name)
    columns = {"text": F.coalesce(clean, "text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.coalesce(F.char_length(clean), "n_chars").cast(kind)
    return found.withColumns(columns).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining tokens in sequences of 2048, each piece with its ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), ids_col="ids")


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", exact),
    ("minhash near dedup", near),
    ("secret scan", secrets),
    ("packing", packed),
]

# SQL can express neither the fitted models nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each result is written and read by the next."""
    stages = Stages(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stages.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
