"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Each level looks only at documents that still share their key with another one. Only counts per
key are grouped, with map-side combining, so a third of all rows under one key is one row per
task. Text is hashed in full only where length and prefix are both shared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.llm.common import ascii_lower, free_name, whole_text
from quotewell.sources.stages import Stages

PREFIX_CHARS = 64


def _length(text: Column) -> Column:
    return F.octet_length(text)


def _prefix(text: Column, chars: int) -> Column:
    return F.xxhash64(ascii_lower(F.substring(text, 1, chars)))


def _shared_prefixes(docs: DataFrame, stages: Stages, text_col: str, chars: int) -> DataFrame:
    """A stage table of the (bytes, prefix) that several rows share."""
    text = whole_text(text_col)
    rows = docs.select(_length(text).alias("bytes"), _prefix(text, chars).alias("prefix"))
    # Unused columns are pruned: the first level evaluates the length only.
    lengths = stages.write(
        rows.groupBy("bytes").count().where("count > 1").select("bytes"), "dedup-lengths"
    )
    return stages.write(
        rows.join(lengths, "bytes", "left_semi").groupBy("bytes", "prefix").count()
        .where("count > 1").select("bytes", "prefix"),
        "dedup-prefixes",
    )


def _survivors(
    docs: DataFrame, prefixes: DataFrame, stages: Stages, id_col: str, text_col: str, chars: int
) -> tuple[DataFrame, DataFrame]:
    """Stage tables: (id, full) of the rows that share length and prefix, and the groups of
    several rows with one full hash."""
    text = whole_text(text_col)
    keyed = docs.select(
        F.col(id_col).alias("id"), _length(text).alias("bytes"),
        _prefix(text, chars).alias("prefix"), text.alias("text"),
    )
    survivors = stages.write(
        keyed.join(prefixes, ["bytes", "prefix"], "left_semi")
        .select("id", F.sha2(ascii_lower(F.col("text")), 256).alias("full")),
        "dedup-survivors",
    )
    groups = stages.write(
        survivors.groupBy("full").agg(F.max("id").alias("keep_id"), F.count("*").alias("size"))
        .where("size > 1"),
        "dedup-groups",
    )
    return survivors, groups


def exact_dedup(
    docs: DataFrame,
    stages: Stages,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    digest_all: bool = False,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty, so null and
    empty texts form one group. Of equal texts the row with the largest id stays. Rows that repeat
    an id and its text agree on ``kept`` and each count in ``group_size``. A row without an id
    counts in its group; it stays only if the whole group has no id. Other columns of ``docs``
    are ignored. ``text_sha256`` is null for documents that needed no full hash, unless
    ``digest_all`` asks for it. Without rows the result is empty.
    """
    prefixes = _shared_prefixes(docs, stages, text_col, prefix_chars)
    survivors, groups = _survivors(docs, prefixes, stages, id_col, text_col, prefix_chars)
    text = whole_text(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        _length(text).alias("bytes"),
        _prefix(text, prefix_chars).alias("prefix"),
        F.sha2(ascii_lower(text), 256).alias("full"),
    )
    single = rows.join(prefixes, ["bytes", "prefix"], "left_anti").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        (F.col("full") if digest_all else F.lit(None).cast("string")).alias("text_sha256"),
    )
    # A group without any id has keep_id null, which its rows must not take for "not grouped".
    grouped = survivors.join(groups, "full", "left").select(
        "id",
        F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("full").alias("text_sha256"),
    )
    return single.union(grouped).select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )


def drop_copies(
    docs: DataFrame, stages: Stages, id_col: str = "doc_id", text_col: str = "text",
    prefix_chars: int = PREFIX_CHARS,
) -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`exact_dedup` keeps.

    Rows go by id and text, since an id may be repeated with another text. Of rows that repeat a
    kept id and its text any one stays; rows without an id stay. Rows that share their length and
    prefix with no other go straight through; only the rest is hashed and joined.
    """
    prefixes = _shared_prefixes(docs, stages, text_col, prefix_chars)
    survivors, groups = _survivors(docs, prefixes, stages, id_col, text_col, prefix_chars)
    full = free_name(docs, "full_hash")
    gone, same = free_name(docs, "dropped_id"), free_name(docs, "dropped_hash")
    # Within a group only the largest id is kept. A single row is no group, but a kept row may be
    # repeated, and then it is in one.
    counts = stages.write(
        survivors.where("id IS NOT NULL").join(groups, "full")
        .groupBy(F.col("id").alias(gone), F.unhex("full").alias(same))
        .agg(F.min(F.col("id") == F.col("keep_id")).alias("kept"), F.count("*").alias("rows"))
        .where("not kept or rows > 1"),
        "dedup-dropped",
    )
    length, prefix = free_name(docs, "n_bytes"), free_name(docs, "prefix_hash")
    text = whole_text(text_col)
    keyed = docs.withColumns({length: _length(text), prefix: _prefix(text, prefix_chars)})
    on = (F.col(length) == prefixes["bytes"]) & (F.col(prefix) == prefixes["prefix"])
    single = keyed.join(prefixes, on, "left_anti")
    shared = keyed.join(prefixes, on, "left_semi").withColumn(
        full, F.unhex(F.sha2(ascii_lower(text), 256)))
    match = (F.col(id_col) == F.col(gone)) & (F.col(full) == F.col(same))
    left = shared.join(counts.select(gone, same), match, "left_anti")
    repeated = counts.where("kept").select(gone, same)
    once = shared.join(repeated, match, "left_semi").dropDuplicates([id_col, full])
    kept = left.unionByName(once).select(*docs.columns)
    return single.select(*docs.columns).unionByName(kept)
