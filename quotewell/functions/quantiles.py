"""Exact group quantiles that never hold one group's values in a single task.

``percentile`` keeps every distinct value of a group in one task's hash map. With a handful of
commodities and a very long table that map has no bound. Here the distinct values are counted
first (combined before the shuffle, spread by value, so a hot commodity or a hot price costs
nothing extra), each with a cell that rises with the value. Running totals over the cells tell
which of them hold a wanted rank; those are cut into finer cells until each of them fits a task,
and only they are sorted. There is one way for every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewell.sources.stages import Stages

CELLS_PER_UNIT = 1 << 16
LAST_CELL = (1 << 63) - 1
FINER = 1 << 12  # finer cells of a cell
CELL_ROWS = 1 << 22  # distinct values that one task sorts


def _present(value: str, keys: Sequence[str]) -> Column:
    present = F.col(value).isNotNull()
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


def cell(value: Column) -> Column:
    """A whole number that never falls as the value rises, some 0.1 % of the value wide.

    Roots, products with powers of two and floors keep the order of doubles exactly, as each of
    them is the rounded true result. Infinity and NaN, which counts as the largest, lie apart.
    """
    root = F.abs(value)
    for _ in range(6):
        root = F.sqrt(root)
    number = F.floor(root * CELLS_PER_UNIT)
    return F.when(F.isnan(value), F.lit(LAST_CELL)).when(value < 0, -number).otherwise(number)


def value_counts(
    df: DataFrame, value: str, keys: Sequence[str], stages: Stages, keep_missing: bool = False
) -> DataFrame:
    """A stage table of the distinct (group, value) pairs: ``keys``, ``_value``, ``_n`` (rows)
    and ``_cell``, which rises with the value.

    Rows with a NULL value or a NULL group key do not count, unless they are to be kept.
    """
    counts = (
        (df if keep_missing else df.where(_present(value, keys)))
        .groupBy(*keys, F.col(value).cast("double").alias("_value"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_cell", cell(F.col("_value")))
    )
    return stages.write(counts, "value-counts")


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: dict[str, float],
    by: Sequence[str],
    stages: Stages,
) -> DataFrame:
    """One row per group: ``by``, then one column per entry of ``quantiles``.

    Linear interpolation between the two neighbouring order statistics. Rows with a NULL value
    or a NULL group key do not count; a group without values has no row.
    """
    keys = list(by)
    if not keys:
        keys, df = ["_all"], df.withColumn("_all", F.lit(0))
    counts = value_counts(df, value, keys, stages)
    return _by_rank(counts, quantiles, keys, stages).select(*by, *quantiles)


def summary(
    df: DataFrame,
    value: str,
    quantiles: dict[str, float],
    by: Sequence[str],
    stages: Stages,
) -> DataFrame:
    """One row per group, groups with a NULL key among them: ``by``, ``n`` (values that are not
    NULL), ``mean``, ``std`` of the sample, ``min``, ``max`` and the exact quantiles.

    The input is read once; all else comes from the table of its distinct values. Deviations are
    taken from the mean before they are squared, so that nothing cancels. Quantiles of a group
    with a NULL key are NULL, as is ``std`` of fewer than two values.
    """
    keys = list(by)
    if not keys:
        keys, df = ["_all"], df.withColumn("_all", F.lit(0))
    counts = value_counts(df, value, keys, stages, keep_missing=True)
    rows = F.when(F.col("_value").isNotNull(), F.col("_n"))
    groups = counts.groupBy(*keys).agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("n"),
        F.try_divide(F.sum(F.col("_value") * F.col("_n")), F.sum(rows)).alias("mean"),
        F.min("_value").alias("min"),
        F.max("_value").alias("max"),
    )
    centres = groups.select(*[F.col(key).alias(f"_of_{key}") for key in keys],
                            F.col("mean").alias("_mean"))
    match = F.lit(True)
    for key in keys:
        match = match & F.col(key).eqNullSafe(F.col(f"_of_{key}"))
    off = F.col("_value") - F.col("_mean")
    spread = (
        counts.where("_value IS NOT NULL").join(centres, match)
        .groupBy(*[F.col(key).alias(f"_of_{key}") for key in keys])
        .agg(F.sum(off * off * F.col("_n")).alias("_squares"))
    )
    ranked = _by_rank(counts.where(_present("_value", keys)), quantiles, keys, stages)
    ranked = ranked.select(*[F.col(key).alias(f"_in_{key}") for key in keys], *quantiles)
    found = F.lit(True)
    for key in keys:
        found = found & (F.col(key) == F.col(f"_in_{key}"))
    std = F.when(F.col("n") > 1, F.sqrt(F.col("_squares") / (F.col("n") - 1)))
    return groups.join(spread, match, "left").join(ranked, found, "left").select(
        *by, "n", "mean", std.alias("std"), "min", "max", *quantiles)


def _position(prob: float) -> Column:
    return F.lit(prob) * (F.col("_total") - 1)


def _wanted_cells(rows: DataFrame, quantiles: dict[str, float], keys: list[str]) -> DataFrame:
    """The cells that hold a wanted rank, with the ranks, their size and the rows below them."""
    group = Window.partitionBy(*keys)
    parent = Window.partitionBy(*keys, "_below")
    earlier = parent.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.max("_whole") if "_total" in rows.columns else F.sum("_held")
    ranks = F.array_distinct(
        F.array(*[side(_position(p)) for p in quantiles.values() for side in (F.floor, F.ceil)])
    )
    return (
        rows.groupBy(*keys, "_below", "_cell")
        .agg(
            F.sum("_n").alias("_held"),
            F.count("*").alias("_rows"),
            F.min("_value").alias("_low"),
            F.max("_value").alias("_high"),
            *([F.max("_total").alias("_whole")] if "_total" in rows.columns else []),
        )
        .withColumns(
            {
                "_before": F.col("_below") + F.coalesce(F.sum("_held").over(earlier), F.lit(0)),
                "_total": whole.over(group),
            }
        )
        .withColumn(
            "_ranks",
            F.filter(
                ranks,
                lambda rank: (rank >= F.col("_before"))
                & (rank < F.col("_before") + F.col("_held")),
            ),
        )
        .where(F.size("_ranks") > 0)
        .select(*keys, "_below", "_cell", "_before", "_total", "_ranks", "_rows", "_low", "_high")
    )


def _by_rank(
    counts: DataFrame, quantiles: dict[str, float], keys: list[str], stages: Stages
) -> DataFrame:
    # ``_below`` is the number of rows below a cell's parent, and so names the parent.
    rows = counts.select(*keys, F.lit(0).cast("bigint").alias("_below"), "_cell", "_value", "_n")
    while True:
        wanted = stages.write(_wanted_cells(rows, quantiles, keys), "wanted-cells")
        held = rows.drop("_total").join(wanted, [*keys, "_below", "_cell"])
        if (wanted.agg(F.max("_rows")).first()[0] or 0) <= CELL_ROWS:
            break
        # Halves, since two finite doubles may lie further apart than any finite one.
        width = F.col("_high") / 2 - F.col("_low") / 2
        part = F.floor(F.try_divide(F.col("_value") / 2 - F.col("_low") / 2, width) * FINER)
        finer = held.select(
            *keys, F.col("_before").alias("_below"), F.coalesce(part, F.lit(0)).alias("_cell"),
            "_value", "_n", "_total",
        )
        rows = stages.write(finer, "finer-cells")

    # Sort only the cells that hold a wanted rank.
    within = Window.partitionBy(*keys, "_before").orderBy("_value")
    picked = (
        held.withColumn("_upto", F.col("_before") + F.sum("_n").over(within))
        .withColumn("_rank", F.explode("_ranks"))
        .where((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n")))
    )

    def at(rank: Column) -> Column:
        return F.max(F.when(F.col("_rank") == rank, F.col("_value")))

    columns = []
    for name, prob in quantiles.items():
        position = _position(prob)
        low, high = at(F.floor(position)), at(F.ceil(position))
        share = F.max(position - F.floor(position))
        columns.append(
            F.when(low == high, low).otherwise(low * (1 - share) + high * share).alias(name)
        )
    return picked.groupBy(*keys).agg(*columns)
