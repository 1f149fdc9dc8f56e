"""CSV files with line breaks in quoted cells and with different headers, read in splits.

Whether a line ends inside quotes depends on whether it began inside them, so a line is a function
from that state to the next one. The functions of a split are composed where it is read, a prefix
over the splits of a file gives the state at which each split begins, and with it every line knows
where it stands. Records are put together where their split is read, so that neither lines nor
records are written or shuffled; only of a record that crosses the border of a split its pieces are.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotewell.functions.scalars import normalise_name
from quotewell.sources.stages import Stages

# A cell is quoted if a quote is its first character; a quote within quotes is doubled.
_INSIDE = r'(?:[^"]++|"")*+'
_CELLS = rf'(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+)?,)*+'
OPENS = rf'^{_CELLS}"{_INSIDE}$'  # begun outside quotes, the line ends inside
STAYS = rf'^{_INSIDE}(?:"[^,]*+,{_CELLS}"{_INSIDE})?+$'  # begun inside quotes, it ends inside
SPLIT = ["file", "block"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, the start of their split, and their order in it."""
    read = spark.read.text(path, lineSep="\n")
    quoted = F.contains("value", F.lit('"'))
    return read.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        (quoted & F.rlike("value", F.lit(OPENS))).alias("opens"),
        (~quoted | F.rlike("value", F.lit(STAYS))).alias("stays"),
    )


def _blank(value: str = "value") -> Column:
    return F.trim(F.regexp_replace(value, "[\r\t]", "")) == ""


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Parts of a batch that lie in one split of one file."""
    if not batch.num_rows:
        return
    files = batch.column("file").dictionary_encode().indices.to_numpy()
    blocks = batch.column("block").to_numpy()
    cuts = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
    for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        part = batch.slice(start, end - start)
        yield (part.column("file")[0].as_py(), int(blocks[start])), part


def _changing(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which lines may change the state, and where each leads from outside and from inside."""
    opens = part.column("opens").to_numpy(zero_copy_only=False)
    stays = part.column("stays").to_numpy(zero_copy_only=False)
    return np.flatnonzero(opens | ~stays), opens, stays


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each split as a whole: where it leads from outside and from inside quotes."""
    now, from_out, from_in = None, False, True

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{
            "file": now[0], "block": now[1], "opens": from_out, "stays": from_in}])

    for batch in batches:
        for key, part in _runs(batch):
            if key != now:
                if now:
                    yield row()
                now, from_out, from_in = key, False, True
            at, opens, stays = _changing(part)
            for k in at.tolist():
                from_out = bool(stays[k] if from_out else opens[k])
                from_in = bool(stays[k] if from_in else opens[k])
    if now:
        yield row()


def _joined(lines: list[pa.Array], starts: np.ndarray) -> pa.Array:
    """Lines put together to records, which begin at the given places."""
    values = pa.concat_arrays(lines).cast(pa.string())
    offsets = pa.array(np.append(starts, len(values)), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, values), "\n")


WHOLE, LEFT, BEGUN = 0, 1, 2  # a record, the end of one begun in a split before, the start of one
PIECE = "file string, block long, kind int, first boolean, value string"


def _pieces(
    begin_inside: frozenset[tuple[str, int]], kept: Callable[[int, bool], bool]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function from the lines of splits, in order, to their records and pieces of records.

    ``begin_inside`` names the splits that begin inside quotes; ``kept`` chooses what is returned
    by kind and by whether it is the file's first record. Blank lines are no records.
    """

    def batch_of(key: tuple, kind: int, first: np.ndarray, values: pa.Array) -> pa.RecordBatch:
        n = len(values)
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()),
             pa.array([kind] * n, pa.int32()), pa.array(first, pa.bool_()),
             values.cast(pa.string())],
            names=["file", "block", "kind", "first", "value"])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, inside, heading = None, False, False
        # Lines of the record that the lines read last belong to, if it is not closed yet.
        held: list[pa.Array] = []
        held_kind, held_first = BEGUN, False

        def close(kind: int) -> Iterator[pa.RecordBatch]:
            if held and kept(kind, held_first):
                yield batch_of(now, kind, np.array([held_first]), _joined(held, np.zeros(1, int)))
            held.clear()

        for batch in batches:
            for key, part in _runs(batch):
                if key != now:
                    yield from close(held_kind)
                    now, inside, heading = key, key in begin_inside, key[1] == 0
                    held_kind, held_first = LEFT if inside else BEGUN, False
                at, opens, stays = _changing(part)
                before = np.empty(part.num_rows, bool)
                start = 0
                for k in at.tolist():
                    before[start:k + 1] = inside
                    inside = bool(stays[k] if inside else opens[k])
                    start = k + 1
                before[start:] = inside
                blank = part.column("blank").to_numpy(zero_copy_only=False)
                first = np.zeros(part.num_rows, bool)
                if heading and not blank.all():
                    first[np.argmin(blank)], heading = True, False
                lines = part.column("value")
                starts = np.flatnonzero(~before)
                head = int(starts[0]) if len(starts) else part.num_rows
                if head:
                    held.append(lines.slice(0, head))
                    held_first |= bool(first[:head].any())
                if not len(starts):
                    continue
                yield from close(LEFT if held_kind == LEFT else WHOLE)
                # The last record of the lines is held until it is known to be closed.
                held_kind, whole = BEGUN, starts
                if inside:
                    last, whole = int(starts[-1]), starts[:-1]
                    held.append(lines.slice(last))
                    held_first = bool(first[last:].any())
                    lines = lines.slice(0, last)
                else:
                    held_first = False
                if not len(whole):
                    continue
                count = len(lines) - head
                told = np.add.reduceat(first[head:head + count].astype(int), whole - head) > 0
                sizes = np.diff(np.append(whole, head + count))
                chosen = (sizes > 1) | ~blank[whole]
                chosen &= np.where(told, kept(WHOLE, True), kept(WHOLE, False))
                if chosen.any():
                    values = _joined([lines.slice(head)], whole - head)
                    yield batch_of(now, WHOLE, told[chosen], values.filter(pa.array(chosen)))
        yield from close(held_kind)

    return found


def _split_states(lines: DataFrame, stages: Stages) -> DataFrame:
    """(file, block, inside): whether each split begins inside quotes."""
    effects = stages.write(
        lines.select(*SPLIT, "opens", "stays")
        .mapInArrow(_effects, "file string, block long, opens boolean, stays boolean"),
        "csv-splits",
    )
    up = Window.partitionBy("file").orderBy("block")
    through = up.rowsBetween(Window.unboundedPreceding, 0)
    swaps = F.sum((F.col("opens") & ~F.col("stays")).cast("int")).over(through)
    fixed = F.when(F.col("opens") == F.col("stays"), F.col("opens").cast("int") + F.col("swaps"))
    after = (F.coalesce(F.last("fixed", ignorenulls=True).over(through), F.lit(0))
             + F.col("swaps")) % 2
    states = stages.write(
        effects.withColumn("swaps", swaps).withColumn("fixed", fixed).withColumn("after", after)
        .select(*SPLIT, (F.lag("after", 1, 0).over(up) == 1).alias("inside"), "after"),
        "csv-states",
    )
    open_files = states.groupBy("file").agg(F.max_by("after", "block").alias("after")).where(
        "after = 1").limit(3).collect()
    if open_files:
        raise ValueError(f"a quoted cell is not closed: {[row.file for row in open_files]}")
    return states.drop("after")


def records(spark: SparkSession, path: str, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """(file, value) twice: the first record of each file, and one row per other record.

    The lines are read once for the first records and for the pieces of records that cross a
    split, which are few and are written, and again whenever the others are asked for.
    """
    lines = _lines(spark, path)
    begin_inside = frozenset(
        (row.file, row.block)
        for row in _split_states(lines, stages).where("inside").select(*SPLIT).toLocalIterator())
    told = lines.withColumn("blank", _blank()).select(*SPLIT, "opens", "stays", "blank", "value")
    few = stages.write(
        told.mapInArrow(_pieces(begin_inside, lambda kind, first: first or kind != WHOLE), PIECE),
        "csv-pieces")
    # The end of a record goes with the last one begun in a split before its own.
    place = Window.partitionBy("file").orderBy("block", "kind")
    number = F.sum((F.col("kind") == BEGUN).cast("int")).over(place)
    values = F.transform(F.sort_array(F.collect_list(F.struct("block", "kind", "value"))),
                         lambda piece: piece["value"])
    crossed = (
        few.where(F.col("kind") != WHOLE).withColumn("number", number).groupBy("file", "number")
        .agg(F.max("first").alias("first"), F.array_join(values, "\n").alias("value"))
    )
    whole = told.mapInArrow(
        _pieces(begin_inside, lambda kind, first: kind == WHOLE and not first), PIECE)

    def ended(rows: DataFrame) -> DataFrame:
        return rows.select("file", F.regexp_replace("value", "\r$", "").alias("value"))

    heads = few.where(F.col("kind") == WHOLE).select("file", "value").unionByName(
        crossed.where("first").select("file", "value"))
    rest = whole.select("file", "value").unionByName(
        crossed.where("NOT first").select("file", "value"))
    return ended(heads), ended(rest)


def read_quoted(
    spark: SparkSession, path: str, stages: Stages, options: dict[str, str]
) -> DataFrame:
    """All records of the files at ``path`` as text columns, by the names in their headers.

    The first line that is not blank is a file's header. Names that are equal once normalised are
    one column, spelled as in the first file by name; a file without it has nulls there. Cells may
    hold line breaks; then the lines are placed first, else Spark's own scan is used. A cell that
    is never closed is an error, as is a header that repeats a name.
    """
    lines = _lines(spark, path)
    files = lines.groupBy("file").agg(
        F.bool_or("opens").alias("breaks"),
        F.min_by("value", F.when((F.col("block") == 0) & ~_blank(), F.col("id"))).alias("header"),
    )
    found = stages.write(files, "csv-files")
    if not found.where("breaks").isEmpty():
        heads, rows = records(spark, path, stages)
        heads = stages.write(heads.withColumnRenamed("value", "header"), "csv-heads")
    else:
        heads = found.where("header IS NOT NULL").select(
            "file", F.regexp_replace("header", "\r$", "").alias("header"))
        rows = None
    kinds = heads.groupBy("header").agg(F.min("file").alias("at")).orderBy("at").collect()
    names: dict[str, str] = {}
    places: list[dict[str, int]] = []
    for kind in kinds:
        cells = next(csv.reader([kind.header.removeprefix("﻿")], strict=False))
        keys = [normalise_name(cell) for cell in cells]
        if len(set(keys)) < len(keys):
            raise ValueError(f"{kind['at']}: the header repeats a name: {cells}")
        places.append({key: at for at, key in enumerate(keys)})
        for key, cell in zip(keys, cells, strict=True):
            names.setdefault(key, cell)
    width = max((len(place) for place in places), default=0)
    schema = ", ".join(f"c{k} string" for k in range(width))
    if not kinds:
        return spark.createDataFrame([], "value string").select()
    if rows is None:
        plain = spark.read.schema(schema).options(header="true", enforceSchema="true", **options)
        cells = plain.csv(path).select("*", F.col("_metadata.file_path").alias("file"))
    else:
        parsed = F.from_csv("value", schema, options)
        cells = rows.select("file", parsed.alias("cells")).select("file", "cells.*")
    if len(kinds) == 1:
        kind_of = F.lit(0)
    else:
        numbers = spark.createDataFrame(
            [(kind.header, number) for number, kind in enumerate(kinds)],
            "header string, kind int")
        cells = cells.join(
            stages.write(heads.join(numbers, "header").select("file", "kind"), "csv-kinds"),
            "file")
        kind_of = F.col("kind")

    def cell(key: str) -> Column:
        chosen = F.lit(None).cast("string")
        for number, place in enumerate(places):
            if key in place:
                chosen = F.when(kind_of == number, F.col(f"c{place[key]}")).otherwise(chosen)
        return chosen

    return cells.select(*[cell(key).alias(name) for key, name in names.items()])
