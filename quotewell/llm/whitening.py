"""Whitening of vectors by the polarisation identity on exact integers.

Entries become integers. Squares of centred values are summed exactly for every dimension and for
the sum of every two dimensions; since var(a + b) = var(a) + var(b) + 2 cov(a, b), differences of
these variances are twice the covariances, with no product of two dimensions. Only sums, of a
number given by the dimension alone, reach the driver, where the covariance is decomposed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from quotewell.llm.common import free_name
from quotewell.sources.stages import Stages

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
BATCH_VALUES = 1 << 21  # entries of vectors taken at once
LARGEST = 2.0**40  # from this size on a double no longer tells scaled entries apart well
SUMS = "position int, total decimal(38,0)"


def usable(vector: Column) -> Column:
    """The vector is there and all entries are finite and of a size that can be summed exactly."""
    finite = F.forall(vector.cast("array<double>"), lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < LARGEST), F.lit(False)))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def _integers(column: pa.ListArray, dimension: int) -> Iterator[np.ndarray]:
    """The vectors of a batch as rows of integers, a bounded number of them at a time."""
    step = max(1, BATCH_VALUES // max(1, dimension))
    for start in range(0, len(column), step):
        part = column.slice(start, step)
        values = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        yield np.floor(values * SCALE).astype(np.int64).reshape(len(part), dimension) + SHIFT


def _exact(values: np.ndarray, most: int) -> np.ndarray:
    """``values`` as they are where ``most`` bounds all sums made of them, else Python integers."""
    return values if most < 1 << 62 else values.astype(object)


def _column_sums(x: np.ndarray) -> list[int]:
    largest = int(np.abs(x).max(initial=0))
    return [int(v) for v in _exact(x, largest * len(x)).sum(0)]


def _square_sums(x: np.ndarray) -> list[int]:
    """Sums of squares of every dimension, then of the sum of every two, in order."""
    largest = 2 * int(max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))))
    y = _exact(x, largest * largest * len(x))
    parts = [(y * y).sum(0)]
    for i in range(y.shape[1] - 1):
        both = y[:, i + 1:] + y[:, i:i + 1]
        parts.append((both * both).sum(0))
    return [int(v) for v in np.concatenate(parts)]


def _summed(vectors: DataFrame, dimension: int, centre: list[int] | None) -> list[int]:
    """Exact sums over all rows: of each entry, or if a centre is given of the centred squares.

    Each task sends one row per sum, whatever its rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = dimension if centre is None else dimension * (dimension + 1) // 2
        totals = [0] * size
        for batch in batches:
            for x in _integers(batch.column(0), dimension):
                if centre is None:
                    found = _column_sums(x)
                else:
                    middle = np.array(centre, np.int64)
                    found = _square_sums(x - middle)
                totals = [a + b for a, b in zip(totals, found, strict=True)]
        kind = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array(map(Decimal, totals), kind)],
            names=["position", "total"],
        )

    parts = vectors.select("vector").mapInArrow(run, SUMS)
    rows = parts.groupBy("position").agg(F.sum("total").alias("total")).orderBy("position")
    found = [int(row.total) for row in rows.collect()]
    return found or [0] * (dimension if centre is None else dimension * (dimension + 1) // 2)


@dataclass(frozen=True)
class Whitening:
    """Sums of the fit list and the components of its covariance, by falling eigenvalue."""

    n: int
    sums: list[int]
    vectors: np.ndarray  # one row per component
    values: np.ndarray
    trace: float

    @property
    def defined(self) -> np.ndarray:
        """Which components have a variance beyond rounding."""
        return self.values > self.trace * len(self.sums) * 4 * np.finfo(float).eps

    def explained(self) -> list[float | None]:
        return [float(v / self.trace) if self.trace else None for v in self.values]


def covariance(n: int, sums: list[int], squares: list[int], centre: list[int]) -> np.ndarray:
    """n * n times the covariance, each entry rounded once from an exact integer.

    ``squares`` are about the integer ``centre``; with r = sum - n * centre left over, the sum of
    (n * z - sum(z))^2 over the list is n^2 * squares - n * r^2, exactly.
    """
    d = len(sums)
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    spread = [n * n * squares[i] - n * rest[i] ** 2 for i in range(d)]
    matrix = np.zeros((d, d))
    position = d
    for i in range(d):
        matrix[i, i] = Fraction(spread[i], n)
        for j in range(i + 1, d):
            both = n * n * squares[position] - n * (rest[i] + rest[j]) ** 2
            matrix[i, j] = matrix[j, i] = Fraction(both - spread[i] - spread[j], 2 * n)
            position += 1
    return matrix


def fit(vectors: DataFrame, dimension: int, n: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of all rows of (vector); every vector has ``dimension`` entries."""
    sums = _summed(vectors, dimension, None)
    centre = [s // n for s in sums]
    squares = _summed(vectors, dimension, centre)
    scaled = covariance(n, sums, squares, centre) / (float(n) * n)
    values, columns = np.linalg.eigh(scaled)
    order = np.argsort(-values, kind="stable")[:components]
    return Whitening(n, sums, columns[:, order].T.copy(), np.maximum(values[order], 0.0),
                     float(np.trace(scaled)))


def _identity_error(rows: DataFrame, array: str, defined: list[int], n: int) -> float | None:
    """Largest absolute entry of the covariance of the whitened values minus the identity."""
    if not defined:
        return None
    value = {a: F.col(array)[a] for a in defined}
    means = rows.agg(*[F.avg(value[a]).alias(f"m{a}") for a in defined]).first()
    pairs = [(a, b) for a in defined for b in defined if a <= b]
    found = rows.agg(*[
        (F.sum((value[a] - means[f"m{a}"]) * (value[b] - means[f"m{b}"])) / n).alias(f"c{a}_{b}")
        for a, b in pairs
    ]).first()
    return max(abs(found[f"c{a}_{b}"] - (a == b)) for a, b in pairs)


def whiten(
    vectors: DataFrame,
    stages: Stages,
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    whitened_col: str = "whitened",
    deviation_col: str = "deviation",
) -> tuple[DataFrame, Whitening | None, float | None]:
    """Rows with a usable vector, all their columns kept, plus whitened values and deviation.

    A vector is usable if it is there and all entries are finite and below 2^40 in size; other
    rows are dropped. All usable vectors must have one length, else ``ValueError``. Each entry c
    counts as floor(1024 c) + 100000. ``whitened`` has one value per component, null for one
    without variance (equal vectors, fewer rows than components); ``deviation`` is the sum over
    dimensions of (n x - S)^2, null where that does not fit a long. Equal vectors get equal
    values, and repeated rows count as often as they occur. Columns of the two names are replaced.
    Without usable rows the result is empty, without a model. Also returned: the fitted model and
    the identity error of the whitened values, None without a component that has variance.
    """
    held = free_name(vectors, "vector")
    ready = vectors.where(usable(F.col(vector_col)))
    sizes = ready.agg(
        F.count("*").alias("n"), F.min(F.size(vector_col)).alias("least"),
        F.max(F.size(vector_col)).alias("most"),
    ).first()
    kept = [name for name in vectors.columns
            if name.lower() not in (whitened_col.lower(), deviation_col.lower())]
    schema = StructType([
        *[vectors.schema[name] for name in kept],
        StructField(deviation_col, LongType()),
        StructField(whitened_col, ArrayType(DoubleType())),
    ])
    if not sizes.n:
        return vectors.sparkSession.createDataFrame([], schema), None, None
    if sizes.least != sizes.most:
        raise ValueError(f"vectors have {sizes.least} to {sizes.most} entries")
    d, n = sizes.most, sizes.n
    model = fit(ready.select(F.col(vector_col).alias("vector")), d, n, components)
    defined = model.defined
    scale = np.where(defined, 1 / np.sqrt(np.where(defined, model.values, 1.0)), np.nan)
    centre = [s // n for s in model.sums]
    rest = [s - n * c for s, c in zip(model.sums, centre, strict=True)]
    sent = (model.vectors, scale, centre, rest, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes, factors, middle, left, rows = sent
        middle, fraction = np.array(middle, np.int64), np.array([r / rows for r in left])
        remainder = sum(r * r for r in left)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            step = max(1, BATCH_VALUES // max(1, d))
            for start, x in zip(range(0, len(column), step), _integers(column, d), strict=True):
                part = batch.slice(start, step)
                y = x - middle
                largest = int(np.abs(y).max(initial=0)) + 1
                exact = _exact(y, largest * max(largest, rows) * max(1, d))
                own, cross = (exact * exact).sum(1), (exact * np.array(left, exact.dtype)).sum(1)
                deviation = [rows * rows * int(a) - 2 * rows * int(b) + remainder
                             for a, b in zip(own, cross, strict=True)]
                values = ((y - fraction) @ axes.T) * factors
                flat = pa.array(values.reshape(-1), from_pandas=True)
                width = values.shape[1]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(part) + 1, dtype=np.int32) * width), flat)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1],
                     pa.array([v if v < 1 << 63 else None for v in deviation], pa.int64()), lists],
                    names=[*kept, deviation_col, whitened_col],
                )

    made = stages.write(
        ready.select(*kept, F.col(vector_col).alias(held)).mapInArrow(run, schema), "whitened")
    used = [k for k in range(len(defined)) if defined[k]]
    return made, model, _identity_error(made, whitened_col, used, n)
