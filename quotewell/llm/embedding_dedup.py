"""Near-duplicate vectors: iterative quantisation, multi-index Hamming tables, exact rerank.

Unit vectors are projected on their principal axes and rotated so that signs lose least; the
rotation alternates between codes and the best rotation for them. It is learnt about the mean of
the sample, but the signs are those of the vectors themselves: a cosine bounds the angle of a pair
about the origin only. Several rotations from different starts give several codes. Each code is cut into substrings, and each substring is a table: two
vectors that agree on one substring meet in a bucket. There they are compared on all their codes,
once per pair, and what is near enough is reranked by cosine on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.llm.common import lowest
from quotewell.llm.components import components
from quotewell.sources.stages import Stages

COSINE = 0.93
FIT_ROWS = 10_000
ROUNDS = 20
SEED = 61
MISSED = 0.01  # wanted share of pairs at the threshold that share no bucket
LEAST_BITS = 8  # of a substring
LEAST_PER_BUCKET = 4  # vectors of an even bucket, from which substrings get longer
SLACK = 5.0  # standard errors by which the code distance of a pair may exceed its angle's
BLOCK = 1024


class Codes:
    """``rotations`` sign codes of unit vectors of one length, one row of bits per code."""

    def __init__(self, sample: np.ndarray, size: int, rotations: int):
        rng = np.random.default_rng(SEED + size)
        mean = sample.mean(0) if len(sample) else np.zeros(size)
        self.matrices = []
        for _ in range(rotations):
            turn = np.linalg.qr(rng.standard_normal((size, size)))[0]
            if len(sample) > size:
                drawn = sample[rng.integers(0, len(sample), len(sample))] - mean
                axes = np.linalg.svd(drawn, full_matrices=False)[2].T
                flat = drawn @ axes
                for _ in range(ROUNDS):
                    signs = np.where(flat @ turn >= 0, 1.0, -1.0)
                    left, _, right = np.linalg.svd(flat.T @ signs)
                    turn = left @ right
                turn = axes @ turn
            self.matrices.append(turn)

    def bits(self, unit: np.ndarray) -> np.ndarray:
        """(vectors, all bits), code after code."""
        return np.concatenate([unit @ m >= 0 for m in self.matrices], axis=1)


def substring_bits(vectors: int) -> int:
    """Longer substrings for more vectors, so that an even bucket stays small."""
    return max(LEAST_BITS, math.ceil(math.log2(max(1, vectors) / LEAST_PER_BUCKET)))


def tables_for(bits: int, cosine: float) -> int:
    """Tables after which a pair at the threshold has met in one, but for ``MISSED``."""
    agree = (1 - math.acos(min(1.0, cosine)) / math.pi) ** bits
    return max(1, math.ceil(math.log(MISSED) / math.log1p(-agree)))


def usable(vector: Column, label: Column) -> Column:
    """Label and vector are there, and all components are finite and not all zero."""
    real = vector.cast("array<double>")
    finite = F.forall(real, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(
        label.isNotNull() & vector.isNotNull() & finite & F.exists(real, lambda x: x != 0),
        F.lit(False),
    )


def _units(column) -> list[np.ndarray]:
    rows = [np.array(v, np.float64) for v in column.to_pylist()]
    scaled = [r / np.abs(r).max() for r in rows]
    return [r / np.linalg.norm(r) for r in scaled]


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Vectors of one length, each divided by its largest component, so that no square overflows."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = rows.reshape(len(column), -1)
    return rows / np.abs(rows).max(1, keepdims=True)


def cosines(left: pa.ListArray, right: pa.ListArray) -> np.ndarray:
    """Cosine of each pair in double precision; the vectors of a pair have the same length."""
    out = np.empty(len(left))
    lengths = left.value_lengths().to_numpy()
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        x, y = _matrix(left.take(pa.array(at))), _matrix(right.take(pa.array(at)))
        out[at] = (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1))
    return out


def _bucket_pairs(rows: pa.Table, table: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one bucket (or of its two blocks) near in code that met in no earlier table."""
    ids = rows.column("id").to_numpy()
    sides = rows.column("block").to_numpy()
    packed = np.stack([np.frombuffer(c.as_buffer(), np.uint64) for c in rows.column("code")])
    keys = np.stack([np.frombuffer(k.as_buffer(), np.int64) for k in rows.column("keys")])
    two = sides.min() != sides.max()
    left, right = [], []
    for i in range(len(ids) - 1):
        far = np.bitwise_count(packed[i + 1:] ^ packed[i]).sum(1, dtype=np.int64)
        good = far <= limit
        if two:
            good &= sides[i + 1:] != sides[i]
        others = np.flatnonzero(good) + i + 1
        if len(others) and table:
            others = others[~(keys[others, :table] == keys[i, :table]).any(1)]
        left.append(np.minimum(ids[others], ids[i]))
        right.append(np.maximum(ids[others], ids[i]))
    return (np.concatenate(left), np.concatenate(right)) if left else (ids[:0], ids[:0])


def near_vectors(
    vectors: DataFrame,
    stages: Stages,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    least: float = COSINE,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Vectors with the same label are linked from a cosine of ``least`` on. Null, empty and zero
    vectors, vectors with null or non-finite components and vectors without a label have no links;
    nor have vectors of different lengths. Equal vectors are one class with the smallest id as its
    representative, and each links with all others of its class. Ids are integers; a row without
    one is not compared and is kept; rows that repeat an id and vector count as separate vectors.
    The quantiser is fitted to at most ``FIT_ROWS`` vectors, chosen by a hash; every row is
    indexed. Other columns are ignored. Without rows the result is empty.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"),
        F.col(label_col).cast("string").alias("label"),
    )
    ready = rows.withColumn(
        "usable", usable(F.col("vector"), F.col("label")) & F.col("id").isNotNull()
    ).withColumn("class", F.when(F.col("usable"), F.sha2(
        F.concat_ws(",", "label", F.array_join(F.col("vector").cast("array<string>"), " ")), 256)))
    classes = stages.write(
        ready.where("usable").groupBy("class")
        .agg(F.min("id").alias("rep"), F.count("*").alias("size"),
             F.first("vector").alias("vector"), F.first("label").alias("label")),
        "vec-classes",
    )
    total = classes.count()
    n_bits = substring_bits(total)
    n_tables = tables_for(n_bits, least)
    hashed = classes.select(F.xxhash64("class").alias("at"), "vector")
    sample = lowest(hashed, "at", "vector", FIT_ROWS, total).column("vector")
    by_size: dict[int, list[np.ndarray]] = {}
    for unit in _units(sample):
        by_size.setdefault(len(unit), []).append(unit)
    fitted = vectors.sparkSession.sparkContext.broadcast({
        size: Codes(np.array(units), size, -(-n_tables // max(1, size // n_bits)))
        for size, units in by_size.items()
    })
    chance = math.acos(min(1.0, least)) / math.pi

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = dict(fitted.value)
        for batch in batches:
            codes, keys = [], []
            for unit in _units(batch.column(2)):
                size = len(unit)
                if size not in models:  # a length that the sample lacks: random rotations
                    models[size] = Codes(np.empty((0, size)), size,
                                         -(-n_tables // max(1, size // n_bits)))
                bits = models[size].bits(unit[None])[0]
                step = max(1, size // n_bits)
                cuts = [bits[c * size + k * n_bits:c * size + min(size, (k + 1) * n_bits)]
                        for c in range(len(models[size].matrices)) for k in range(step)]
                packed = np.packbits(bits).tobytes()
                codes.append(packed + bytes(-len(packed) % 8))
                keys.append(np.array(
                    [int("1" + "".join("01"[int(b)] for b in cut), 2) for cut in cuts[:n_tables]],
                    np.int64).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([len(v) for v in batch.column(2)], pa.int32()),
                 pa.array(codes, pa.binary()), pa.array(keys, pa.binary())],
                ["id", "label", "length", "code", "keys"],
            )

    coded = stages.write(
        classes.select(F.col("rep").alias("id"), "label", "vector")
        .mapInArrow(encode, "id long, label string, length int, code binary, keys binary"),
        "vec-codes",
    )
    hashed = coded.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(n_tables - 1))))
    hashed = hashed.withColumn(
        "bucket", F.xxhash64("label", "length", "place",
                             F.substring("keys", F.col("place") * 8 + 1, F.lit(8)))
    )
    buckets = stages.write(
        hashed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "vec-buckets"
    )
    blocks = F.ceil(F.col("size") / block).cast("int")
    dealt = (
        hashed.join(buckets, "bucket")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("bucket", F.least("block", "other").alias("low"),
                F.greatest("block", "other").alias("high"), "block", "place", "length",
                "id", "code", "keys")
    )

    def meet(rows: pa.Table) -> pa.Table:
        size = rows.column("length")[0].as_py()
        n = size * -(-n_tables // max(1, size // n_bits))
        limit = int(n * chance + SLACK * math.sqrt(n * chance * (1 - chance)) + 1)
        a, b = _bucket_pairs(rows, rows.column("place")[0].as_py(), limit)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    pairs = dealt.groupBy("bucket", "low", "high").applyInArrow(meet, "a long, b long")

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = cosines(batch.column(2), batch.column(3)) >= least
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    first = classes.select(F.col("rep").alias("a"), F.col("vector").alias("x"))
    second = classes.select(F.col("rep").alias("b"), F.col("vector").alias("y"))
    links = stages.write(
        stages.write(pairs, "vec-pairs").join(first, "a").join(second, "b")
        .select("a", "b", "x", "y").mapInArrow(rerank, "a long, b long"),
        "vec-links",
    )
    labels = components(links, stages)
    sizes = classes.select(F.col("rep").alias("other"), F.col("size").alias("weight"))
    linked = links.union(links.select("b", "a")).toDF("rep", "other").join(sizes, "other")
    linked = linked.groupBy("rep").agg(F.sum("weight").alias("outside"))
    summary = stages.write(
        classes.select("class", "rep", "size").join(linked, "rep", "left")
        .join(labels, F.col("rep") == labels["node"], "left")
        .select("class", (F.col("size") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id")),
        "vec-summary",
    )
    return ready.select("id", "class").join(summary, "class", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component_id", "id")).alias("kept"),
    )
