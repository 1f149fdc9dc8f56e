"""Near-duplicates by min-max hashing, banding and confirmation on full shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewell.llm import workers
from quotewell.llm.bpe import slices
from quotewell.llm.common import whole_text, without_ids
from quotewell.llm.components import components
from quotewell.sources.stages import Stages

PERMUTATIONS = 64  # each gives a minimum and a maximum
BAND_ROWS = 4
SEED = 41
REMEMBERED = 150_000
PACKED_BYTES = 16 << 20  # sets of a block held as bits; beyond, they are marked one by one
TRIM_BYTES = 4 << 20
BLOCK_SHINGLES = 1 << 19  # of all documents in a block, so that long ones make smaller blocks


class WordHashes(dict):
    """Word to a 64-bit hash, for the words seen last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(text: str, size: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b"\n".join(words), seed=1)], np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(words) - size + 1
    mixed = hashes[:n].copy()
    for k in range(1, size):
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed += hashes[k:k + n]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def permutations(seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = rng.integers(0, 2**63, (2, PERMUTATIONS), dtype=np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def signature(hashes: np.ndarray, factors: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Minimum and maximum under each permutation, side by side."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(len(factors), np.uint64)
    for start in range(0, len(hashes), 4096):
        images = (hashes[None, start:start + 4096] ^ masks[:, None]) * factors[:, None]
        np.minimum(low, images.min(1), out=low)
        np.maximum(high, images.max(1), out=high)
    return np.stack([low, high], 1).ravel()


def band_hashes(signed: np.ndarray) -> np.ndarray:
    """One 64-bit hash per band, different for equal values in different bands."""
    rows = signed.reshape(-1, BAND_ROWS)
    return np.array(
        [xxhash.xxh3_64_intdigest(row.tobytes(), seed=k + 1) for k, row in enumerate(rows)],
        np.uint64,
    ).view(np.int64)


def similar(shared, size_a, size_b, percent: int):
    return 100 * shared >= percent * (size_a + size_b - shared)


SIGNED = "id long, n_shingles long, set_key binary, bands array<long>"


def sign(texts: DataFrame, shingle: int) -> DataFrame:
    """Set size, a 128-bit key of the whole set, and band hashes of each (id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("minhash")
        known = WordHashes()
        factors, masks = permutations()
        for batch in batches:
            for part in slices(batch, 1):
                sets = [shingle_hashes(t, shingle, known) for t in part.column(1).to_pylist()]
                bands = [
                    band_hashes(signature(s, factors, masks)).tolist() if len(s) else []
                    for s in sets
                ]
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(map(len, sets), pa.int64()),
                     pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    ["id", "n_shingles", "set_key", "bands"],
                )
        workers.trim()

    return texts.mapInArrow(run, SIGNED)


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """The whole shingle set of each (id, text), as packed sorted hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("minhash")
        known = WordHashes()
        for batch in batches:
            for part in slices(batch, 1):
                sets = [
                    shingle_hashes(t, shingle, known).tobytes()
                    for t in part.column(1).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sets, pa.binary())], ["id", "shingles"]
                )
        workers.trim()

    return texts.mapInArrow(run, "id long, shingles binary")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    first = sets.select(F.col("id").alias("a"), F.col("shingles").alias("left"))
    second = sets.select(F.col("id").alias("b"), F.col("shingles").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                x = np.frombuffer(left.as_buffer(), np.uint64)
                y = np.frombuffer(right.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(similar(shared, len(x), len(y), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        workers.trim()

    joined = pairs.join(first, "a").join(second, "b").select("a", "b", "left", "right")
    return joined.mapInArrow(run, "a long, b long")


def _by_bits(columns: np.ndarray, counts: np.ndarray, width: int):
    """How many columns set ``i`` shares with others, all sets held as bits."""
    packed = np.zeros((len(counts), width // 8), np.uint8)
    ends = counts.cumsum()
    for k, (begin, end) in enumerate(zip(ends - counts, ends, strict=True)):
        bits = np.zeros(width, bool)
        bits[columns[begin:end]] = True
        packed[k] = np.packbits(bits)
    packed = packed.view(np.uint64)
    return lambda i, others: np.bitwise_count(packed[others] & packed[i]).sum(1, dtype=np.int64)


def _by_marks(columns: np.ndarray, counts: np.ndarray, width: int):
    """The same where bits would take too much memory: set ``i`` is marked, all columns look."""
    owner = np.repeat(np.arange(len(counts)), counts)
    ends = counts.cumsum()
    marked = np.zeros(width, bool)

    def shared(i: int, others: np.ndarray) -> np.ndarray:
        own = columns[ends[i] - counts[i]:ends[i]]
        marked[own] = True
        found = np.bincount(owner[marked[columns]], minlength=len(counts))
        marked[own] = False
        return found[others]

    return shared


def link_block(rows: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links that join different components among the documents of one block, or of two blocks.

    Compares every two documents that are in different components (and, where there are two
    blocks, in different blocks) on their whole sets, held as bits. Links that would close a circle
    are left out: they change no component.
    """
    ids = rows.column("id").to_numpy()
    sides = rows.column("block").to_numpy()
    sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in rows.column("shingles")]
    sizes = np.array([len(s) for s in sets])
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    common = np.bincount(place, minlength=len(values)) > 1
    column = np.cumsum(common) - 1
    held = common[place]
    owner = np.repeat(np.arange(len(sets)), sizes)
    width = -(-int(common.sum() + 1) // 64) * 64
    how = _by_bits if len(sets) * width <= 8 * PACKED_BYTES else _by_marks
    shared_with = how(column[place[held]], np.bincount(owner[held], minlength=len(sets)), width)
    names, group = np.unique(rows.column("component").to_numpy(), return_inverse=True)
    two = sides.min() != sides.max()
    out: list[tuple[int, int]] = []
    for i in range(len(ids) - 1):
        later = slice(i + 1, None)
        possible = (group[later] != group[i]) & (sizes[later] > 0)
        if two:
            possible &= sides[later] != sides[i]
        others = np.flatnonzero(possible) + i + 1
        if not len(others):
            continue
        shared = shared_with(i, others)
        for j in others[similar(shared, sizes[i], sizes[others], percent)].tolist():
            if group[j] != group[i]:
                out.append((int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))))
                group[group == group[j]] = group[i]
    return out


def near_links(
    signed: DataFrame, texts: DataFrame, stages: Stages, shingle: int, percent: int, block: int
) -> DataFrame:
    """Links (a, b) between representatives; their components are those of all links.

    Buckets with the same documents count once. First each bucket's smallest document is compared
    with the others; that settles groups of true copies. Buckets whose documents are then still in
    different components are compared in full, in blocks bounded in documents and in shingles.
    """
    hashed = signed.select(
        "id", F.col("n_shingles").cast("int").alias("length"), F.explode("bands").alias("bucket")
    )
    print_of = F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("print")
    buckets = stages.write(
        hashed.groupBy("bucket")
        .agg(F.count("*").alias("size"), F.sum("length").alias("weight"),
             F.min("id").alias("pivot"), print_of)
        .where("size > 1").groupBy("size", "weight", "pivot", "print")
        .agg(F.min("bucket").alias("bucket")),
        "near-buckets",
    )
    members = stages.write(
        hashed.join(buckets, "bucket").select(
            "bucket", F.greatest(F.ceil(F.col("size") / block),
                                 F.ceil(F.col("weight") / BLOCK_SHINGLES)).cast("int").alias("blocks"),
            "pivot", "id"),
        "near-members",
    )
    wanted = stages.write(members.select("id").distinct(), "near-ids")
    sets = stages.write(
        shingle_sets(texts.join(wanted, "id", "left_semi").select("id", "text"), shingle)
        .distinct(),
        "near-sets",
    )
    pairs = members.where("id <> pivot").select(
        F.col("pivot").alias("a"), F.col("id").alias("b")
    ).distinct()
    found = stages.write(confirm(stages.write(pairs, "near-pairs"), sets, percent), "near-star")
    labels = components(found, stages)
    labelled = stages.write(
        members.join(labels, members["id"] == labels["node"], "left")
        .select("bucket", "blocks", "id", F.coalesce("component", "id").alias("component")),
        "near-labelled",
    )
    open_ones = stages.write(
        labelled.groupBy("bucket").agg(F.min("component").alias("low"),
                                       F.max("component").alias("high"))
        .where("low <> high").select("bucket"),
        "near-open",
    )
    dealt = (
        labelled.join(open_ones, "bucket", "left_semi")
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("bucket", F.least("block", "other").alias("low"),
                F.greatest("block", "other").alias("high"), "block", "component", "id")
        .join(sets, "id")
    )

    def run(rows: pa.Table) -> pa.Table:
        workers.enter("minhash")
        linked = link_block(rows, percent)
        if rows.nbytes > TRIM_BYTES:
            workers.trim()
        return pa.table({"a": pa.array([a for a, _ in linked], pa.int64()),
                         "b": pa.array([b for _, b in linked], pa.int64())})

    rest = dealt.groupBy("bucket", "low", "high").applyInArrow(run, "a long, b long")
    return found.union(stages.write(rest, "near-rest"))


def near_duplicates(
    docs: DataFrame,
    stages: Stages,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    block: int = 512,
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    A document's set is that of its distinct ``shingle``-word shingles after lower-casing A-Z; with
    fewer words the whole sequence is one shingle. Documents whose sets have a Jaccard similarity
    of ``percent`` or more are linked; ``component_id`` is the smallest id reachable. Null and
    empty texts and texts without words have an empty set and no link. Equal sets are one class
    with the smallest id as its representative. Ids are integers; rows that repeat an id count as
    one document, so their links are united. A row without an id is not compared: it has no
    component and is kept. Other columns are ignored. Without rows the result is empty.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    signed = stages.write(sign(texts, shingle), "near-signed")
    named = signed.where("id is not null and n_shingles > 0")
    classes = stages.write(
        named.groupBy("set_key").agg(F.min("id").alias("first"), F.max("id").alias("last")),
        "near-classes",
    )
    firsts = classes.select(F.col("first").alias("id"), "set_key")
    chosen = named.join(firsts, ["id", "set_key"], "left_semi").select("id", "n_shingles", "bands")
    links = near_links(chosen, texts.where("id is not null"), stages, shingle, percent, block)
    repeated = named.groupBy("id").agg(F.min("set_key").alias("x"), F.max("set_key").alias("y"))
    repeated = repeated.where("x <> y").select("id")
    # Representatives of the sets that one repeated id has: they are linked through that id.
    same_id = (
        named.join(repeated, "id", "left_semi").join(classes, "set_key")
        .select(F.col("id").alias("a"), F.col("first").alias("b")).where("a <> b")
    )
    labels = components(links.union(same_id), stages)
    copies = classes.where("first <> last").select("set_key", "first")
    grouped = (
        signed.select("id", "n_shingles", "set_key")
        .join(copies, "set_key", "left")
        .withColumn("first", F.when(F.col("id").isNotNull(), F.coalesce("first", "id")))
    )
    return (
        grouped.join(labels, grouped["first"] == labels["node"], "left")
        .withColumn("component_id", F.coalesce("component", "first"))
        .select(
            F.col("id").alias(id_col), "n_shingles", "component_id",
            F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )


def drop_near_copies(
    docs: DataFrame,
    stages: Stages,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
) -> DataFrame:
    """The rows of ``docs``, all columns, whose id is the smallest of its component."""
    found = near_duplicates(docs, stages, id_col, text_col, shingle, percent)
    dropped = stages.write(found.where(~F.col("kept")).select(id_col), "near-dropped")
    return without_ids(docs, dropped, id_col)
