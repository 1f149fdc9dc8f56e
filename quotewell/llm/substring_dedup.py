"""Repeated passages found by fixed-block anchors.

A window of 35 words holds a whole block of 18 words that starts at a multiple of 18, wherever the
window lies. So two equal windows in different places show up as a block of one document that
equals a rolling 18-word window of the other. The blocks are indexed, every rolling window probes
the index, and only windows around hits are compared in full; consecutive repeated windows make
the maximal repeat.

Hashes travel packed: one row per slice of documents and part of the hash space. An answer is one
bit per probe, in the order in which they were sent. Parts with many copies of a block, known from
the counts of the index, are spread over several tasks, each with its own copy of that part of the
index. Equality is that of 64-bit hashes of word sequences (32 bits within a part for the probes,
which only nominate windows).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewell.llm.bpe import slices
from quotewell.llm.common import whole_text
from quotewell.llm.minhash import WordHashes
from quotewell.sources.stages import Stages

WINDOW = 35
PART_BYTES = 48 << 20  # of text per part of the hash space
LEAST_PARTS = 24  # so that small inputs use all cores as well
FACTOR = 0x9E3779B97F4A7C15  # fixed odd factor of the rolling hash
INVERSE = pow(FACTOR, -1, 1 << 64)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").split()


class Powers:
    """Powers of the factor and of its inverse, modulo 2 ** 64."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            steps = np.array([[FACTOR], [INVERSE]], np.uint64).repeat(size, 1)
            steps[:, 0] = 1
            self.up, self.down = np.cumprod(steps, axis=1, dtype=np.uint64)
        return self.up[:n], self.down[:n]


class Hasher:
    def __init__(self):
        self.known = WordHashes()
        self.powers = Powers()

    def words(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))

    def windows(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """A 64-bit hash of every run of ``size`` words."""
        n = len(hashes) - size + 1
        if n < 1:
            return np.empty(0, np.uint64)
        up, down = self.powers.get(len(hashes))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * down, dtype=np.uint64)])
        mixed = (total[size:] - total[:n]) * up[:n]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        return mixed ^ (mixed >> np.uint64(32))


def parts_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of the hash space, from the upper half of a hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def lower_half(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(0xFFFFFFFF)).astype("<u4")


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unbits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)


def anchors(texts: DataFrame, block: int, parts: int, stages: Stages) -> DataFrame:
    """The index: (part, hash, repeated) of every non-overlapping block, and copies per block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for piece in slices(batch, 0):
                found = [hasher.windows(hasher.words(words_of(t)), block)[::block]
                         for t in piece.column(0).to_pylist()]
                values, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts_of(values, parts)),
                     pa.array(lower_half(values).view(np.int32)), pa.array(counts)],
                    ["part", "hash", "n"],
                )

    found = texts.select("text").mapInArrow(run, "part long, hash int, n long")
    return stages.write(found.groupBy("part", "hash").agg(F.sum("n").alias("n")), "sub-anchors")


def probes(texts: DataFrame, block: int, parts: int, spread: dict[int, int]) -> DataFrame:
    """Every rolling window of every document, packed by part: hashes in document order."""
    schema = ("part long, share long, keys binary, counts binary, hashes binary, aligned binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        number = TaskContext.get().partitionId()
        for batch in batches:
            for piece in slices(batch, 1):
                number += 1
                keys = piece.column(0).to_numpy()
                found = [hasher.windows(hasher.words(words_of(t)), block)
                         for t in piece.column(1).to_pylist()]
                sizes = np.array([len(h) for h in found], np.int64)
                every = np.concatenate(found)
                owner = np.repeat(np.arange(len(keys)), sizes)
                place = np.arange(len(every)) - np.repeat(sizes.cumsum() - sizes, sizes)
                part = parts_of(every, parts)
                order = np.argsort(part, kind="stable")
                starts = np.searchsorted(part[order], np.arange(parts + 1))
                rows = []
                for p in np.flatnonzero(np.diff(starts)).tolist():
                    at = order[starts[p]:starts[p + 1]]
                    docs, counts = np.unique(owner[at], return_counts=True)
                    rows.append((
                        p, number * 7919 % spread.get(p, 1),
                        keys[docs].astype("<i8").tobytes(), counts.astype("<u4").tobytes(),
                        lower_half(every[at]).tobytes(), bits(place[at] % block == 0),
                    ))
                if rows:
                    yield pa.RecordBatch.from_pylist([
                        dict(zip(("part", "share", "keys", "counts", "hashes", "aligned"), row,
                                 strict=True)) for row in rows
                    ], pa.schema([("part", pa.int64()), ("share", pa.int64()),
                                  *[(c, pa.binary()) for c in
                                    ("keys", "counts", "hashes", "aligned")]]))

    return texts.select("key", "text").mapInArrow(run, schema)


def answer(sent: pa.Table, index: pa.Table) -> pa.Table:
    """(key, part, hits) for documents with a hit: one bit per probe, in the order sent.

    A window that starts a block itself needs another block with the same hash.
    """
    names = index.column("hash").to_numpy().view(np.uint32)
    order = np.argsort(names)
    names, copies = names[order], index.column("n").to_numpy()[order]
    keys, hits = [], []
    for row in range(sent.num_rows):
        def packed(column: str, kind, row=row) -> np.ndarray:
            return np.frombuffer(sent.column(column)[row].as_buffer(), kind)

        hashes, counts = packed("hashes", "<u4"), packed("counts", "<u4")
        at = np.searchsorted(names, hashes)
        at[at == len(names)] = 0
        aligned = unbits(packed("aligned", np.uint8).tobytes(), len(hashes))
        hit = (names[at] == hashes) & (copies[at] > aligned) if len(names) else aligned & False
        ends = counts.astype(np.int64).cumsum()
        per_doc = np.diff(np.concatenate([[0], hit.cumsum()])[np.concatenate([[0], ends])])
        for doc in np.flatnonzero(per_doc).tolist():
            keys.append(int(packed("keys", "<i8")[doc]))
            hits.append(bits(hit[ends[doc] - counts[doc]:ends[doc]]))
    part = sent.column("part")[0].as_py() if sent.num_rows else 0
    return pa.table({
        "key": pa.array(keys, pa.int64()), "part": pa.array([part] * len(keys), pa.int64()),
        "hits": pa.array(hits, pa.binary()),
    })


def covers(hits: np.ndarray, size: int, reach: int) -> np.ndarray:
    """Which of ``size`` positions have a hit among themselves and the ``reach - 1`` after them."""
    total = np.concatenate([[0], np.cumsum(hits)])
    ends = np.minimum(np.arange(size) + reach, len(hits))
    return total[ends] > total[:size]


def finish(words: list[bytes], keep: np.ndarray, digest: bool) -> str:
    kept = b" ".join([w for w, k in zip(words, keep, strict=True) if k] if not keep.all()
                     else words)
    return hashlib.sha256(kept).hexdigest() if digest else kept.decode("utf-8", "replace")


JUDGED = "id string, n_words long, kept string, slice long, text string"
ENDED = "id string, n_words long, n_removed long, kept string"


def judge(
    texts: DataFrame, hits: DataFrame, window: int, block: int, parts: int, digest: bool
) -> DataFrame:
    """Documents with a window around a hit keep their text; all others are finished."""
    listed = hits.groupBy("key").agg(
        F.collect_set(F.struct("part", "hits")).alias("hits")
    )
    joined = texts.join(listed, "key", "left").select("id", "text", "hits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in slices(batch, 1):
                number += 1
                out: list[tuple] = []
                rows = zip(*(c.to_pylist() for c in piece.columns), strict=True)
                for name, text, found in rows:
                    words = words_of(text)
                    possible = False
                    if found and len(words) >= window:
                        rolling = hasher.windows(hasher.words(words), block)
                        part = parts_of(rolling, parts)
                        hit = np.zeros(len(rolling), bool)
                        for answered in found:
                            at = np.flatnonzero(part == answered["part"])
                            hit[at] = unbits(answered["hits"], len(at))
                        possible = covers(hit, len(words) - window + 1, window - block + 1).any()
                    if possible:
                        out.append((name, len(words), None, number, text))
                    else:
                        every = np.ones(len(words), bool)
                        out.append((name, len(words), finish(words, every, digest), None, None))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(
                        zip(*out, strict=True),
                        (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()),
                        strict=True)],
                    ["id", "n_words", "kept", "slice", "text"],
                )

    return joined.mapInArrow(run, JUDGED)


def full_windows(texts: DataFrame, window: int, parts: int) -> DataFrame:
    """Distinct whole-window hashes of each slice, packed by part; are they repeated in it?"""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for name in np.unique(batch.column(0).to_numpy()).tolist():
                chosen = batch.filter(pa.compute.equal(batch.column(0), name))
                found = [hasher.windows(hasher.words(words_of(t)), window)
                         for t in chosen.column(1).to_pylist()]
                values, counts = np.unique(np.concatenate(found), return_counts=True)
                part = parts_of(values, parts)
                starts = np.searchsorted(part, np.arange(parts + 1))
                rows = [
                    {"part": p, "slice": name, "hashes": values[a:b].astype("<u8").tobytes(),
                     "repeated": bits(counts[a:b] > 1)}
                    for p, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)) if b > a
                ]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema([
                        ("part", pa.int64()), ("slice", pa.int64()), ("hashes", pa.binary()),
                        ("repeated", pa.binary()),
                    ]))

    return texts.select("slice", "text").mapInArrow(
        run, "part long, slice long, hashes binary, repeated binary"
    )


def count_windows(sent: pa.Table) -> pa.Table:
    """Which windows of each slice occur more than once anywhere."""
    rows = [np.frombuffer(h.as_buffer(), "<u8") for h in sent.column("hashes")]
    sizes = np.array([len(r) for r in rows])
    often = np.concatenate([
        unbits(r.as_py(), n) for r, n in zip(sent.column("repeated"), sizes.tolist(), strict=True)
    ])
    values, place, counts = np.unique(
        np.concatenate(rows), return_inverse=True, return_counts=True
    )
    repeated = (counts + np.bincount(place, often, len(values)) > 1)[place]
    found = [r[m].tobytes() for r, m in
             zip(rows, np.split(repeated, sizes.cumsum()[:-1]), strict=True)]
    return pa.table({"slice": sent.column("slice"), "hashes": pa.array(found, pa.binary())}).filter(
        pa.array([len(f) > 0 for f in found], pa.bool_())
    )


def substring_dedup(
    docs: DataFrame,
    stages: Stages,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    digest: bool = False,
    kept_col: str = "kept_text",
) -> DataFrame:
    """One row per document: id, n_words, n_removed, and the kept words joined by one space.

    Words are runs of anything but space and U+0009 to U+000D, unchanged. A word is removed if a
    window of ``window`` words covers it whose word sequence also starts anywhere else, in the same
    or another document, judged on the input. Null and empty texts have no words; documents with
    fewer words than a window lose none; repeated rows repeat each other, so all their windows go.
    Null and repeated ids are allowed. ``digest`` returns the SHA-256 of the kept text instead.
    Other columns are ignored. Without rows the result is empty.
    """
    kind = docs.schema[id_col].dataType
    block = (window + 1) // 2
    texts = docs.select(
        F.col(id_col).cast("string").alias("id"), whole_text(text_col).alias("text")
    ).withColumn("key", F.xxhash64("id", "text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(LEAST_PARTS, -(-size // PART_BYTES))
    index = anchors(texts, block, parts, stages)
    # Copies of blocks per part; the few parts with more than twice their share are spread.
    loads = index.groupBy("part").agg(F.sum("n").alias("n"))
    share = size / parts / 6 / block + 1  # blocks of an even part, at six bytes a word
    spread = {r.part: -int(-r.n // share) for r in loads.where(F.col("n") > 2 * share).collect()}
    shares = F.create_map(*[F.lit(x) for p in spread.items() for x in p]) if spread else None
    many = F.coalesce(shares[F.col("part")], F.lit(1)) if spread else F.lit(1)
    placed = index.withColumn(
        "share", F.explode(F.sequence(F.lit(0).cast("long"), (many - 1).cast("long")))
    ).select("part", "share", "hash", "n")
    sent = probes(texts, block, parts, spread)

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return answer(left, right)

    hits = stages.write(
        sent.groupBy("part", "share").cogroup(placed.groupBy("part", "share"))
        .applyInArrow(run, "key long, part long, hits binary"),
        "sub-hits",
    )
    judged = stages.write(judge(texts, hits, window, block, parts, digest), "sub-judged")
    open_ones = judged.where("slice is not null").select("id", "slice", "text")
    repeated = stages.write(
        full_windows(open_ones, window, parts).groupBy("part")
        .applyInArrow(count_windows, "slice long, hashes binary"),
        "sub-repeated",
    )

    def remove(rows: pa.Table, found: pa.Table) -> pa.Table:
        hasher = Hasher()
        known = np.sort(np.concatenate([
            np.empty(0, "<u8"),
            *[np.frombuffer(h.as_buffer(), "<u8") for h in found.column("hashes")],
        ]))
        out = []
        for name, text in zip(rows.column("id").to_pylist(), rows.column("text").to_pylist(),
                              strict=True):
            words = words_of(text)
            whole = hasher.windows(hasher.words(words), window)
            at = np.searchsorted(known, whole)
            at[at == len(known)] = 0
            seen = known[at] == whole if len(known) else np.zeros(len(whole), bool)
            edge = np.zeros(len(words) + 1, np.int64)
            edge[:len(whole)] += seen
            edge[window:window + len(whole)] -= seen
            keep = np.cumsum(edge)[:-1] == 0
            out.append((name, len(words), int((~keep).sum()), finish(words, keep, digest)))
        return pa.Table.from_arrays(
            [pa.array(c, t) for c, t in zip(
                zip(*out, strict=True) if out else [[]] * 4,
                (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)],
            ["id", "n_words", "n_removed", "kept"],
        )

    cleaned = (
        open_ones.groupBy("slice").cogroup(repeated.groupBy("slice")).applyInArrow(remove, ENDED)
    )
    finished = judged.where("slice is null").select(
        "id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept"
    )
    return finished.union(cleaned).select(
        F.col("id").cast(kind).alias(id_col), "n_words", "n_removed", F.col("kept").alias(kept_col)
    )
