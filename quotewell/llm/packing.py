"""Packing of tokens into fixed windows with neighbours found by BM25.

Whole windows of a document are sequences of their own. The rests are dealt by content to shards of
bounded size: they are put in order of their rarest tokens and the order is cut into shards, so that
rests with the same rare tokens meet at every size of the corpus. Document frequencies are counted
over the whole corpus. The rests are indexed by token in the shard: each seed, longest first, asks the
inverted index for its unused neighbours, which fill the seed's window in order of their score; the
last one is cut where the window ends and its remainder goes back to the pool. So every window is
full but the last of a shard, which is cut into powers of two and needs no padding either.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewell.llm import workers
from quotewell.llm.bpe import chunk_encoder  # noqa: F401  (ids of single texts)
from quotewell.llm.bpe import batch_encoder, int_lists, slices
from quotewell.llm.common import whole_text
from quotewell.sources.stages import Stages

WINDOW = 2048
END_ID = 1
SHARD_BYTES = 3 << 20
DENSE_SHARE = 8  # a token in one of so many rests of a shard has a dense row of weights
K1, B = 1.2, 0.75
SCATTER = 0x9E3779B97F4A7C15  # fixed odd factor that spreads consecutive numbers

KEY_TERMS = 4
PLACE_TERMS = 3
NO_TERM = 0xFFFFFFFF
SAMPLED = 64  # rests a shard, to cut the order where shards end
SLICE_BYTES = 1 << 20
BLOCK_RESTS = 256  # rests whose tokens are sorted at once
ROW_TOKENS = 64  # what a rest counts besides its tokens when shards are cut

CUT = ("salt long, id string, start long, length long, ids_crc32 long, doc_tokens long, "
       "rest binary")
DEALT = CUT.replace("salt", "shard")
PIECES = ("id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, ids array<int>")


NO_IDS = np.empty(0, np.uint16)


def ids_crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def unpack(packed: bytes, length: int) -> np.ndarray:
    return np.frombuffer(packed, "<u2" if len(packed) == 2 * length else "<u4")


@dataclass(frozen=True)
class Corpus:
    """What BM25 knows of all rests: in how many each token is, their number and mean length."""

    df: np.ndarray
    rests: int
    mean: float


def distinct(rests: Sequence[np.ndarray], terms: np.ndarray, span: int) -> np.ndarray:
    """``number of a rest * span + term``, once each and in order; ``terms`` are below ``span``."""
    kind = np.int32 if len(rests) * span < 1 << 31 else np.int64
    pairs = np.repeat(np.arange(len(rests), dtype=kind) * kind(span), [len(r) for r in rests])
    pairs += terms.astype(kind)
    pairs.sort()
    return pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])]


def lowest(pairs: np.ndarray, rests: int, span: int, least: int, terms: int) -> list[bytes]:
    """For each rest the first of its terms in ``distinct`` pairs from ``least`` on, as bytes."""
    first = np.arange(rests, dtype=pairs.dtype) * span
    at = np.searchsorted(pairs, first + least)[:, None] + np.arange(terms)
    ends = np.searchsorted(pairs, first + span)[:, None]
    found = pairs[np.minimum(at, len(pairs) - 1)] % span
    return [row.tobytes() for row in np.where(at < ends, found, NO_TERM).astype(">u4")]


def counted(rests: Iterable[np.ndarray]) -> tuple[np.ndarray, int, int]:
    """Rests that hold each token, number of rests, number of tokens."""
    df, n, tokens = np.zeros(1, np.int64), 0, 0
    for block in batched(rests, BLOCK_RESTS):
        terms = np.concatenate(block)
        span = int(terms.max()) + 1
        found = np.bincount(distinct(block, terms, span) % span, minlength=len(df))
        found[:len(df)] += df
        df, n, tokens = found, n + len(block), tokens + len(terms)
    return df, n, tokens


class Order:
    """The order in which rests are dealt.

    The key of a rest is its rarest tokens that some other rest has as well. Rests with the same
    rarest token stay together, and where they stand among the others is told by the rarest tokens
    that are common enough to fill a shard: those of the least of them. A hot key is cut by the
    salt of its rows.
    """

    def __init__(self, corpus: Corpus, shards: int):
        by_df = np.argsort(corpus.df, kind="stable")
        self.rank = np.empty(len(by_df), np.int32)
        self.rank[by_df] = np.arange(len(by_df))
        ordered = corpus.df[by_df]
        self.least = int(np.searchsorted(ordered, 2))
        self.common = int(np.searchsorted(ordered, max(2, -(-corpus.rests // shards))))

    def keys(self, rests: Iterable[np.ndarray]) -> Iterator[tuple[bytes, bytes]]:
        """The place that each rest would have by itself, and its key, as bytes in their order."""
        span = len(self.rank)
        for block in batched(rests, BLOCK_RESTS):
            pairs = distinct(block, self.rank[np.concatenate(block)], span)
            places = lowest(pairs, len(block), span, self.common, PLACE_TERMS)
            yield from zip(places, lowest(pairs, len(block), span, self.least, KEY_TERMS),
                           strict=True)


def full_key(places: dict[bytes, bytes], key: bytes, salt: int) -> bytes:
    return places[key[:4]] + key + salt.to_bytes(8, "big")


def cuts(keys: list[bytes], weights: list[int], shards: int) -> list[bytes]:
    """Keys from which the next shard begins; shards are even in the weights of the sample."""
    if not keys:
        return []
    order = sorted(range(len(keys)), key=keys.__getitem__)
    before = np.cumsum([0, *(weights[i] for i in order)])[:-1]
    shard = before * shards // sum(weights)
    begins = np.searchsorted(shard, np.arange(1, shards))
    return [keys[order[i]] for i in begins if i < len(order)]


class Index:
    """BM25 inverted index over the tokens of one shard's rests, weighted by the whole corpus."""

    def __init__(self, rests: list[np.ndarray], corpus: Corpus):
        sizes = np.array([len(r) for r in rests], np.int64)
        terms = np.concatenate(rests).astype(np.int64)
        docs = np.repeat(np.arange(len(rests)), sizes)
        pairs, counts = np.unique(terms * len(rests) + docs, return_counts=True)
        self.docs = (pairs % len(rests)).astype(np.int32)
        names, begin, df = np.unique(
            pairs // len(rests), return_index=True, return_counts=True
        )
        self.begin, self.end = begin, begin + df
        everywhere = corpus.df[names]
        idf = np.log(1 + (corpus.rests - everywhere + 0.5) / (everywhere + 0.5))
        norm = K1 * (1 - B + B * sizes / corpus.mean)
        rows = np.repeat(np.arange(len(names)), df)
        self.weight = idf[rows] * counts * (K1 + 1) / (counts + norm[self.docs])
        # Each document asks for all its terms that some other one has as well. Common terms have
        # dense rows, which add up faster than their postings.
        common = df * DENSE_SHARE > len(rests)
        row_of = np.cumsum(common) - 1
        self.dense = np.zeros((int(common.sum()), len(rests)))
        at = common[rows]
        self.dense[row_of[rows[at]], self.docs[at]] = self.weight[at]
        self.asked = self._by_doc(np.flatnonzero((df[rows] > 1) & ~at), rows, len(rests))
        self.asked_dense = self._by_doc(np.flatnonzero((df[rows] > 1) & at), row_of[rows],
                                        len(rests))
        self.size = len(rests)

    def _by_doc(self, postings: np.ndarray, terms: np.ndarray, size: int) -> list[np.ndarray]:
        """The terms of the given postings, document by document."""
        by_doc = postings[np.argsort(self.docs[postings], kind="stable")]
        return np.split(terms[by_doc], np.searchsorted(self.docs[by_doc], np.arange(1, size)))

    def neighbours(self, seed: int, left: np.ndarray | bool = True) -> np.ndarray:
        """Documents that share a term with ``seed``, best first; ties by number.

        ``left`` tells for each document whether it is asked for.
        """
        scores = self.dense[self.asked_dense[seed]].sum(0)
        begin, end = self.begin[self.asked[seed]], self.end[self.asked[seed]]
        if len(begin):
            ends = np.cumsum(end - begin)
            at = np.repeat(end - ends, end - begin) + np.arange(ends[-1])
            scores += np.bincount(self.docs[at], self.weight[at], self.size)
        found = np.flatnonzero(scores * left)
        return found[np.argsort(-scores[found], kind="stable")]


def fill(
    rests: list[np.ndarray], corpus: Corpus, window: int = WINDOW
) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (rest, start, length); all but the last ones hold ``window`` tokens."""
    if not rests:
        return []
    index = Index(rests, corpus)
    sizes = np.array([len(r) for r in rests], np.int64)
    used = np.zeros(len(rests), np.int64)
    order = np.argsort(-sizes, kind="stable")
    following = 0
    sequences: list[list[tuple[int, int, int]]] = []

    def spare() -> Iterator[int]:
        """Rests that still have tokens, longest first."""
        nonlocal following
        while following < len(order):
            if used[order[following]] < sizes[order[following]]:
                yield int(order[following])
            else:
                following += 1

    def take(doc: int, room: int) -> int:
        length = int(min(room, sizes[doc] - used[doc]))
        if length:
            current.append((doc, int(used[doc]), length))
            used[doc] += length
        return room - length

    for seed in spare():
        current: list[tuple[int, int, int]] = []
        room = take(seed, window)
        if room:
            for doc in index.neighbours(seed, used < sizes).tolist():
                room = take(doc, room)
                if not room:
                    break
        for doc in spare() if room else ():
            room = take(doc, room)
            if not room:
                break
        sequences.append(current)
    return sequences[:-1] + powers(sequences[-1])


def powers(sequence: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """One sequence cut into several, each as long as a power of two, longest first."""
    rest = sum(length for _, _, length in sequence)
    pieces, out = list(reversed(sequence)), []
    while rest:
        room = 1 << (rest.bit_length() - 1)
        rest -= room
        current = []
        while room:
            doc, start, length = pieces.pop()
            part = min(room, length)
            current.append((doc, start, part))
            room -= part
            if part < length:
                pieces.append((doc, start + part, length - part))
        out.append(current)
    return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    shard_bytes: int = SHARD_BYTES,
    ids_col: str | None = None,
    stages: Stages | None = None,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its text without special tokens, then ``end_id``; null and empty
    texts are the end id alone. Sequences have at most ``window`` ids (a power of two), each id is
    in exactly one piece, and offsets in a sequence have no gaps. Repeated rows are packed each.
    ``ids_col`` names a further column with the ids of the piece. Other columns are ignored.
    Tokens and keys are stage tables. Without rows the result is empty.
    """
    if window & (window - 1) or window < 1:
        raise ValueError("window must be a power of two")
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).cast("string").alias("id"), whole_text(text_col).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(1))).first()[0]
    shards = -(-size // shard_bytes)

    stages = stages or Stages(docs.sparkSession)

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("packing")
        encoder = batch_encoder(tokenizer)
        row = (TaskContext.get().partitionId() << 40) if TaskContext.get() else 0
        end = np.array([end_id], np.int32)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                out: list[tuple] = []
                found, begins = encoder.ids(part.column(1))
                for name, at, to in zip(
                    part.column(0).to_pylist(), begins[:-1].tolist(), begins[1:].tolist(),
                    strict=True,
                ):
                    ids = np.concatenate([found[at:to], end])
                    row += 1
                    salt = row * SCATTER % (1 << 64) >> 1
                    whole = len(ids) // window * window
                    narrow = "<u4" if ids.max() >> 16 else "<u2"
                    for start in range(0, whole, window):
                        out.append((salt, name, start, window,
                                    ids_crc(ids[start:start + window]), len(ids),
                                    ids[start:start + window].astype(narrow).tobytes()
                                    if ids_col else None))
                    if whole < len(ids):
                        rest = ids[whole:].astype(narrow)
                        out.append((salt, name, whole, len(rest), None, len(ids), rest.tobytes()))
                names = [f.split()[0] for f in CUT.split(", ")]
                types = [pa.int64(), pa.string(), *[pa.int64()] * 4, pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                    names,
                )
        workers.trim(collect=False)

    def unpacked(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for start in range(0, batch.num_rows, BLOCK_RESTS):
            part = batch.slice(start, BLOCK_RESTS)
            yield from map(unpack, part.column("rest").to_pylist(),
                           part.column("length").to_pylist())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("packing tables")
        df, n, tokens = counted(rest for batch in batches for rest in unpacked(batch))
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, -2, *held.tolist()], pa.int64()),
             pa.array([n, tokens, *df[held].tolist()], pa.int64())], ["token", "n"])

    parts = stages.write(rows.mapInArrow(cut_up, CUT), "pack-tokens")
    rests = parts.where("ids_crc32 is null").select("salt", "length", "rest")
    # One row per token of the vocabulary.
    counts = (rests.mapInArrow(count, "token long, n long").groupBy("token")
              .agg(F.sum("n").alias("n")).toArrow())
    totals = dict(zip(counts["token"].to_pylist(), counts["n"].to_pylist(), strict=True))
    n_rests, tokens = totals.pop(-1, 0), totals.pop(-2, 0)
    df = np.zeros(max(totals, default=0) + 1, np.int64)
    df[list(totals)] = list(totals.values())
    corpus = Corpus(df, n_rests, tokens / max(1, n_rests))
    order = Order(corpus, shards)
    known = docs.sparkSession.sparkContext.broadcast((corpus, order))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("packing tables")
        order = known.value[1]
        for batch in batches:
            made = list(order.keys(unpacked(batch)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("salt"), batch.column("length"),
                 pa.array([place for place, _ in made], pa.binary()),
                 pa.array([key for _, key in made], pa.binary())],
                ["salt", "length", "place", "key"])

    keyed = stages.write(
        rests.mapInArrow(place, "salt long, length long, place binary, key binary"), "pack-keys"
    )
    # The rarest token alone: again one row per token at most.
    least = keyed.groupBy(F.substring("key", 1, 4).alias("term")).agg(F.min("place").alias("place"))
    places = {bytes(r.term): bytes(r.place) for r in least.toLocalIterator()}
    share = min(1.0, SAMPLED * shards / max(1, n_rests))
    sample = keyed.where(F.pmod(F.xxhash64("salt"), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))
    drawn = sample.select("salt", "length", "key").toArrow()
    bounds = cuts(
        [full_key(places, key, salt) for key, salt in
         zip(drawn["key"].to_pylist(), drawn["salt"].to_pylist(), strict=True)],
        [n + ROW_TOKENS for n in drawn["length"].to_pylist()], shards,
    )
    dealing = docs.sparkSession.sparkContext.broadcast((places, bounds))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("packing tables")
        order = known.value[1]
        places, bounds = dealing.value
        for batch in batches:
            shard = []
            cut = batch.select(["length", "rest"]).filter(batch.column("ids_crc32").is_null())
            keys = order.keys(unpacked(cut))
            for salt, crc in zip(batch.column("salt").to_pylist(),
                                 batch.column("ids_crc32").to_pylist(), strict=True):
                if crc is not None:  # a whole window needs no neighbours
                    shard.append(salt * shards >> 63)
                else:
                    shard.append(bisect_right(bounds, full_key(places, next(keys)[1], salt)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int64()), *batch.columns[1:]],
                ["shard", *batch.schema.names[1:]],
            )

    def fill_shard(table: pa.Table) -> pa.Table:
        workers.enter("packing tables")
        rows = sorted(table.to_pylist(), key=lambda r: (r["id"] or "", r["start"], r["rest"] or b""))
        shard = rows[0]["shard"]
        whole = [r for r in rows if r["ids_crc32"] is not None]
        cut = [r for r in rows if r["ids_crc32"] is None]
        rests = [unpack(r["rest"], r["length"]) for r in cut]
        out: list[tuple] = []
        held: list[np.ndarray] = []
        number = shard << 32
        for r in whole:
            held.append(unpack(r["rest"], window) if ids_col else NO_IDS)
            out.append((r["id"], r["start"], window, r["ids_crc32"], r["doc_tokens"], number, 0))
            number += 1
        for sequence in fill(rests, known.value[0], window):
            offset = 0
            for doc, start, length in sequence:
                r, ids = cut[doc], rests[doc][start:start + length]
                held.append(ids if ids_col else NO_IDS)
                out.append((r["id"], r["start"] + start, length, ids_crc(ids), r["doc_tokens"],
                            number, offset))
                offset += length
            number += 1
        names = [f.split()[0] for f in PIECES.split(", ")]
        types = [pa.string(), *[pa.int64()] * 6]
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
        made = pa.Table.from_arrays([*columns, int_lists(held)], names)
        workers.trim(collect=False)
        return made

    packed = parts.mapInArrow(deal, DEALT).groupBy("shard").applyInArrow(fill_shard, PIECES)
    columns = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return packed.select(
        F.col("id").cast(kind).alias(id_col), *columns,
        *([F.col("ids").alias(ids_col)] if ids_col else []),
    )
