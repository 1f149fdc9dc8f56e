"""Byte-level BPE with the tokenizers library over Arrow batches.

A rank file maps byte strings to ids. The library works on characters, so every byte is mapped
to a printable character first, and every split of a token into two known parts becomes a merge,
in rank order. Decoding reverses the byte table.

Words repeat, so each Python worker remembers the ids of the chunks it has seen. The pre-token
pattern never joins a character with white space after it, nor a letter with what is no letter,
and never looks back, so the text can be cut at such places and the chunks encoded apart.
"""

from __future__ import annotations

import base64
import codecs
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewell.llm import workers
from quotewell.llm.common import free_name, whole_text

# The characters that Unicode calls White_Space: the library's \s.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# All letters below U+0250. Texts with later characters are cut at white space only.
LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
LATER = re.compile("[^\0-\u024f]")
WORDS = re.compile(f"[{SPACE}]*[^{SPACE}{LETTER}]*[{LETTER}]*")
CHUNKS = re.compile(f"[{SPACE}]*[^{SPACE}]*")
SINGLE = re.compile(f" ?[{LETTER}]+\\Z")
REMEMBERED = 300_000  # chunks per generation; a worker holds two generations
LONGEST_REMEMBERED = 64  # characters of a chunk
REMEMBERED_BYTES = 8 << 20  # of a worker's memory of chunks, where batches are encoded at once
TOKEN_ID = attrgetter("id")

# Kinds of bytes for ``chunk_starts``; and the last and last but one bytes of White_Space in UTF-8.
_MARK, _SPACE, _LETTER, _BEYOND = range(4)
_KIND = np.full(256, _BEYOND, np.uint8)
_KIND[:128] = _MARK
_KIND[[*range(9, 14), 32]] = _SPACE
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_ENDS_SPACE, _IN_SPACE = np.zeros(256, bool), np.zeros(256, bool)
_ENDS_SPACE[[*range(0x80, 0x8B), 0x85, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
_IN_SPACE[[0xC2, 0x9A, 0x80, 0x81]] = True


def chunks_of(text: str) -> list[str]:
    return (CHUNKS if LATER.search(text) else WORDS).findall(text)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def tokenizer_from_ranks(ranks: dict[bytes, int], pattern: str):
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    table = byte_characters()

    def visible(token: bytes) -> str:
        return "".join(table[b] for b in token)

    merges = [
        (visible(token[:cut]), visible(token[cut:]))
        for token, _ in sorted(ranks.items(), key=lambda item: item[1])
        for cut in range(1, len(token))
        if token[:cut] in ranks and token[cut:] in ranks
    ]
    vocab = {visible(token): rank for token, rank in ranks.items()}
    made = Tokenizer(models.BPE(vocab=vocab, merges=merges, ignore_merges=True))
    made.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    return made


@lru_cache(maxsize=4)
def load_tokenizer(path: str, pattern: str | None = None):
    """The tokenizer of a ``.tiktoken`` rank file (with its pattern) or of a ``.json`` file.

    ``path`` is opened by each task: the file has to lie at that place on every executor.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.encode_special_tokens = True
        return made
    return tokenizer_from_ranks(read_ranks(path), pattern)


class Remembered(dict):
    """Chunk to the result of ``make``, for the chunks used last.

    Two generations: a chunk in use moves into the younger one, and the older one is forgotten
    when the younger one is full.
    """

    def __init__(self, make: Callable[[str], object], most: int = REMEMBERED):
        super().__init__()
        self.make, self.most = make, most
        self.old: dict[str, object] = {}

    def __missing__(self, chunk: str):
        found = self.old.get(chunk)
        if found is None:
            found = self.make(chunk)
        if len(chunk) <= LONGEST_REMEMBERED:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[chunk] = found
        return found


class ChunkEncoder:
    """Ids, and offsets if asked for, of whole texts."""

    def __init__(self, tokenizer, remembered: int = REMEMBERED):
        self.tokenizer = tokenizer
        self.packed = Remembered(self._pack, remembered)
        self.paired = Remembered(self._pair, remembered)
        self.model = tokenizer.model
        self.visible = dict(enumerate(byte_characters()))
        # Is a space with letters one pre-token? Then such a chunk goes to the merges at once.
        pieces = tokenizer.pre_tokenizer.pre_tokenize_str(" ab") if tokenizer.pre_tokenizer else []
        self.words_are_whole = [p for p, _ in pieces] == [f"{self.visible[32]}ab"]

    def _pack(self, chunk: str) -> bytes:
        if self.words_are_whole and SINGLE.match(chunk):
            mapped = chunk.encode().decode("latin-1").translate(self.visible)
            return array("i", [token.id for token in self.model.tokenize(mapped)]).tobytes()
        made = self.tokenizer.encode_batch_fast([chunk], add_special_tokens=False)[0]
        return array("i", made.ids).tobytes()

    def encode_all(self, chunks: list[str]) -> tuple[array, list[int]]:
        """Ids of the chunks one after the other, and where those of each end."""
        mapped = "".join(chunks).encode().decode("latin-1").translate(self.visible)
        ids, ends, at = array("i"), [], 0
        for chunk in chunks:
            end = at + (len(chunk) if chunk.isascii() else len(chunk.encode()))
            if self.words_are_whole and SINGLE.match(chunk):
                ids.extend(map(TOKEN_ID, self.model.tokenize(mapped[at:end])))
            else:
                made = self.tokenizer.encode_batch_fast([chunk], add_special_tokens=False)[0]
                ids.extend(made.ids)
            ends.append(len(ids))
            at = end
        return ids, ends

    def _pair(self, chunk: str) -> tuple[list[int], list[tuple[int, int]]]:
        made = self.tokenizer.encode(chunk, add_special_tokens=False)
        return made.ids, made.offsets

    def ids(self, text: str) -> np.ndarray:
        known = self.packed
        return np.frombuffer(b"".join([known[c] for c in chunks_of(text)]), np.int32)

    def ids_and_offsets(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and one (start, end) row of code points per id.

        Ids that hold parts of one character share that character's offsets.
        """
        ids, spans, at = [], [], 0
        for chunk in chunks_of(text):
            own, offsets = self.paired[chunk]
            ids.extend(own)
            spans.extend((at + start, at + end) for start, end in offsets)
            at += len(chunk)
        return np.array(ids, np.int32), np.array(spans, np.int32).reshape(-1, 2)


def chunk_starts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where texts in UTF-8, laid one after the other, can be cut; ``begins`` are their first bytes.

    As in ``chunks_of`` before white space that follows something else, and before what is no letter
    after a letter. Only places before an ASCII character are taken.
    """
    kinds = _KIND[data]
    high = np.flatnonzero(data[:-1] == 0xC3)  # letters from U+00C0 on, but for two signs
    high = high[(data[high + 1] != 0x97) & (data[high + 1] != 0xB7)]
    kinds[high + 1] = _LETTER
    before, here = kinds[:-1], kinds[1:]
    cut = (here == _SPACE) & (before != _SPACE)
    cut |= (here == _MARK) & (before == _LETTER)
    after = np.flatnonzero(cut & (before == _BEYOND))  # white space beyond ASCII goes on in ASCII
    cut[after[_ENDS_SPACE[data[after]] & _IN_SPACE[data[after - 1]]]] = False
    first = np.zeros(len(data), bool)
    first[1:] = cut
    first[begins[begins < len(data)]] = True
    return np.flatnonzero(first)


class BatchEncoder:
    """Ids of whole batches of texts.

    Distinct chunks of a batch are looked up at once in a memory of ``remembered`` bytes. When it
    is full, chunks that were asked for again and those that came last stay. Ids have 16 bits where
    the vocabulary allows it, 32 elsewhere.
    """

    def __init__(self, chunks: ChunkEncoder, remembered: int):
        self.chunks, self.remembered = chunks, remembered
        self.words = pa.array([], pa.binary())
        self.ends = np.zeros(1, np.int32)
        small = chunks.tokenizer.get_vocab_size() <= 1 << 16
        self.known = np.empty(0, np.uint16 if small else np.int32)
        self.asked = np.empty(0, bool)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where those of each begin, with the end."""
        texts = pa.concat_arrays([texts.cast(pa.large_binary())])
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[:len(texts) + 1]
        if not len(texts) or bounds[-1] == bounds[0]:
            return self.known[:0], np.zeros(len(texts) + 1, np.int32)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0]:bounds[-1]]
        bounds = bounds - bounds[0]
        starts = chunk_starts(data, bounds)
        chunks = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts),
            [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)],
        ).dictionary_encode()
        at = self._places(chunks.dictionary.cast(pa.binary()))[chunks.indices.to_numpy()]
        ids, ends = self._ids_at(at)
        return ids, ends[np.searchsorted(starts, bounds)]

    def _ids_at(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at these places, one after the other, and where those of each begin."""
        sizes = self.ends[at + 1] - self.ends[at]
        ends = np.zeros(len(at) + 1, np.int32)
        np.cumsum(sizes, out=ends[1:])
        take = np.repeat(self.ends[at] - ends[:-1], sizes)
        take += np.arange(ends[-1], dtype=np.int32)
        return self.known[take], ends

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where in the memory the words are; missing ones are added."""
        if self.words.nbytes + self.known.nbytes + self.ends.nbytes > self.remembered:
            self._forget()
        # The table for the look-up is made of the batch, which has fewer words than the memory.
        held = pa.compute.index_in(self.words, value_set=words)
        found = np.flatnonzero(held.is_valid())
        self.asked[found] = True
        at = np.full(len(words), -1, np.int32)
        at[held.drop_null().to_numpy()] = found
        new = at < 0
        missing = words.filter(pa.array(new))
        at[new] = len(self.words) + np.arange(len(missing), dtype=np.int32)
        made, ends = self.chunks.encode_all(missing.cast(pa.string()).to_pylist())
        self.words = pa.concat_arrays([self.words, missing])
        made = np.frombuffer(made, np.int32).astype(self.known.dtype)
        self.known = np.concatenate([self.known, made])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.array(ends, np.int32)])
        self.asked = np.concatenate([self.asked, np.zeros(len(missing), bool)])
        return at

    def _forget(self) -> None:
        size = len(self.words)
        self.asked[size - size // 4:] = True
        kept = np.flatnonzero(self.asked)[-(size // 2):] if size > 1 else np.empty(0, np.int64)
        self.known, self.ends = self._ids_at(kept)
        self.words = self.words.take(pa.array(kept))
        self.asked = np.zeros(len(kept), bool)


@lru_cache(maxsize=4)
def batch_encoder(
    path: str, pattern: str | None = None, remembered: int = REMEMBERED_BYTES
) -> BatchEncoder:
    """One encoder per Python worker, which outlives the tasks it serves."""
    return BatchEncoder(ChunkEncoder(load_tokenizer(path, pattern), 0), remembered)


@lru_cache(maxsize=4)
def chunk_encoder(
    path: str, pattern: str | None = None, remembered: int = REMEMBERED
) -> ChunkEncoder:
    """One encoder per Python worker, which outlives the tasks it serves."""
    return ChunkEncoder(load_tokenizer(path, pattern), remembered)


workers.forgets(chunk_encoder.cache_clear)
workers.forgets(batch_encoder.cache_clear)


def int_lists(arrays: Iterable[np.ndarray]) -> pa.ListArray:
    arrays = list(arrays)
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))


def slices(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts hold about ``most`` bytes, at least one row each."""
    sizes = np.asarray(
        pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), np.int64
    )
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def encode(
    docs: DataFrame,
    path: str,
    pattern: str | None = None,
    text_col: str = "text",
    ids_col: str = "ids",
    offsets_col: str | None = None,
) -> DataFrame:
    """All columns of ``docs`` but the text, then ``ids`` (array<int>).

    ``offsets_col`` names a further array of (start, end) code points, one per id. Null and empty
    texts give empty arrays; special tokens are ordinary text. Rows may repeat, texts of any
    length are encoded whole. An existing column of the same name as a new one is replaced.
    """
    new = {ids_col.lower(), (offsets_col or ids_col).lower()}
    others = [c for c in docs.columns if c.lower() not in new | {text_col.lower()}]
    text = free_name(docs, "whole_text")
    given = docs.select(*others, whole_text(text_col).alias(text))
    fields = [given.schema[c] for c in others]
    fields.append(T.StructField(ids_col, T.ArrayType(T.IntegerType(), False)))
    if offsets_col:
        pair = T.StructType([T.StructField("start", T.IntegerType()),
                             T.StructField("end", T.IntegerType())])
        fields.append(T.StructField(offsets_col, T.ArrayType(pair, False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(path, pattern)
        for batch in batches:
            for part in slices(batch, len(others)):
                texts = part.column(len(others)).to_pylist()
                columns, names = part.columns[:-1], list(others)
                if offsets_col:
                    made = [encoder.ids_and_offsets(t) for t in texts]
                    lists = int_lists(ids for ids, _ in made)
                    spans = np.concatenate([s for _, s in made]).astype(np.int32)
                    pairs = pa.StructArray.from_arrays(
                        [pa.array(spans[:, 0]), pa.array(spans[:, 1])], ["start", "end"]
                    )
                    columns += [lists, pa.ListArray.from_arrays(lists.offsets, pairs)]
                    names += [ids_col, offsets_col]
                else:
                    columns.append(int_lists(map(encoder.ids, texts)))
                    names.append(ids_col)
                yield pa.RecordBatch.from_arrays(columns, names)

    return given.mapInArrow(run, T.StructType(fields))


@lru_cache(maxsize=4)
def token_bytes(path: str, pattern: str | None = None) -> list[bytes]:
    """The bytes of every id, by the reversed byte table; special tokens as their own text."""
    tokenizer = load_tokenizer(path, pattern)
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    table = [b""] * (max(tokenizer.get_vocab().values()) + 1)
    for token, number in tokenizer.get_vocab().items():
        mapped = [byte_of.get(c) for c in token]
        table[number] = token.encode() if None in mapped else bytes(mapped)
    return table


def decode(
    encoded: DataFrame,
    path: str,
    pattern: str | None = None,
    ids_col: str = "ids",
    bytes_col: str = "decoded_bytes",
    text_col: str | None = None,
) -> DataFrame:
    """All columns of ``encoded`` with ``decoded_bytes`` added, and ``text_col`` if named.

    A null list, and a list with a null or an unknown id, give null. A cut list may begin or end
    inside a character: its bytes are exact, and its text has U+FFFD for what is not whole.
    """
    added = {bytes_col.lower(), (text_col or bytes_col).lower()}
    others = [c for c in encoded.columns if c.lower() not in added]
    fields = [encoded.schema[c] for c in others]
    fields.append(T.StructField(bytes_col, T.BinaryType()))
    if text_col:
        fields.append(T.StructField(text_col, T.StringType()))
    place = [c.lower() for c in others].index(ids_col.lower())

    def one(table: list[bytes]) -> Callable[[list[int] | None], bytes | None]:
        def join(ids: list[int] | None) -> bytes | None:
            if ids is None or None in ids:
                return None
            if ids and not 0 <= min(ids) <= max(ids) < len(table):
                return None
            return b"".join(map(table.__getitem__, ids))

        return join

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join = one(token_bytes(path, pattern))
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                made = [join(ids) for ids in part.column(place).to_pylist()]
                columns = [*part.columns, pa.array(made, pa.binary())]
                names = [*others, bytes_col]
                if text_col:
                    texts = [None if b is None else b.decode("utf-8", "replace") for b in made]
                    columns.append(pa.array(texts, pa.string()))
                    names.append(text_col)
                yield pa.RecordBatch.from_arrays(columns, names)

    return encoded.select(*others).mapInArrow(run, T.StructType(fields))


def decode_stream(pieces: Iterable[Iterable[int]], table: list[bytes]) -> Iterator[str]:
    """Text of consecutive id lists; a character cut between two lists comes with the second."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for ids in pieces:
        yield decoder.decode(b"".join(map(table.__getitem__, ids)))
    yield decoder.decode(b"", final=True)
