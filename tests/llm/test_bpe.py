"""Byte-level BPE against the tiktoken library, and round trips."""

from __future__ import annotations

import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from quotewell.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
JSON = public_tokenizers.path("byte_bpe_50k.json")

PARTS = [
    "a", "aa", " ", "  ", "\n", "\t", "\r\n", " ", "\u0085", "　", "é", "ß", "日本",
    "1", "²", "½", "٣", "'s", "'S", "'ll", "’", "😀", "​", "\x1c", "\0", "-", "====", "́",
    "ẞ", "İ", "ж", "don't", "I'm", "<|endoftext|>", "ŉ", "ǅ", "ɏ", "ɐ",
]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={}
    )


def strange_texts() -> list[str]:
    rng = random.Random(7)
    mixed = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    runs = [c * n for c in "aehlnostz=-_*# \n\t1é" for n in range(1, 70)]
    latin = ["".join(chr(rng.randint(0, 0x24F)) for _ in range(60)) for _ in range(1500)]
    anything = [
        "".join(chr(rng.choice([rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x10FFFF)]))
                for _ in range(30))
        for _ in range(1500)
    ]
    return ["", *mixed, *runs, *latin, *anything]


def test_ids_equal_tiktoken(reference):
    encoder = bpe.chunk_encoder(PATH, PATTERN)
    for text in strange_texts():
        assert encoder.ids(text).tolist() == reference.encode_ordinary(text), ascii(text)


def test_forgetting_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    encoder = bpe.ChunkEncoder(bpe.load_tokenizer(PATH, PATTERN))
    for text in strange_texts()[:500]:
        assert encoder.ids(text).tolist() == reference.encode_ordinary(text)


@pytest.mark.parametrize(("path", "pattern"), [(PATH, PATTERN), (JSON, None)])
def test_chunks_and_whole_texts_agree(path, pattern):
    tokenizer = bpe.load_tokenizer(path, pattern)
    encoder = bpe.chunk_encoder(path, pattern)
    for text in strange_texts()[::7]:
        whole = tokenizer.encode(text, add_special_tokens=False)
        ids, spans = encoder.ids_and_offsets(text)
        assert ids.tolist() == whole.ids
        assert list(map(tuple, spans.tolist())) == whole.offsets


def test_round_trip_with_odd_rows_and_columns(spark):
    texts = [None, "", "é😀" * 10, "word " * 200_000, "same", "same", "<|endoftext|>"]
    rows = [(i, t, "x", 1.5, [1]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, whole_text string, decoded_bytes double, ids array<int>"
    )
    encoded = bpe.encode(docs, PATH, PATTERN, offsets_col="offsets")
    out = bpe.decode(encoded, PATH, PATTERN, text_col="again").collect()
    assert [r.again for r in sorted(out)] == [t or "" for t in texts]
    for row in out:
        assert len(row.ids) == len(row.offsets)
        assert bytes(row.decoded_bytes).decode() == (texts[row.doc_id] or "")
        assert row.whole_text == "x"


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, PATH, PATTERN), PATH, PATTERN).collect() == []


def test_bad_ids_give_null(spark):
    rows = [(0, None), (1, [None]), (2, [10**6]), (3, [-1]), (4, [])]
    encoded = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    out = {r.doc_id: r.decoded_bytes for r in bpe.decode(encoded, PATH, PATTERN).collect()}
    assert out == {0: None, 1: None, 2: None, 3: None, 4: b""}


def test_cut_characters(reference):
    table = bpe.token_bytes(PATH, PATTERN)
    text = "né 日本😀 ok"
    ids = bpe.chunk_encoder(PATH, PATTERN).ids(text).tolist()
    assert "".join(bpe.decode_stream([[i] for i in ids], table)) == text
    assert b"".join(table[i] for i in ids) == text.encode()


@pytest.mark.parametrize(("path", "pattern"), [(PATH, PATTERN), (JSON, None)])
def test_batches_are_encoded_as_whole_texts(path, pattern):
    """Cuts between every two odd parts, and a memory that forgets in between."""
    tokenizer = bpe.load_tokenizer(path, pattern)
    texts = strange_texts()[::3]
    texts += [a + b + c for a in PARTS for b in [*PARTS[:8], "\xa0", "×", "à"] for c in PARTS]
    whole = [m.ids for m in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for remembered in (0, 2_000, 1 << 20):
        encoder = bpe.BatchEncoder(bpe.ChunkEncoder(tokenizer), remembered)
        for at in range(0, len(texts), 900):
            batch = pa.array(["skipped", *texts[at:at + 900]])[1:]
            ids, begins = encoder.ids(batch)
            found = [ids[a:b].tolist() for a, b in zip(begins, begins[1:], strict=False)]
            assert found == whole[at:at + 900]
    for empty in ([], ["", ""]):
        ids, begins = encoder.ids(pa.array(empty, pa.string()))
        assert len(ids) == 0 and begins.tolist() == [0] * (len(empty) + 1)


def test_a_small_batch_is_looked_up_without_a_table_of_the_memory(monkeypatch):
    encoder = bpe.BatchEncoder(bpe.ChunkEncoder(bpe.load_tokenizer(JSON)), 1 << 20)
    encoder.ids(pa.array([" ".join(f"w{i}" for i in range(5000))]))
    look_up, tables = pa.compute.index_in, []

    def counting(words, value_set):
        tables.append(len(value_set))
        return look_up(words, value_set=value_set)

    monkeypatch.setattr(pa.compute, "index_in", counting)
    ids, _ = encoder.ids(pa.array(["w1 w2", "new w4999"]))
    whole = encoder.chunks.tokenizer.encode_batch(["w1 w2", "new w4999"], add_special_tokens=False)
    assert ids.tolist() == [i for made in whole for i in made.ids]
    assert tables and max(tables) < 10
