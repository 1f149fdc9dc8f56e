"""The registered text queries on the small tables, against brute force and held-out labels."""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from conftest import SMALL
from tokenizers import Tokenizer

from quotewell.llm import queries

LABELLED = "/root/testdata/sf0.01"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.fixture(scope="module")
def texts():
    table = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"])
    return {r["doc_id"]: r["text"] or "" for r in table.to_pylist()}


def words(text: str) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def smallest_reachable(ids, links) -> dict[int, int]:
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in links:
        low, high = sorted((root(i), root(j)))
        parent[high] = low
    return {i: root(i) for i in ids}


@pytest.mark.parametrize(("name", "label", "folds", "out"), [
    ("op4_toxicity", "toxic", 5, 0), ("op7_quality", "quality", 3, 1),
])
def test_held_out_accuracy(spark, name, label, folds, out):
    truth = {r["doc_id"]: r[label]
             for r in pq.read_table(f"{LABELLED}/labels.parquet").to_pylist()}
    rows = queries.QUERIES[name](spark, LABELLED).collect()
    assert len(rows) == pq.read_table(f"{LABELLED}/documents.parquet").num_rows
    hits = []
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % folds == out)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)
        if row.held_out and truth.get(row.doc_id) is not None:
            hits.append(row.predicted == truth[row.doc_id])
    assert len(hits) > 20 and np.mean(hits) >= 0.95


def base_matches(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed forms, by code points."""
    forms = [
        (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 8),
        (r"AKIA[A-Z0-9]+", 0, 16), (r"[0-9a-f]+", 0, 32),
    ]
    return sorted(
        (m.start(), kind, m.end()) for kind, (form, group, least) in enumerate(forms)
        for m in re.finditer(form, text, re.ASCII) if len(m.group(group)) >= least
    )


def test_secrets(spark, texts):
    rows = queries.QUERIES["op6_secret_scan"](spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for row in rows:
        found = base_matches(texts[row.doc_id])
        counts = Counter(kind for _, kind, _ in found)
        assert (row.n_assign, row.n_access, row.n_hex) == (counts[0], counts[1], counts[2])
        listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in found)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(row.spans.split(","))


def test_near(spark, texts):
    sets = {}
    for name, text in texts.items():
        own = words(text.translate(LOWER))
        sets[name] = set(zip(own, own[1:], strict=False)) or ({tuple(own)} if own else set())
    ids = sorted(i for i in sets if sets[i])
    links = [
        (i, j) for k, i in enumerate(ids) for j in ids[k + 1:]
        if 100 * (both := len(sets[i] & sets[j])) >= 80 * (len(sets[i]) + len(sets[j]) - both)
    ]
    wanted = smallest_reachable(sets, links)
    rows = queries.QUERIES["op8_minhash_dedup"](spark, SMALL).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows} == {
        (i, len(s), wanted[i], wanted[i] == i) for i, s in sets.items()}


def test_substrings(spark, texts):
    counts = Counter()
    for text in texts.values():
        own = words(text)
        counts.update(hash(tuple(own[k:k + 35])) for k in range(len(own) - 34))
    rows = queries.QUERIES["op5_substring_dedup"](spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for row in rows:
        own = words(texts[row.doc_id])
        keep = np.ones(len(own), bool)
        for k in range(len(own) - 34):
            if counts[hash(tuple(own[k:k + 35]))] > 1:
                keep[k:k + 35] = False
        kept = " ".join(w for w, k in zip(own, keep, strict=True) if k)
        assert (row.n_words, row.n_removed) == (len(own), int((~keep).sum()))
        assert row.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_packing(spark, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}
    rows = queries.QUERIES["op9_packing"](spark, SMALL).collect()
    filled, at = Counter(), Counter()
    for row in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        piece = np.array(ids[row.doc_id][row.start:row.start + row.length], "<u4")
        assert row.start == at[row.doc_id] and row.doc_tokens == len(ids[row.doc_id])
        assert row.ids_crc32 == zlib.crc32(piece.tobytes())
        at[row.doc_id] += row.length
    assert at == {i: len(v) for i, v in ids.items()}
    for row in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert row.offset == filled[row.sequence_id]
        filled[row.sequence_id] += row.length
    assert all(n <= 2048 and n & (n - 1) == 0 for n in filled.values())


def test_vectors(spark):
    table = pq.read_table(f"{SMALL}/embeddings.parquet").to_pylist()
    good = [r for r in table if r["embedding"] and r["label"] is not None
            and None not in r["embedding"] and np.isfinite(r["embedding"]).all()
            and np.any(r["embedding"])]
    x = np.array([r["embedding"] for r in good], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    labels = np.array([r["label"] for r in good])
    near = (x @ x.T >= 0.93) & (labels[:, None] == labels)
    np.fill_diagonal(near, False)
    true = dict(zip((r["vec_id"] for r in good), near.sum(1).tolist(), strict=True))
    rows = queries.QUERIES["op10_embedding_dedup"](spark, SMALL).collect()
    assert len(rows) == len(table)
    assert all(r.n_links <= true.get(r.vec_id, 0) for r in rows)
    assert sum(r.n_links for r in rows) >= 0.9 * sum(true.values())
