"""Each operator on odd rows, against brute force."""

from __future__ import annotations

import hashlib
import re
import string

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quotewell.llm import (
    chat,
    embedding_dedup,
    exact_dedup,
    minhash,
    packing,
    quality,
    queries,
    secret_scan,
    substring_dedup,
    toxicity,
    workers,
)
from quotewell.llm.labelled import balanced_sample, labelled_texts

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
PASSAGE = " ".join(f"w{i}" for i in range(60))
TEXTS = [
    None, "", " \n", "One Two three", "one two THREE", "É x", "é x", PASSAGE,
    "before " + PASSAGE + " after", PASSAGE + " tail", "solo", "SOLO", "a b " * 3000,
    " ".join(f"u{i}" for i in range(5000)),
]
# Clashing names, a repeated row, and rows that tie.
SCHEMA = ("doc_id long, text string, keep_id string, key string, slice long, score double, "
          "spans string, shard int, id int, kept string, hits int")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "k", "k", 1, 0.5, "s", 1, 1, "k", 1) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[3]], SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_exact(docs, none, stages):
    found = exact_dedup.exact_dedup(docs, stages, digest_all=True).collect()
    same: dict[str, list[int]] = {}
    for row in docs.collect():
        same.setdefault((row.text or "").translate(LOWER), []).append(row.doc_id)
    assert len(found) == docs.count()
    for row in found:
        text = (TEXTS[row.doc_id] or "").translate(LOWER)
        assert (row.keep_id, row.group_size) == (max(same[text]), len(same[text]))
        assert row.kept == (row.keep_id == row.doc_id)
        assert row.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    kept = exact_dedup.drop_copies(docs, stages)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {max(v) for v in same.values()}
    assert exact_dedup.exact_dedup(none, stages).count() == 0


def test_exact_with_repeated_ids(spark, stages):
    rows = [(5, "A one"), (5, "B two"), (9, "B two"), (7, "C"), (7, "C"), (8, "D")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(tuple(r) for r in exact_dedup.drop_copies(frame, stages).collect())
    assert kept == [(5, "A one"), (7, "C"), (8, "D"), (9, "B two")]


def test_exact_without_ids_and_with_clashing_columns(spark, stages):
    """A row without an id counts in its group, never is the one that stays, and is not dropped."""
    rows = [(None, "Same"), (4, "same"), (2, "SAME"), (None, "lone"), (None, "LONE"),
            (6, "sane"), (3, ""), (1, None)]
    frame = spark.createDataFrame(
        [(i, t, "b", "p", "f", "n") for i, t in rows],
        "doc_id long, text string, bytes string, prefix string, full_hash string, n_bytes string")
    found = {(r.doc_id, r.keep_id, r.group_size, r.kept)
             for r in exact_dedup.exact_dedup(frame, stages).collect()}
    assert found == {(None, 4, 3, False), (4, 4, 3, True), (2, 4, 3, False), (None, None, 2, True),
                     (6, 6, 1, True), (3, 3, 2, True), (1, 3, 2, False)}
    kept = exact_dedup.drop_copies(frame, stages)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [
        (0, "LONE"), (0, "Same"), (0, "lone"), (3, ""), (4, "same"), (6, "sane")]
    assert exact_dedup.drop_copies(frame.limit(0), stages).count() == 0


def test_one_copy_among_many_of_its_length(spark, stages):
    """One copy among rows that share its length, prefixes told apart or not."""
    rows = [(i, f"text number {i} of its own") for i in range(400)]
    rows.append((900, "text number 7 of its own"))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for chars in (4, 64):
        kept = exact_dedup.drop_copies(frame, stages, prefix_chars=chars)
        assert {r.doc_id for r in kept.collect()} == {*range(400), 900} - {7}


def test_chat(spark):
    rows = [
        (1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "</s> \\1 <s>"),
        (1, 1, "assistant", "</s> \\1 <s>"), (2, None, None, None), (2, 3, "to|ol<", "\\"),
        (3, 0, "system", "<<SYS>>x<</SYS>>"), (3, 1, "", "<|/role|>"), (None, 0, "user", "hi"),
        (4, 1, "assistant", "é😀[INST]"), (4, 0, "user", "<"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    out = chat.format_chats(turns).withColumn("turns", chat.parse(F.col("formatted")))
    out = out.withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()
    assert len(out) == 5 and all(r.round_trip for r in out)
    for row in out:
        own = sorted(((t if t is not None else -1), r or "", x or "")
                     for c, t, r, x in rows if c == row.conv_id)
        assert [(t.role, t.text) for t in row.turns] == [(r, x) for _, r, x in own]
        assert row.loss == "".join(x for _, r, x in own if r == "assistant")
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_substrings(docs, none, stages):
    every = [r.text for r in docs.collect()]
    counts: dict[tuple, int] = {}
    for text in every:
        own = words(text)
        for k in range(len(own) - 34):
            window = tuple(own[k:k + 35])
            counts[window] = counts.get(window, 0) + 1
    for row in substring_dedup.substring_dedup(docs, stages).collect():
        own = words(TEXTS[row.doc_id])
        keep = [True] * len(own)
        for k in range(len(own) - 34):
            if counts[tuple(own[k:k + 35])] > 1:
                keep[k:k + 35] = [False] * 35
        left = [w for w, k in zip(own, keep, strict=True) if k]
        assert (row.n_words, row.n_removed) == (len(own), len(own) - len(left))
        assert row.kept_text == " ".join(left)
    assert substring_dedup.substring_dedup(none, stages).count() == 0


def test_near(docs, none, stages):
    def shingles(text):
        own = words((text or "").translate(LOWER))
        return set(zip(own, own[1:], strict=False)) or ({tuple(own)} if own else set())

    sets = {i: shingles(t) for i, t in enumerate(TEXTS)}
    parent = {i: i for i in sets}
    for _ in sets:
        for i, x in sets.items():
            for j, y in sets.items():
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    parent[i] = parent[j] = min(parent[i], parent[j])
    found = minhash.near_duplicates(docs, stages, shingle=2).collect()
    assert len(found) == docs.count()
    for row in found:
        assert (row.n_shingles, row.component_id) == (len(sets[row.doc_id]), parent[row.doc_id])
    assert minhash.near_duplicates(none, stages).count() == 0


def test_packing(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack(docs, path, ids_col="ids", window=64, shard_bytes=20_000).collect()
    lengths: dict[int, int] = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == lengths.get(p.sequence_id, 0) and p.length == len(p.ids)
        lengths[p.sequence_id] = p.offset + p.length
    assert all(n <= 64 and n & (n - 1) == 0 for n in lengths.values())
    encoder = packing.chunk_encoder(path)
    total = sum(len(encoder.ids(r.text or "")) + 1 for r in docs.collect())
    assert sum(lengths.values()) == total
    own = sorted((p.start, p.ids) for p in pieces if p.doc_id == 13)
    assert [i for _, ids in own for i in ids] == [*encoder.ids(TEXTS[13]).tolist(), 1]
    assert packing.pack(none, path).count() == 0


def test_packing_finds_planted_neighbours(spark):
    rng = np.random.default_rng(4)
    names = ["".join(rng.choice(list("bcdfghklmnprstvz"), 7)) for _ in range(1200)]
    common = ["the", "of", "and", "to", "in", "is", "that", "for", "was", "with"]

    def text(own):
        return " ".join(str(rng.choice(own if rng.random() < 0.5 else common)) for _ in range(80))

    # Sixty groups of four that share twenty names each, group after group apart.
    texts = [(k, text(names[20 * (k % 60):20 * (k % 60) + 20])) for k in range(240)]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack(frame, path, window=1024, shard_bytes=9_000).collect()
    held: dict[int, set[int]] = {}
    for p in pieces:
        held.setdefault(p.doc_id, set()).add(p.sequence_id)
    assert len({p.sequence_id >> 32 for p in pieces}) >= 8
    together = [bool(held[a] & held[b]) for a in range(240) for b in range(a + 60, 240, 60)]
    assert np.mean(together) >= 0.5


def test_packing_scores_with_all_terms():
    rng = np.random.default_rng(8)
    # Thirty rare terms of the seed are in one short rest; the others share common terms only.
    rests = [np.concatenate([np.arange(30), np.arange(100, 160), [1]]),
             np.concatenate([np.arange(30), [1]])]
    rests += [np.concatenate([rng.choice(np.arange(100, 160), 40, False), [1]]) for _ in range(30)]
    df, n, tokens = packing.counted(rests)
    corpus = packing.Corpus(df, n, tokens / n)
    found = packing.Index(rests, corpus).neighbours(0).tolist()
    scores = {}
    for other, rest in enumerate(rests):
        norm = packing.K1 * (1 - packing.B + packing.B * len(rest) / corpus.mean)
        scores[other] = sum(
            np.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * (rest == t).sum() * (packing.K1 + 1)
            / ((rest == t).sum() + norm) for t in np.unique(rests[0]) if df[t] > 1 and t in rest)
    assert set(found) == {other for other, score in scores.items() if score}
    ranked = [scores[other] for other in found]
    assert all(a >= b - 1e-9 for a, b in zip(ranked, ranked[1:], strict=False))


def test_packing_asks_only_for_rests_that_have_tokens_left(monkeypatch):
    rng = np.random.default_rng(9)
    rests = [rng.integers(0, 60, rng.integers(5, 90)) for _ in range(80)]
    df, n, tokens = packing.counted(rests)
    corpus = packing.Corpus(df, n, tokens / n)
    score, asked = packing.Index.neighbours, []

    def counting(index, seed, *left):
        asked.append(len(score(index, seed, *left)))
        return score(index, seed, *left)

    monkeypatch.setattr(packing.Index, "neighbours", counting)
    sequences = packing.fill(rests, corpus, 128)
    packed = sorted((d, start + k) for s in sequences for d, start, n in s for k in range(n))
    assert packed == [(d, k) for d, rest in enumerate(rests) for k in range(len(rest))]
    # Each window uses rests up, so fewer and fewer are scored.
    assert sum(asked) < 0.7 * len(asked) * len(rests)


def test_packing_keys_and_counts_of_blocks(monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_RESTS", 7)
    rng = np.random.default_rng(10)
    rests = [rng.integers(0, rng.integers(1, 70_000), rng.integers(1, 60)) for _ in range(60)]
    rests += [np.array([3]), np.array([69_999] * 5)]
    df, n, tokens = packing.counted(iter(rests))
    assert (n, tokens) == (len(rests), sum(map(len, rests)))
    plain = np.zeros(len(df), np.int64)
    for rest in rests:
        plain[np.unique(rest)] += 1
    assert df.tolist() == plain.tolist()
    order = packing.Order(packing.Corpus(df, n, tokens / n), 20)
    for rest, found in zip(rests, order.keys(iter(rests)), strict=True):
        ranks = np.unique(order.rank[rest])
        for least, terms, key in ((order.common, packing.PLACE_TERMS, found[0]),
                                  (order.least, packing.KEY_TERMS, found[1])):
            own = [*ranks[ranks >= least].tolist(), *[packing.NO_TERM] * terms][:terms]
            assert np.frombuffer(key, ">u4").tolist() == own


def test_vectors(spark, stages):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((40, 16))
    near = base[rng.integers(0, 40, 160)] + 0.12 * rng.standard_normal((160, 16))
    rows = [(i, v.astype("float32").tolist(), i % 2) for i, v in enumerate([*base, *near])]
    rows += [(300, rows[0][1], 0), (301, None, 0), (302, [0.0] * 16, 0), (303, [], 0),
             (304, rows[0][1], None), (305, [float("nan")] * 16, 0), (306, [1.0, 2.0], 0),
             (307, [None] * 16, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = {r.vec_id: r for r in embedding_dedup.near_vectors(frame, stages).collect()}
    good = [(i, np.array(v, float), label) for i, v, label in rows
            if i < 301 or i == 306]
    true = {i: 0 for i, *_ in rows}
    for i, x, k in good:
        for j, y, m in good:
            if i != j and k == m and len(x) == len(y):
                true[i] += x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93
    assert len(found) == len(rows)
    assert all(found[i].n_links <= n for i, n in true.items())
    assert sum(found[i].n_links for i in true) >= 0.9 * sum(true.values())
    assert all(found[i].kept and not found[i].n_links for i in range(301, 308))


def test_vectors_with_a_common_mean():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 64))
    x[:, 0] = 0
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x *= np.sqrt(0.06)
    x[:, 0] = np.sqrt(0.94)
    bits = embedding_dedup.substring_bits(len(x))
    tables = embedding_dedup.tables_for(bits, 0.93)
    step = 64 // bits
    codes = embedding_dedup.Codes(x, 64, -(-tables // step))
    i, j = rng.integers(0, len(x), (2, 20_000))
    near = ((x[i] * x[j]).sum(1) >= 0.93) & (i != j)
    differ = codes.bits(x[i[near]]) != codes.bits(x[j[near]])
    starts = [t // step * 64 + t % step * bits for t in range(tables)]
    met = np.any([~differ[:, a:a + bits].any(1) for a in starts], axis=0)
    chance = np.arccos(0.93) / np.pi
    n = differ.shape[1]
    limit = n * chance + embedding_dedup.SLACK * np.sqrt(n * chance * (1 - chance)) + 1
    assert near.sum() > 10_000
    assert np.mean(met & (differ.sum(1) <= int(limit))) >= 0.98


def test_secrets(spark, docs):
    rng = np.random.default_rng(3)
    made = ["".join(rng.choice(list(string.ascii_letters + string.digits), 32)) for _ in range(300)]
    plain = [f"{a}_{b}_{a}" for a in ("alpha", "value", "number", "reader") for b in
             ("writer", "holder", "parser", "stream", "column")] * 20
    detector = secret_scan.train([m.encode() for m in made[:250]], [p.encode() for p in plain])
    text = f"é password: tok secret = \"abcdefgh1\" {made[299]} AKIA{'Q' * 12} {plain[0]} {'0f' * 16}"
    kinds = [(k, text[a:b]) for k, a, b in secret_scan.find(text, detector)]
    assert kinds == [("assign", 'secret = "abcdefgh1'), ("markov", made[299]),
                     ("access", "AKIA" + "Q" * 12), ("hex", "0f" * 16)]
    # A match that is too short still uses up what it covers.
    assert secret_scan.find("password: token: abcdefgh1", None) == []
    frame = spark.createDataFrame([(0, text), (1, None)], "doc_id long, text string")
    rows = secret_scan.scan(frame, detector).withColumn(
        "clean", secret_scan.redact(F.col("text"), F.col("spans"))).collect()
    assert [len(r.spans) for r in rows] == [4, 0]
    assert rows[0].clean.startswith('é password: tok [assign]" [markov] [access]')


def test_secrets_beside_names():
    rng = np.random.default_rng(3)

    def key(n):
        return "".join(rng.choice(list(string.ascii_letters + string.digits), n))

    plain = [f"{a}_{b}_{c}".encode() for a in ("azure", "client", "session", "aws", "storage")
             for b in ("account", "credential", "key", "client", "reader")
             for c in ("name", "holder", "session", "value", "number")]
    plain += [p.upper() for p in plain]
    detector = secret_scan.train([key(32).encode() for _ in range(500)], plain)
    for n in (16, 18, 24, 32):
        for name in ("AZURE_STORAGE_ACCOUNT_KEY", "AWS_SESSION_CREDENTIAL", "client_credential"):
            made = [key(n) for _ in range(50)]
            hits = [("markov", len(name) + 1, len(name) + 1 + n)
                    in secret_scan.find(f"{name}={m}", detector) for m in made]
            assert np.mean(hits) >= 0.9, (n, name)
    beside = f"{'0f' * 16}_{key(32)}"
    assert [k for k, _, _ in secret_scan.find(beside, detector)] == ["hex", "markov"]
    padded = key(30) + "=="
    assert secret_scan.find(padded, detector) == [("markov", 0, 32)]
    assert not any(secret_scan.find(f"{p.decode()}={q.decode()}", detector)
                   for p, q in zip(plain, plain[1:], strict=False))


def test_classifiers(spark, docs, none):
    bad = [(f"{w} " * 40, 0) for w in ("spam", "junk", "buy")] * 10
    good = [(" ".join(f"w{(i * k) % 97}" for i in range(60)), 1) for k in range(1, 31)]
    ranking = quality.fit(bad + good)
    scored = {r.text: r.score for r in quality.score(
        spark.createDataFrame(bad + good, "text string, label int"), ranking).collect()}
    assert all((scored[t] >= 0.5) == bool(label) for t, label in bad + good)
    assert quality.fit([]) == 0.0 and quality.fit(good) == 1.0
    assert quality.score(none, ranking).count() == 0
    assert all(0 <= r.score <= 1 for r in quality.score(docs, ranking).collect())

    clean = [(" ".join(f"w{(i * k) % 97}" for i in range(60)), 0) for k in range(1, 61)]
    rude = [(t + " you nasty toad", 1) for t, _ in clean[:30]]
    tagger = toxicity.fit(clean + rude)
    frame = spark.createDataFrame([("", 0), (None, 0), ("w3 nasty toad w4", 1)], "text string, n int")
    rows = toxicity.score(frame, tagger).collect()
    assert [r.score >= 0.5 for r in rows] == [False, False, True]
    assert [(s.start, s.end) for s in rows[2].spans] == [(3, 13)]
    assert toxicity.fit([]) == 0.0
    assert toxicity.score(none, tagger).count() == 0


def test_a_rare_label_is_still_learned(spark, stages):
    """Two bad documents among 2,000 labelled ones, of which 200 are fitted."""
    rng = np.random.default_rng(6)
    texts = [" ".join(f"Word{i} of" for i in rng.integers(0, 900, 30)) for _ in range(2000)]
    texts[700] = texts[1400] = "@@ ## $$ " * 30
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, int(i not in (700, 1400))) for i in range(2000)], "doc_id long, quality int")
    sample, shares = balanced_sample(
        frame, labels, "quality", F.lit(True), stages, fit_rows=200)
    assert shares == (0.001, 0.999) and len(sample) == 102
    model = quality.fit(sample, shares)
    scores = model.scores(np.stack([quality.features(text) for text in texts]))
    assert max(scores[[700, 1400]]) < 0.5
    assert (np.delete(scores, [700, 1400]) >= 0.5).mean() > 0.98


def test_quality_is_fitted_to_every_labelled_row(spark, stages, monkeypatch):
    """Bad documents that are all long, and blocks with few of them."""
    rng = np.random.default_rng(8)
    good = [" ".join(f"Word{i} of" for i in rng.integers(0, 900, 30)) for _ in range(90)]
    bad = ["@@ ## $$ " * int(n) for n in rng.integers(2_500, 2_600, 10)]
    docs = spark.createDataFrame(
        [*enumerate(good + bad), (3, "short"), (None, "w")], "doc_id long, text string")
    labels = spark.createDataFrame(
        [*((i, int(i < 90)) for i in range(100)), (0, 1), (7, 0), (8, None), (None, 0), (500, 0)],
        "doc_id long, quality int")
    texts = labelled_texts(docs, labels, "quality", F.lit(True), stages)
    found = {r.id: (r.text, r.label) for r in texts.collect()}
    assert found == {i: (t, int(i < 90)) for i, t in enumerate(good + bad) if i != 7}

    whole = quality.fit(list(found.values()))
    model = quality.fit_all(texts, stages)
    for name in ("mean", "scale", "weights", "threshold", "spread"):
        assert np.allclose(getattr(model, name), getattr(whole, name), rtol=1e-6, atol=1e-8)

    monkeypatch.setattr(quality, "BLOCK_ROWS", 7)
    monkeypatch.setattr(quality, "PARTNERS", 3)
    model = quality.fit_all(texts, stages)
    scores = {i: model.scores(quality.features(t)[None])[0] for i, (t, _) in found.items()}
    assert {i for i, score in scores.items() if score < 0.5} == set(range(90, 100))
    assert quality.fit_all(texts.where("label = 1"), stages) == 1.0
    assert quality.fit_all(texts.where("label = 2"), stages) == 0.0


def test_op7_learns_from_long_documents(spark, tmp_path):
    texts = [f"Word{i} of a plain text {i}." for i in range(30)] + ["@@ ## $$ " * 2_500] * 30
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 30)) for i in range(60)], "doc_id long, quality int"
                          ).write.parquet(f"{tmp_path}/labels.parquet")
    rows = queries.QUERIES["op7_quality"](spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows if r.predicted} == set(range(30))


def test_the_threshold_is_a_quantile_under_the_given_shares():
    rng = np.random.default_rng(7)
    pool = [(" ".join(f"Word{i} of" for i in rng.integers(0, 900, 30)), 1) for _ in range(60)]
    pool += [("@@ ## $$ " * int(n), 0) for n in rng.integers(1, 40, 20)]
    plain, weighted = quality.fit(pool), quality.fit(pool, (0.25, 0.75))
    assert plain.threshold == weighted.threshold
    strengths = ((np.stack([quality.features(t) for t, _ in pool]) - plain.mean) / plain.scale
                 ) @ plain.weights
    by_hand = sorted(zip(strengths, (label for _, label in pool)))
    for shares in ((0.01, 0.99), (0.6, 0.4)):
        mass, k = 0.0, 0
        while mass < shares[0] * (1 - 1e-9):
            mass += shares[1] / 60 if by_hand[k][1] else shares[0] / 20
            k += 1
        expected = (by_hand[k - 1][0] + by_hand[k][0]) / 2
        assert np.isclose(quality.fit(pool, shares).threshold, expected)


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(9)
    odds, first = rng.normal(size=9), np.zeros(9, bool)
    first[[0, 4, 5]] = True
    start, move = np.array([0.7, 0.3]), np.array([[0.9, 0.2], [0.4, 0.8]])
    chance, total = np.zeros(9), 0.0
    for code in range(512):
        tags = [(code >> k) & 1 for k in range(9)]
        weight = np.exp(np.dot(odds, tags))
        for k, tag in enumerate(tags):
            weight *= start[tag] if first[k] else move[tags[k - 1], tag]
        total += weight
        chance += weight * np.array(tags)
    assert np.allclose(toxicity.marginals(odds, first, start, move)[0], chance / total)


def test_blocks_are_compared_alike_by_bits_and_by_marks(monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.choice(1 << 40, 300, replace=False).astype(np.uint64)
    sets = [np.sort(np.concatenate([base[: 300 - k], rng.choice(1 << 40, 7 * (k % 3)).astype(np.uint64)]))
            for k in range(0, 120, 5)] + [np.empty(0, np.uint64)]
    rows = pa.table({
        "id": range(len(sets)), "block": [k % 2 for k in range(len(sets))],
        "component": range(len(sets)), "shingles": pa.array([s.tobytes() for s in sets], pa.binary()),
    })
    by_bits = minhash.link_block(rows, 80)
    monkeypatch.setattr(minhash, "PACKED_BYTES", 0)
    assert by_bits and minhash.link_block(rows, 80) == by_bits


def test_a_task_of_another_operator_empties_memories():
    emptied = []
    workers.forgets(lambda: emptied.append(1))
    for operator in ("one", "one", "two", "one"):
        workers.enter(operator)
    workers.trim()
    assert len(emptied) in (2, 3)  # three if another operator ran in this process before
