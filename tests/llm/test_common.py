"""Helpers that the operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from quotewell.llm import embedding_dedup, secret_scan
from quotewell.llm.common import lowest


def test_lowest_hashes(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("at"), F.col("id").alias("x"))
    pairs = sorted((r.at, r.x) for r in rows.collect())
    even = F.col("x") % 2 == 0
    for limit in (1, 40, 4999, 5000, 9000):
        found = lowest(rows, "at", "x", limit, len(pairs))["x"].to_pylist()
        assert found == [x for _, x in pairs[:limit]]
        found = lowest(rows, "at", "x", limit, 2500, even)["x"].to_pylist()
        assert found == [x for _, x in pairs if x % 2 == 0][:limit]
    # All hashes in the upper half, and all alike.
    for at in (F.col("id"), F.lit(1 << 62)):
        uneven = spark.range(5000).select(at.alias("at"), F.col("id").alias("x"))
        assert lowest(uneven, "at", "x", 10, 5000)["x"].to_pylist() == list(range(10))
    assert len(lowest(rows.limit(0), "at", "x", 10, 0)) == 0


def test_the_fit_sample_of_secrets_is_that_of_a_full_sort(spark, monkeypatch):
    monkeypatch.setattr(secret_scan, "FIT_DOCUMENTS", 60)
    taken = []
    monkeypatch.setattr(secret_scan, "labelled_strings",
                        lambda texts: (taken.extend(texts), [])[:2])
    monkeypatch.setattr(secret_scan, "train", lambda *strings: None)
    rows = [(i, f"{'token' if i % 10 == 0 else 'word'} number {i}") for i in range(3000)]
    rows.append((3000, "x" * (secret_scan.FIT_CHARS + 1)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    secret_scan.fit(frame)
    hashed = frame.select(F.xxhash64(F.col("doc_id").cast("string"), "text").alias("at"), "text")
    ranked = [r.text for r in hashed.orderBy("at", "text").collect() if r.text[0] != "x"]
    assert taken == [*[t for t in ranked if t[0] == "t"][:30],
                     *[t for t in ranked if t[0] == "w"][:30]]


def test_odd_tables_for_secrets(spark):
    kind = "doc_id long, text string, at string, spans int, kind string"
    rows = [(1, "secret = abcdefgh1", "a", 1, "b")] * 2 + [(None, None, None, None, None),
                                                          (2, "", "c", 2, "d")]
    frame = spark.createDataFrame(rows, kind)
    assert secret_scan.fit(frame.limit(0)) is None
    assert secret_scan.scan(frame.limit(0), None).count() == 0
    found = secret_scan.scan(frame, secret_scan.fit(frame)).collect()
    assert sorted(len(r.spans) for r in found) == [0, 0, 1, 1]
    assert {r["at"] for r in found} == {"a", None, "c"}


def test_odd_tables_for_vectors(spark, stages):
    kind = "vec_id long, embedding array<float>, label int, id int, class string, rep string"
    close = [1.0, 0.1, 0.0, 0.0]
    rows = [
        (1, [1.0, 0.0, 0.0, 0.0], 0, 5, "x", "y"), (2, close, 0, 5, "x", "y"),
        (2, close, 0, 5, "x", "y"), (None, close, 0, 5, "x", "y"),
        (3, [0.0, 1.0, 0.0, 0.0], 0, 5, "x", "y"), (4, close, None, 5, "x", "y"),
    ]
    frame = spark.createDataFrame(rows, kind)
    assert embedding_dedup.near_vectors(frame.limit(0), stages).count() == 0
    found = sorted(embedding_dedup.near_vectors(frame, stages).collect(),
                   key=lambda r: (r.vec_id is None, r.vec_id))
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in found[:5]] == [
        (1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True)]
    assert len(found) == 6 and found[5].n_links == 0 and found[5].kept


def test_components_of_vectors_by_brute_force(spark, stages):
    rng = np.random.default_rng(7)
    base = rng.standard_normal((12, 16))
    points = base[rng.integers(0, 12, 150)] + 0.08 * rng.standard_normal((150, 16))
    rows = [(i * 3 + 1, p.astype("float32").tolist(), 0) for i, p in enumerate(points)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    smallest = {i: i for i in unit}
    links = [(i, j) for i in unit for j in unit if i < j and unit[i] @ unit[j] >= 0.93]
    for _ in unit:
        for i, j in links:
            smallest[i] = smallest[j] = min(smallest[i], smallest[j])
    found = embedding_dedup.near_vectors(frame, stages).collect()
    assert {r.vec_id: r.component_id for r in found} == smallest
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
