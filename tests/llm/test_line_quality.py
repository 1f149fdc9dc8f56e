"""Line labelling: counts by brute force, decoding by enumeration, verdicts by held-out labels."""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quotewell.llm import line_quality, queries
from quotewell.llm.labelled import balanced_sample

LABELLED = "/root/testdata/sf0.01"
TEXTS = [
    None, "", "\n\n", "a", "a b c a b c", "a b c\na b c\n\na b c ", "x | y\r\n# $ %%", "é é é é",
    "one two three " * 40, "\n".join(f"line {i} goes on." for i in range(30)),
    "a\x0bb\x0cc\td e f", " ".join(f"u{i}" for i in range(30_000)), "same\n" * 60,
    "b c a b c", "w " * 50,
]


def by_hand(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for k, window in enumerate(zip(words, words[1:], words[2:])):
        if windows[window] > 1:
            covered |= {k, k + 1, k + 2}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated,
            len(covered), failed)


def values(row) -> tuple:
    return tuple(row[name] for name in (*line_quality.COUNTS, "base_failed"))


def test_query(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op11_line_quality"](spark, LABELLED).collect()}
    table = pq.read_table(f"{LABELLED}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert len(rows) == len(table)
    for doc in table:
        assert values(rows[doc["doc_id"]]) == by_hand(doc["text"])
    assert not any(r.kept and r.base_failed for r in rows.values())
    labels = {r["doc_id"]: r["quality"]
              for r in pq.read_table(f"{LABELLED}/labels.parquet").to_pylist()}
    held_out = [r for r in rows.values() if not r.base_failed and labels.get(r.doc_id) is not None
                and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    good = [r.kept for r in held_out if labels[r.doc_id] == 1]
    bad = [r.kept for r in held_out if labels[r.doc_id] == 0]
    assert len(good) > 50 and len(bad) >= 5
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.2


@pytest.fixture(scope="module")
def model():
    good = "It is a plain sentence.\nAnd so is this one, here.\nNothing is odd about it."
    bad = "## && $$ home\n| buy | now |\n%% ## **"
    sample = [(f"{good} {k}", 1) for k in range(20)] + [(f"{bad} {k}", 0) for k in range(5)]
    found = line_quality.fit(sample)
    assert found is not None and 0 < found.least_share < 1
    return found


def test_odd_rows(spark, model):
    schema = ("doc_id long, text string, kept string, n_words string, line_quality int, "
              "boilerplate int")
    rows = [(i, t, "k", "n", 1, 2) for i, t in enumerate(TEXTS)]
    rows += [rows[9], (None, *rows[9][1:])]
    docs = spark.createDataFrame(rows, schema)
    found = line_quality.label_lines(docs, model)
    assert found.columns[:2] == ["doc_id", "text"] and "line_quality" in found.columns
    got = found.collect()
    assert len(got) == len(rows)
    for row in got:
        assert values(row) == by_hand(row.text)
        assert row.kept == (not row.base_failed and row.content_share >= model.least_share)
    assert line_quality.label_lines(docs.limit(0), model).collect() == []
    for row in line_quality.label_lines(docs, None).collect():
        assert row.kept == (not row.base_failed) and row.boilerplate == []


def test_lines_are_marked_by_number(spark, model):
    text = "It is a plain sentence.\n\n| buy | now | ## $$\nAnd so is this one, here."
    row = line_quality.label_lines(spark.createDataFrame([(text,)], "text string"), model).first()
    assert row.boilerplate == [2] and 0.5 < row.content_share < 1


def test_viterbi_by_enumeration():
    rng = np.random.default_rng(3)
    sizes = np.array([3, 0, 1, 6, 2])
    odds = rng.normal(0, 2, sizes.sum())
    start, move = rng.uniform(0.1, 2, 2), rng.uniform(0.1, 2, (2, 2))
    tags = np.split(line_quality.viterbi(odds, sizes, start, move), np.cumsum(sizes)[:-1])
    for own, found in zip(np.split(odds, np.cumsum(sizes)[:-1]), tags):
        def weight(path, own=own):
            total = sum(o for o, tag in zip(own, path) if tag)
            steps = zip(path, path[1:])
            first = np.log(start[path[0]]) if path else 0.0
            return total + first + sum(np.log(move[a, b]) for a, b in steps)

        best = max(itertools.product([0, 1], repeat=len(own)), key=weight)
        assert tuple(found.astype(int)) == best


def test_ties_are_content():
    tags = line_quality.viterbi(np.zeros(4), np.array([4]), np.ones(2), np.ones((2, 2)))
    assert not tags.any()


def test_many_distinct_words_are_compared_exactly():
    ids = np.array([3_000_000, 1, 2, 3_000_000, 1, 2, 0, 3_000_000, 1])
    owner = np.array([0, 0, 0, 0, 0, 0, 1, 1, 1])
    assert line_quality._repeated_words(ids, owner).tolist() == [True] * 6 + [False] * 3


def test_one_kind_gives_no_model():
    assert line_quality.fit([]) is None
    assert line_quality.fit([("a b", 1)]) is None
    assert line_quality.fit([("a b", 1), ("", 0)]) is None


def test_a_rare_label_is_in_the_sample(spark, stages):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") != 777).cast("int").alias("quality"))
    sample, shares = balanced_sample(
        docs, labels, "quality", F.lit(True), stages, fit_rows=20)
    assert Counter(label for _, label in sample) == {1: 10, 0: 1}
    assert shares == (1 / 2000, 1999 / 2000)
