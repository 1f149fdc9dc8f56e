"""Toxic spans by a linear-chain conditional random field with two tags.

Labels are given per document. Words, and beginnings of words, that occur in far more toxic than
clean documents label the tokens of the toxic ones. The field is fitted to those token labels; its
forward-backward marginals tag spans, and a logistic function of their maximum and sum scores the
document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewell.llm.common import whole_text

WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 18
STEM_SIZES = (3, 4, 5, 6, 7)
FIT_ROWS = 3_000
LEAST_LOG_ODDS = 1.0  # of a word's document share in toxic against clean documents
LEAST_G = 25.0  # likelihood ratio statistic against equal shares (five standard errors)
EPOCHS = 30
BATCH_TOKENS = 1 << 20
REMEMBERED = 200_000
RESULT = "score double, spans array<struct<start:int,end:int>>"


def stems(word: str) -> list[str]:
    """The lower-cased word and its beginnings."""
    low = word.lower()
    return [f"w={low}", *(f"p={low[:size]}" for size in STEM_SIZES if len(low) > size)]


def buckets(word: str) -> list[int]:
    """Hash buckets of a word's features: bias, word, beginnings, end and case."""
    case = "A" if word.isupper() and len(word) > 1 else "Aa" if word[0].isupper() else "a"
    named = ["bias", f"s={word.lower()[-3:]}", f"c={case}", *stems(word)]
    return [crc32(name.encode("utf-8", "replace")) % BUCKETS for name in named]


def marginals(odds: np.ndarray, first: np.ndarray, start: np.ndarray, move: np.ndarray):
    """P(tag 1), and P(tag before, tag) where a token follows one, by forward-backward.

    ``odds``: log potential of tag 1 over tag 0 per token of several documents laid end to end;
    ``first``: which tokens begin a document; ``start``, ``move``: potentials of the first tag and
    of a tag after a tag. Tokens are cut into blocks; products of each block's 2 x 2 steps carry
    the messages across blocks, so that all blocks advance together.
    """
    n = len(odds)
    width = max(1, int(np.sqrt(n)))
    rows = -(-n // width)
    pad = rows * width - n
    scaled = np.exp(np.clip(np.concatenate([odds, np.zeros(pad)]), -30, 30)).reshape(rows, width)
    begins = np.concatenate([first, np.ones(pad, bool)]).reshape(rows, width)

    def step(t: int):
        """The entries of the step into token ``t`` of every block."""
        b, e = begins[:, t], scaled[:, t]
        return (np.where(b, start[0], move[0, 0]), np.where(b, start[1], move[0, 1]) * e,
                np.where(b, start[0], move[1, 0]), np.where(b, start[1], move[1, 1]) * e)

    one, zero = np.ones(rows), np.zeros(rows)
    a, b, c, d = one, zero, zero, one
    for t in range(width):
        p, q, r, s = step(t)
        a, b, c, d = a * p + b * r, a * q + b * s, c * p + d * r, c * q + d * s
        total = a + b + c + d
        a, b, c, d = a / total, b / total, c / total, d / total
    into, back = np.empty((rows, 2)), np.empty((rows, 2))
    now = np.array([0.5, 0.5])
    for k in range(rows):
        into[k] = now
        now = np.array([now[0] * a[k] + now[1] * c[k], now[0] * b[k] + now[1] * d[k]])
        now /= now.sum()
    now = np.array([0.5, 0.5])
    for k in reversed(range(rows)):
        back[k] = now
        now = np.array([a[k] * now[0] + b[k] * now[1], c[k] * now[0] + d[k] * now[1]])
        now /= now.sum()

    forward = np.empty((rows, width, 2))
    x, y = into[:, 0], into[:, 1]
    for t in range(width):
        p, q, r, s = step(t)
        x, y = x * p + y * r, x * q + y * s
        total = x + y
        x, y = x / total, y / total
        forward[:, t, 0], forward[:, t, 1] = x, y
    backward = np.empty((rows, width, 2))
    x, y = back[:, 0], back[:, 1]
    for t in reversed(range(width)):
        backward[:, t, 0], backward[:, t, 1] = x, y
        p, q, r, s = step(t)
        x, y = p * x + q * y, r * x + s * y
        total = x + y
        x, y = x / total, y / total
    forward, backward = forward.reshape(-1, 2)[:n], backward.reshape(-1, 2)[:n]
    both = forward * backward
    tagged = both[:, 1] / both.sum(1)

    def pairs() -> np.ndarray:
        inner = np.flatnonzero(~first)
        emit = np.stack([np.ones(len(inner)), scaled.reshape(-1)[inner]], 1)
        joint = forward[inner - 1][:, :, None] * move[None] * (emit * backward[inner])[:, None, :]
        return joint / joint.sum((1, 2), keepdims=True)

    return tagged, pairs


class Weighted(dict):
    """Word to its log odds of being toxic, for the words seen last."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = float(self.weights[buckets(word)].sum())
        return value


@dataclass(frozen=True)
class Tagger:
    weights: np.ndarray
    start: np.ndarray
    move: np.ndarray
    logistic: np.ndarray  # of (1, log odds of the highest marginal, log of 1 + their sum)

    def tag(self, words: list[list[str]], known: Weighted) -> list[np.ndarray]:
        sizes = np.array([len(w) for w in words], int)
        if not sizes.sum():
            return [np.empty(0) for _ in words]
        odds = np.fromiter((known[w] for doc in words for w in doc), float, sizes.sum())
        first = np.zeros(len(odds), bool)
        ends = sizes.cumsum()
        first[(ends - sizes)[sizes > 0]] = True
        tagged, _ = marginals(odds, first, self.start, self.move)
        return np.split(tagged, ends[:-1])

    def summary(self, tagged: list[np.ndarray]) -> np.ndarray:
        top = np.clip([t.max(initial=0.0) for t in tagged], 1e-9, 1 - 1e-9)
        total = np.array([t.sum() for t in tagged])
        return np.stack([np.ones(len(top)), np.log(top / (1 - top)), np.log1p(total)], 1)

    def scores(self, tagged: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.summary(tagged) @ self.logistic, -500, 500)))


def _marked_words(table: dict[str, int], docs: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Which words, or beginnings of them, are far commoner in toxic documents, beyond chance."""
    numbers: dict[str, int] = {}
    parts = [np.array([numbers.setdefault(s, len(numbers)) for s in stems(w)]) for w in table]
    toxic, clean = np.full(len(numbers), 0.5), np.full(len(numbers), 0.5)
    for words, label in zip(docs, labels, strict=True):
        if len(words):
            seen = np.unique(np.concatenate([parts[w] for w in np.unique(words)]))
            (toxic if label else clean)[seen] += 1
    n_toxic, n_clean = labels.sum() + 1, len(labels) - labels.sum() + 1
    odds = np.log(toxic / n_toxic) - np.log(clean / n_clean)
    share = n_toxic / (n_toxic + n_clean)
    both = toxic + clean
    g = 2 * (toxic * np.log(toxic / (both * share)) + clean * np.log(clean / (both * (1 - share))))
    found = (odds >= LEAST_LOG_ODDS) & (g >= LEAST_G)
    return np.array([found[p].any() for p in parts], bool)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps for a logistic fit with a small penalty."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        move = np.linalg.solve(hessian, x.T @ (y - p) - 0.1 * w)
        w = w + move * min(1.0, 5 / max(np.abs(move).max(), 1e-9))
    return w


def fit(sample: list[tuple[str, int]]) -> Tagger | float:
    """A tagger, or without documents of both kinds the share of toxic ones (0 without any)."""
    labels = np.array([label for _, label in sample], int)
    if labels.sum() in (0, len(labels)) or not any(WORD.search(text) for text, _ in sample):
        return float(labels.mean()) if len(labels) else 0.0
    table: dict[str, int] = {}
    docs = [
        np.array([table.setdefault(w, len(table)) for w in WORD.findall(text)], np.int64)
        for text, _ in sample
    ]
    marked = _marked_words(table, docs, labels)
    features = [buckets(w) for w in table]
    owner = np.repeat(np.arange(len(features)), [len(f) for f in features])
    hashed = np.array([b for f in features for b in f], np.int64)
    order = np.concatenate(docs)
    truth = np.concatenate([marked[d] & bool(label) for d, label in zip(docs, labels, strict=True)])
    truth = truth.astype(float)
    sizes = np.array([len(d) for d in docs])
    first = np.zeros(len(order), bool)
    first[(sizes.cumsum() - sizes)[sizes > 0]] = True

    weights = np.zeros(BUCKETS)
    weights[buckets("bias")[0]] = -2.0
    start, move = np.zeros(2), np.zeros((2, 2))  # log potentials
    seen = truth.astype(int)
    true_moves = np.zeros((2, 2))
    inner = np.flatnonzero(~first)
    np.add.at(true_moves, (seen[inner - 1], seen[inner]), 1)
    true_start = np.bincount(seen[first], minlength=2)
    squares, start_squares = np.full(BUCKETS, 1e-6), np.full(2, 1e-6)
    move_squares = np.full((2, 2), 1e-6)
    for _ in range(EPOCHS):
        odds = np.bincount(owner, weights[hashed], len(table))[order]
        tagged, pairs = marginals(odds, first, np.exp(start), np.exp(move))
        per_word = np.bincount(order, truth - tagged, len(table))
        gradient = np.bincount(hashed, per_word[owner], BUCKETS)
        gradient -= 0.05 * weights
        squares += gradient**2
        weights += 1.0 * gradient / np.sqrt(squares)
        expected = pairs().sum(0)
        chance = np.array([(1 - tagged[first]).sum(), tagged[first].sum()])
        start_gradient, move_gradient = true_start - chance, true_moves - expected
        start_squares += start_gradient**2
        move_squares += move_gradient**2
        start += 0.2 * start_gradient / np.sqrt(start_squares)
        move += 0.2 * move_gradient / np.sqrt(move_squares)
    raw = Tagger(weights, np.exp(start - start.max()), np.exp(move - move.max()), np.zeros(3))
    odds = np.bincount(owner, weights[hashed], len(table))[order]
    tagged, _ = marginals(odds, first, raw.start, raw.move)
    x = raw.summary(np.split(tagged, sizes.cumsum()[:-1]))
    return Tagger(raw.weights, raw.start, raw.move, _logistic(x, labels))


def spans_of(text: str, tagged: np.ndarray) -> list[dict]:
    """Runs of tokens with a marginal of one half or more, as code points of the text."""
    if not (tagged >= 0.5).any():
        return []
    found: list[dict] = []
    before = False
    for match, chance in zip(WORD.finditer(text), tagged, strict=True):
        if chance >= 0.5:
            if before:
                found[-1]["end"] = match.end()
            else:
                found.append({"start": match.start(), "end": match.end()})
        before = bool(chance >= 0.5)
    return found


def score(
    docs: DataFrame,
    model: Tagger | float,
    text_col: str = "text",
    score_col: str = "score",
    spans_col: str | None = "spans",
) -> DataFrame:
    """All columns of ``docs`` with ``score`` and, if named, ``spans`` added or replaced.

    The score is from 0 to 1, higher for toxic documents. Spans are runs of toxic tokens, as
    (start, end) code points, end exclusive. Null counts as empty; a text without words has no
    spans and the score of a document whose highest marginal is 0. Equal texts score alike.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tagger = sent.value
        known = None if isinstance(tagger, float) else Weighted(tagger.weights)
        for texts in batches:
            if known is None:
                yield pd.DataFrame({"score": np.full(len(texts), tagger),
                                    "spans": [[] for _ in range(len(texts))]})
                continue
            scores: list[np.ndarray] = []
            spans: list[list[dict]] = []
            held: list[str] = []
            words: list[list[str]] = []
            tokens = 0
            for k, text in enumerate(texts):
                held.append(text)
                words.append(WORD.findall(text))
                tokens += len(words[-1])
                if tokens >= BATCH_TOKENS or k == len(texts) - 1:
                    tagged = tagger.tag(words, known)
                    scores.append(tagger.scores(tagged))
                    spans += map(spans_of, held, tagged)
                    held, words, tokens = [], [], 0
            made = np.concatenate(scores) if scores else np.empty(0)
            yield pd.DataFrame({"score": made, "spans": spans})

    tagged = F.pandas_udf(run, RESULT)(whole_text(text_col))
    packed = spans_col or score_col
    made = docs.withColumn(packed, tagged)
    if not spans_col:
        return made.withColumn(score_col, F.col(packed)["score"])
    return made.withColumn(score_col, F.col(packed)["score"]).withColumn(
        spans_col, F.col(packed)["spans"]
    )
