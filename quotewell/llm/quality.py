"""Document quality by Bradley-Terry pairwise ranking.

A document's strength is linear in features of its text. The weights maximise the likelihood that
a good document beats a bad one, which is logistic loss on the difference of their features. The
threshold is the quantile of the training strengths that leaves the share of bad documents below,
of all labelled documents where the sample holds more of a rare label than they do.

``fit_all`` fits to every labelled document of a table. They are dealt to blocks by a hash of their
ids, those of the rarer label to several if there are few, and all pairs of a block count. Each Newton
step adds up loss, gradient and curvature of the blocks in one job.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from quotewell.functions.quantiles import exact_quantiles
from quotewell.llm import workers
from quotewell.llm.common import whole_text
from quotewell.sources.stages import Stages

STEPS = 60  # Newton steps at most; they end when the loss no longer falls
ENOUGH = 1e-12  # fall of the loss that a further step would bring
PENALTY = 1e-3
BLOCK_ROWS = 512  # labelled documents of a block, about
PARTNERS = 64  # documents of the rarer label in a block, about, if there are as many

# Byte classes: lower, upper, digit, space, line end, sentence mark, other mark, beyond ASCII.
_CLASS = np.full(256, 6, np.uint8)
_CLASS[128:] = 7
for _chars, _number in (
    (b"abcdefghijklmnopqrstuvwxyz", 0), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2),
    (b" \t\x0b\x0c", 3), (b"\r\n", 4), (b".,;:?'\"", 5),
):
    _CLASS[list(_chars)] = _number
_MARKED = re.compile(rb"[!#$%&*|<>{}=~^@_/\\]+\Z")


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def features(text: str) -> np.ndarray:
    """Rates of byte-class pairs, and how repetitive and how regular words and lines are."""
    raw = text.encode("utf-8", "replace")
    kinds = _CLASS[np.frombuffer(raw, np.uint8)].astype(np.int64)
    pairs = np.bincount(kinds[:-1] * 8 + kinds[1:], minlength=64)
    words = raw.split()
    counts = Counter(words)
    n = len(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    most = max(counts.values(), default=0)
    marked = sum(1 for word in counts if _MARKED.search(word))
    return np.concatenate([
        np.sqrt(pairs / max(1, len(raw))),
        [
            np.log1p(n), np.log1p(len(raw)), _share(len(raw), n) ** 0.5,
            _share(len(counts), n), _share(np.log1p(len(counts)), np.log1p(n)), _share(most, n),
            _share(sum(map(eq, words, words[1:])), n), _share(marked, len(counts)),
            _share(sum(1 for word in counts if word.isupper()), len(counts)),
            _share(len(set(lines)), len(lines)), _share(n, max(1, len(lines))) ** 0.5 / 10,
            float(n == 0),
        ],
    ])


@dataclass(frozen=True)
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    spread: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """0.5 at the threshold, towards 1 above it."""
        strength = ((rows - self.mean) / self.scale) @ self.weights
        return 1 / (1 + np.exp(np.clip((self.threshold - strength) / self.spread, -500, 500)))


def pair_sums(good: np.ndarray, bad: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Loss, gradient and curvature in one row, summed over all pairs of a good and a bad document."""
    gap = np.clip((good @ weights)[:, None] - bad @ weights, -500, 500)
    pull = 1 / (1 + np.exp(gap))
    loss = np.logaddexp(0, -gap).sum()
    gradient = pull.sum(0) @ bad - pull.sum(1) @ good
    pull *= 1 - pull
    mixed = good.T @ (pull @ bad)
    curvature = (
        (good.T * pull.sum(1)) @ good + (bad.T * pull.sum(0)) @ bad - mixed - mixed.T
    )
    return np.concatenate([[loss], gradient, curvature.ravel()])


def _least(size: int, sums: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The weights of least mean loss and penalty, by Newton steps that are halved if it rises."""

    def at(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        found = sums(weights)
        return (
            found[0] + PENALTY / 2 * weights @ weights,
            found[1:size + 1] + PENALTY * weights,
            found[size + 1:].reshape(size, size) + PENALTY * np.eye(size),
        )

    weights = np.zeros(size)
    loss, gradient, curvature = at(weights)
    for _ in range(STEPS):
        step = np.linalg.solve(curvature, gradient)
        if gradient @ step < ENOUGH:
            break
        tried = at(weights - step)
        while tried[0] > loss and gradient @ step >= ENOUGH:
            step = step / 2
            tried = at(weights - step)
        if tried[0] > loss:
            break
        weights = weights - step
        loss, gradient, curvature = tried
    return weights


def fit(
    sample: list[tuple[str, int]], shares: tuple[float, float] | None = None
) -> Ranking | float:
    """A ranking, or without documents of both kinds the share of good ones (0 without any).

    ``shares`` are those of bad and good documents among all labelled ones, if the sample is
    drawn by label; the threshold is then the quantile of the strengths weighted back to them.
    """
    labels = np.array([label for _, label in sample], int)
    if labels.sum() in (0, len(labels)):
        return float(labels.mean()) if len(labels) else 0.0
    rows = np.stack([features(text) for text, _ in sample])
    mean, scale = rows.mean(0), rows.std(0)
    scale[scale < 1e-9] = 1.0
    x = (rows - mean) / scale
    good, bad = x[labels == 1], x[labels == 0]
    parts = np.array_split(good, -(-len(good) // BLOCK_ROWS))
    weights = _least(x.shape[1], lambda weights: sum(
        pair_sums(part, bad, weights) for part in parts) / (len(good) * len(bad)))
    strength = x @ weights
    order = np.argsort(strength, kind="stable")
    strength = strength[order]
    if shares is None:
        below = len(bad)
    else:
        each = np.where(labels == 1, shares[1] / len(good), shares[0] / len(bad))
        below = int(np.searchsorted(each[order].cumsum(), shares[0] * (1 - 1e-9))) + 1
        below = min(below, len(order) - 1)
    threshold = float((strength[below - 1] + strength[below]) / 2)
    return Ranking(mean, scale, weights, threshold, float(max(strength.std(), 1e-9)) / 4)


def _vectors(column: pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(x.as_py()) for x in column])


def _moments(table: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of each label, 0 and 1; mean and mean square deviation of every feature."""

    def merged(parts: list[tuple]) -> tuple:
        """Counts, means and squared deviations of several parts together."""
        sizes = np.array([part[0].sum() for part in parts], float)[:, None]
        means = np.stack([part[1] for part in parts])
        mean = (means * sizes).sum(0) / sizes.sum()
        squares = sum(part[2] for part in parts) + (sizes * (means - mean) ** 2).sum(0)
        return sum(part[0] for part in parts), mean, squares

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            if batch.num_rows:
                x = _vectors(batch.column("x"))
                counts = np.bincount(batch.column("label").to_numpy(), minlength=2)
                parts.append((counts, x.mean(0), ((x - x.mean(0)) ** 2).sum(0)))
        if parts:
            counts, mean, squares = merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v.astype(float).tobytes()], pa.binary())
                 for v in (counts, mean, squares)], ["counts", "mean", "squares"])

    rows = table.mapInArrow(run, "counts binary, mean binary, squares binary").collect()
    if not rows:
        return np.zeros(2), np.zeros(0), np.zeros(0)
    counts, mean, squares = merged([tuple(map(np.frombuffer, row)) for row in sorted(rows)])
    return counts, mean, squares / counts.sum()


def fit_all(texts: DataFrame, stages: Stages) -> Ranking | float:
    """As ``fit``, to every row of ``texts`` (id, label 0 or 1, text); ids are unique."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("quality")
        for batch in batches:
            made = [features(text.as_py()).tobytes() for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("at"), batch.column("label"), pa.array(made, pa.binary())],
                ["at", "label", "x"])
        workers.trim()

    given = texts.select(
        F.xxhash64("id").alias("at"), F.col("label").cast("int").alias("label"), "text")
    table = stages.write(
        given.mapInArrow(described, "at long, label int, x binary"), "fit-features")
    counts, mean, square = _moments(table)
    n = int(counts.sum())
    if not counts.all():
        return float(counts[1] / n) if n else 0.0
    scale = np.sqrt(square)
    scale[scale < 1e-9] = 1.0

    rarer = int(counts[1] < counts[0])
    blocks = -(-n // BLOCK_ROWS)
    copies = min(blocks, -(-PARTNERS * blocks // int(counts[rarer])))
    dealt = table.withColumn(
        "copy", F.explode(F.when(F.col("label") == rarer, F.sequence(F.lit(0), F.lit(copies - 1)))
                          .otherwise(F.array(F.lit(0)))))
    first = F.pmod("at", F.lit(blocks))
    dealt = dealt.withColumn("block", F.pmod(first + F.col("copy"), F.lit(blocks)))

    def together(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("at", "ascending"), ("copy", "ascending"), ("x", "ascending")])
        x = (_vectors(rows["x"]) - mean) / scale
        label, copy = rows["label"].to_numpy(), rows["copy"].to_numpy()
        once = x[copy == 0]
        return pa.table({
            "block": rows["block"][:1],
            **{name: pa.array([part.tobytes()], pa.binary())
               for name, part in (("bad", x[label == 0]), ("good", x[label == 1]), ("once", once))},
        })

    kept = "block long, bad binary, good binary, once binary"
    gathered = stages.write(dealt.groupBy("block").applyInArrow(together, kept), "fit-blocks")
    size = len(mean)

    def matrix(value: pa.Scalar) -> np.ndarray:
        return np.frombuffer(value.as_py()).reshape(-1, size)

    def sums(weights: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, first = np.zeros(1 + size + size * size), None
            for batch in batches:
                for block, *pair in zip(*(batch.column(c) for c in ("block", "bad", "good"))):
                    bad, good = map(matrix, pair)
                    partners = len((bad, good)[rarer])
                    if partners:
                        total += pair_sums(good, bad, weights) / partners
                    first = block.as_py() if first is None else min(first, block.as_py())
            if first is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                    ["first", "total"])

        found = gathered.select("block", "bad", "good").mapInArrow(
            run, "first long, total binary").collect()
        return sum(np.frombuffer(row.total) for row in sorted(found)) / counts[1 - rarer]

    weights = _least(size, sums)

    def strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for once in batch.column("once"):
                yield pa.RecordBatch.from_arrays([pa.array(matrix(once) @ weights)], ["strength"])

    strong = stages.write(
        gathered.select("once").mapInArrow(strengths, "strength double"), "fit-strengths")
    spread = strong.agg(F.stddev_pop("strength")).first()[0]
    # Halfway between the last of as many as there are bad documents and the next.
    middle = {"threshold": (int(counts[0]) - 0.5) / (n - 1)}
    threshold = exact_quantiles(strong, "strength", middle, [], stages).first().threshold
    return Ranking(mean, scale, weights, threshold, float(max(spread, 1e-9)) / 4)


def score(
    docs: DataFrame, model: Ranking | float, score_col: str = "score", text_col: str = "text"
) -> DataFrame:
    """All columns of ``docs`` with the score added, or replaced if there is one of that name.

    From 0 to 1, higher for better documents; 0.5 and more is above the threshold. Null counts as
    empty; an empty text is scored by its features as any other. Equal texts score alike.
    """
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        workers.enter("quality")
        for batch in batches:
            if isinstance(model, float):
                yield pa.array(np.full(len(batch), model))
                continue
            # One text at a time leaves the batch's buffer; only features add up.
            rows = [features(text.as_py()) for text in batch]
            yield pa.array(model.scores(np.stack(rows)) if rows else np.empty(0))
        workers.trim()

    scored = F.arrow_udf(run, DoubleType())
    return docs.withColumn(score_col, scored(whole_text(text_col)))
