"""Content and boilerplate lines by a linear-chain conditional random field, Viterbi decoded.

A document's lines with a word are a sequence with two tags. The field is fitted to lines of
labelled documents: those of bad documents are boilerplate, and so are lines of good ones that
repeat an earlier line; all others are content. The share of a document's characters in lines
decoded as content decides whether it stays, with the cut that parts the labelled documents best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewell.llm.bpe import slices
from quotewell.llm.common import free_name, whole_text
from quotewell.llm.toxicity import marginals

STEPS = 200
PENALTY = 1.0
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of words in repeated windows
SLICE_BYTES = 2 << 20
RESULT = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,"
    "n_repeat_words:bigint,content_share:double,boilerplate:array<int>>"
)
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

# Classes of bytes: letters, digits, space within a line, line end, sentence marks, the symbols
# that are counted, other marks, beginnings and continuations of characters beyond ASCII.
LOWER, UPPER, DIGIT, SPACE, LINE_END, SENTENCE, SYMBOL, MARK, WIDE, INNER = range(10)
CLASSES = 10
_CLASS = np.full(256, MARK, np.uint8)
_CLASS[0xC0:], _CLASS[0x80:0xC0] = WIDE, INNER
for _chars, _number in (
    (b"abcdefghijklmnopqrstuvwxyz", LOWER), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER),
    (b"0123456789", DIGIT), (b" \t\x0b\x0c\r", SPACE), (b"\n", LINE_END), (b".,;:?'\"", SENTENCE),
    (b"#*$%&|<>", SYMBOL),
):
    _CLASS[list(_chars)] = _number


@dataclass
class Lines:
    """Counts per document and features of every line with a word, of several documents."""

    counts: np.ndarray  # documents x COUNTS
    sizes: np.ndarray  # lines with a word per document
    numbers: np.ndarray  # number of each such line in its document, from 0
    chars: np.ndarray  # code points in words of each such line
    repeats: np.ndarray  # whether it repeats an earlier line
    features: np.ndarray


def _ranks(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1]


def _repeated_words(ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which words lie in a window of three that its document holds twice or more."""
    marked = np.zeros(len(ids), bool)
    if len(ids) < 3:
        return marked
    limit = int(ids.max()) + 1
    pair = ids[:-2] * limit + ids[1:-1]
    if limit >= 1 << 21:
        pair = _ranks(pair)
    key = pair * limit + ids[2:]
    whole = np.flatnonzero(owner[:-2] == owner[2:])
    key, own = key[whole], owner[whole]
    order = np.lexsort((own, key))
    key, own = key[order], own[order]
    same = (key[1:] == key[:-1]) & (own[1:] == own[:-1])
    twice = np.zeros(len(key), bool)
    twice[1:] |= same
    twice[:-1] |= same
    at = whole[order[twice]]
    for shift in range(3):
        marked[at + shift] = True
    return marked


def read_lines(texts: list[bytes]) -> Lines:
    """Lines of UTF-8 texts. Words are parted by ASCII white space, lines by line feeds."""
    raw = b"\n".join(texts)
    kinds = _CLASS[np.frombuffer(raw, np.uint8)]
    is_end = kinds == LINE_END
    line_of = np.cumsum(is_end) - is_end
    per_text = np.array([text.count(b"\n") + 1 for text in texts], np.int64)
    n_lines = int(per_text.sum())
    text_of_line = np.repeat(np.arange(len(texts)), per_text)
    classes = np.bincount(line_of * CLASSES + kinds, minlength=n_lines * CLASSES)
    classes = classes[: n_lines * CLASSES].reshape(n_lines, CLASSES)

    inside = (kinds != SPACE) & ~is_end
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    numbered: dict[bytes, int] = {}
    ids = np.fromiter((numbered.setdefault(w, len(numbered)) for w in raw.split()),
                      np.int64, len(starts))
    line_of_word = line_of[starts]
    owner = text_of_line[line_of_word]
    repeated = _repeated_words(ids, owner)

    words = np.bincount(line_of_word, minlength=n_lines)
    repeats = np.zeros(n_lines, bool)
    line = 0
    for text, size in zip(texts, per_text.tolist(), strict=True):
        if size > 1:
            seen: set[bytes] = set()
            for k, content in enumerate(text.split(b"\n")):
                if content in seen:
                    repeats[line + k] = True
                else:
                    seen.add(content)
        line += size
    held = words > 0
    repeats &= held
    word_chars = classes.sum(1) - classes[:, [SPACE, LINE_END, INNER]].sum(1)

    def per_text_sum(values: np.ndarray) -> np.ndarray:
        return np.bincount(text_of_line, values, len(texts)).astype(np.int64)

    repeated_in_line = np.bincount(line_of_word, repeated, n_lines)
    counts = np.stack([
        per_text_sum(words), per_text_sum(word_chars), per_text_sum(classes[:, SYMBOL]),
        per_text_sum(repeats), per_text_sum(repeated_in_line),
    ], 1)

    first, last = kinds[starts], kinds[ends - 1]
    again = np.zeros(len(ids), bool)
    again[1:] = (ids[1:] == ids[:-1]) & (line_of_word[1:] == line_of_word[:-1])

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(line_of_word, flags, n_lines)[held] / words[held]

    n = words[held]
    chars = np.maximum(word_chars[held], 1)
    heads = np.concatenate([[0], np.cumsum(words)[:-1]])[held] if len(ids) else held[held]
    tails = heads + n - 1 if len(ids) else heads
    shown = classes[held]
    marks = np.sqrt(shown[:, [LOWER, UPPER, DIGIT, SENTENCE, SYMBOL, MARK, WIDE]] / chars[:, None])
    features = np.column_stack([
        np.ones(len(n)), marks, np.log1p(n), np.log1p(chars / np.maximum(n, 1)),
        share(first == UPPER), share((last == SYMBOL) | (last == MARK)), share(last == SENTENCE),
        share(repeated), share(again), repeats[held],
        first[heads] == UPPER, last[tails] == SENTENCE, n == 1,
    ])
    line_starts = np.cumsum(per_text) - per_text
    return Lines(
        counts=counts,
        sizes=np.bincount(text_of_line[held], minlength=len(texts)),
        numbers=(np.arange(n_lines) - line_starts[text_of_line])[held],
        chars=word_chars[held],
        repeats=repeats[held],
        features=features.astype(float),
    )


def viterbi(odds: np.ndarray, sizes: np.ndarray, start: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The likeliest tags of several sequences laid end to end; tag 0 where both are as likely.

    ``odds``: log potential of tag 1 over tag 0; ``start``, ``move``: potentials of the first tag
    and of a tag after a tag. All sequences advance together, the longest first.
    """
    order = np.argsort(-sizes, kind="stable")
    heads = (np.cumsum(sizes) - sizes)[order]
    lengths = sizes[order]
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    (m00, m01), (m10, m11) = np.log(move)
    lead = np.zeros(len(odds))
    from_one, from_zero = np.zeros(len(odds), bool), np.zeros(len(odds), bool)
    now = np.full(len(lengths), np.log(start[1]) - np.log(start[0]))
    for t in range(steps):
        at = heads[: active[t]] + t
        d = now[: active[t]]
        if t:
            from_one[at], from_zero[at] = d + m11 > m01, d + m10 > m00
            d = np.maximum(d + m11, m01) - np.maximum(d + m10, m00)
        now[: active[t]] = lead[at] = d + odds[at]
    tags = np.zeros(len(odds), bool)
    for t in reversed(range(steps)):
        going = active[t + 1] if t + 1 < steps else 0
        at = heads[: active[t]] + t
        tags[at[going:]] = lead[at[going:]] > 0
        after = at[:going] + 1
        tags[at[:going]] = np.where(tags[after], from_one[after], from_zero[after])
    return tags


@dataclass(frozen=True)
class Labeller:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    start: np.ndarray
    move: np.ndarray
    least_share: float

    def tag(self, lines: Lines) -> np.ndarray:
        """Which lines are boilerplate."""
        odds = ((lines.features - self.mean) / self.scale) @ self.weights
        return viterbi(odds, lines.sizes, self.start, self.move)


def content_shares(lines: Lines, tags: np.ndarray) -> np.ndarray:
    """Share of each document's characters in words that lies in content lines; 0 without words."""
    owner = np.repeat(np.arange(len(lines.sizes)), lines.sizes)
    good = np.bincount(owner, lines.chars * ~tags, len(lines.sizes))
    return good / np.maximum(lines.counts[:, 1], 1)


def _cut(shares: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    """The least share of a good document with the least weight on the wrong side; the middle of
    the widest such gap."""
    order = np.argsort(shares, kind="stable")
    edges = np.concatenate([[0.0], shares[order], [1.0]])
    good, bad = weight * (labels == 1), weight * (labels == 0)
    wrong = np.concatenate([[0.0], np.cumsum(good[order])]) + np.concatenate(
        [np.cumsum(bad[order][::-1])[::-1], [0.0]])
    gaps = np.diff(edges)
    best = np.flatnonzero((wrong <= wrong[gaps > 0].min() + 1e-9) & (gaps > 0))
    k = best[np.argmax(gaps[best])]
    return float((edges[k] + edges[k + 1]) / 2)


def fit(sample: list[tuple[str, int]], shares: tuple[float, float] | None = None) -> Labeller | None:
    """A labeller from texts with label 1 (good) or 0 (bad); None unless both kinds have words.

    ``shares`` are the shares of bad and of good ones among all labelled documents, if the sample
    holds them in other proportions; documents are weighted accordingly.
    """
    labels = np.array([label for _, label in sample], int)
    lines = read_lines([text.encode("utf-8", "replace") for text, _ in sample] or [b""])
    worded = lines.sizes[: len(labels)] > 0
    if len(set(labels[worded].tolist())) < 2:
        return None
    found = np.bincount(labels, minlength=2) / len(labels)
    ratio = np.array(shares or found) / found
    weight = ratio[labels] / (ratio[labels]).mean()
    owner = np.repeat(np.arange(len(labels)), lines.sizes)
    truth = (labels[owner] == 0) | lines.repeats
    mean, scale = lines.features.mean(0), lines.features.std(0)
    mean[0] = 0.0
    scale[scale < 1e-9] = 1.0
    x = (lines.features - mean) / scale
    first = np.zeros(len(x), bool)
    first[(np.cumsum(lines.sizes) - lines.sizes)[lines.sizes > 0]] = True
    inner = np.flatnonzero(~first)
    each = weight[owner]
    tags = truth.astype(int)
    true_moves = np.zeros((2, 2))
    np.add.at(true_moves, (tags[inner - 1], tags[inner]), each[inner])
    true_start = np.bincount(tags[first], each[first], 2)
    size = x.shape[1]
    theta, momentum, square = (np.zeros(size + 6) for _ in range(3))
    for step in range(1, STEPS + 1):
        start, move = theta[size:size + 2], theta[size + 2:].reshape(2, 2)
        tagged, pairs = marginals(x @ theta[:size], first, np.exp(start), np.exp(move))
        chance = tagged[first]
        expected = np.array([(each[first] * (1 - chance)).sum(), (each[first] * chance).sum()])
        moves = (pairs() * each[inner][:, None, None]).sum(0)
        gradient = np.concatenate([
            x.T @ (each * (truth - tagged)), true_start - expected, (true_moves - moves).ravel(),
        ]) - PENALTY * theta
        momentum = 0.9 * momentum + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta = theta + 0.1 * (momentum / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    start, move = np.exp(theta[size:size + 2]), np.exp(theta[size + 2:].reshape(2, 2))
    raw = Labeller(mean, scale, theta[:size], start, move, 0.0)
    found = content_shares(lines, raw.tag(lines))
    use = worded
    cut = _cut(found[use], labels[use], weight[use])
    return Labeller(mean, scale, theta[:size], start, move, cut)


def label_lines(
    docs: DataFrame, model: Labeller | None, text_col: str = "text", kept_col: str = "kept"
) -> DataFrame:
    """All columns of ``docs`` with the counts, ``content_share``, ``boilerplate``,
    ``base_failed`` and ``kept`` added or replaced.

    ``boilerplate`` lists the numbers, from 0, of lines decoded as such; lines without a word are
    never among them. A document fails the base rules with fewer than 50 words or with more than
    half of them in windows of three that occur twice; it is kept if it passes and its content
    share reaches the cut. Without a model every line is content. Null counts as empty: no words,
    share 0, not kept. Equal texts get equal results.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labeller = sent.value
        kinds = [pa.int64()] * 5 + [pa.float64(), pa.list_(pa.int32())]
        names = [*COUNTS, "content_share", "boilerplate"]
        for batch in batches:
            made = []
            for part in slices(pa.record_batch([batch], ["text"]), 0, SLICE_BYTES):
                lines = read_lines(part.column(0).to_pylist())
                if labeller is None:
                    tags = np.zeros(len(lines.chars), bool)
                else:
                    tags = labeller.tag(lines)
                owner = np.repeat(np.arange(len(lines.sizes)), lines.sizes)
                per_text = np.bincount(owner[tags], minlength=len(lines.sizes))
                offsets = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)
                numbers = pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(lines.numbers[tags].astype(np.int32)))
                columns = [*lines.counts.T, content_shares(lines, tags), numbers]
                made.append(pa.StructArray.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, k)
                     for c, k in zip(columns, kinds, strict=True)], names))
            if made:
                yield pa.concat_arrays(made)
            else:
                yield pa.array([], pa.struct(list(zip(names, kinds, strict=True))))

    packed = free_name(docs, "line_quality")
    tagged = docs.withColumn(
        packed, F.arrow_udf(run, RESULT)(whole_text(text_col).cast("binary")))
    found = tagged.withColumns({name: F.col(f"{packed}.{name}")
                                for name in (*COUNTS, "content_share", "boilerplate")})
    failed = (F.col(f"{packed}.n_words") < LEAST_WORDS) | (
        100 * F.col(f"{packed}.n_repeat_words") > MOST_REPEATED * F.col(f"{packed}.n_words"))
    cut = 0.0 if model is None else model.least_share
    return found.withColumns({
        "base_failed": failed,
        kept_col: ~failed & (F.col(f"{packed}.content_share") >= cut),
    }).drop(packed)
