"""Secret scan: fixed forms, and random-looking strings found by character Markov models.

Two order-2 character models, one of random strings and one of ordinary identifiers, are trained
from labelled samples. A long token is a secret if its log-likelihood ratio per character passes a
threshold that lies above nearly all ordinary samples. In name=value the parts are rated by
themselves, and so is what a fixed form leaves of a token.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.llm import workers
from quotewell.llm.common import lowest, whole_text

KINDS = ("assign", "access", "hex", "markov")
# Fixed forms, on UTF-8 bytes with A-Z lower-cased where letters may be in either case.
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]{12,}")
HEX = re.compile(rb"[0-9a-f]{32,}")
TOKEN = re.compile(rb"[A-Za-z0-9+/_=-]{16,}")
# Parts of a token: '=' separates, but for one or two at its end; and words of such a part.
PART = re.compile(rb"[A-Za-z0-9+/_-]+(?:={1,2}(?!.))?", re.DOTALL)
WORD = re.compile(rb"[A-Za-z0-9]+=*")
LEAST_VALUE = 8
LEAST_TOKEN = 20
LEAST_SHORT = 16  # shorter than that is not rated; below LEAST_TOKEN by a threshold of its own

SYMBOLS = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
SIZE = len(SYMBOLS) + 2  # and a symbol for the start, and one for any other byte
_CODE = np.full(256, SIZE - 1, np.int64)
_CODE[list(SYMBOLS)] = np.arange(1, SIZE - 1)

FIT_DOCUMENTS = 4_000
FIT_CHARS = 20_000
FIT_STRINGS = 50_000  # of each kind
FALSE_SHARE = 1e-4
LEAST_RATIO = 0.5  # nats per character
SEED = 23
SPAN = "struct<kind:string,start:int,end:int>"


def base_spans(raw: bytes) -> list[tuple[str, int, int]]:
    """Spans of the fixed forms in bytes: assigned values with their key, access keys, hex runs.

    A match is taken leftmost without overlap and dropped if its value is too short; what it
    covers is not searched again. The runs of the other two forms are maximal, so asking for their
    length in the pattern is the same.
    """
    found = [
        ("assign", m.start(), m.end()) for m in ASSIGN.finditer(raw.lower())
        if m.end(2) - m.start(2) >= LEAST_VALUE
    ]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(raw)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(raw)]
    return found


def values(raw: bytes, spans: list[tuple[str, int, int]]) -> list[bytes]:
    """The secret part of each span."""
    low = raw.lower()
    return [
        raw[slice(*ASSIGN.match(low, start).span(2))] if kind == "assign" else raw[start:end]
        for kind, start, end in spans
    ]


def _codes(token: bytes) -> np.ndarray:
    """Index of (character before the last, last character, character) at each character."""
    code = _CODE[np.frombuffer(token, np.uint8)]
    padded = np.concatenate([[0, 0], code])
    return (padded[:-2] * SIZE + padded[1:-1]) * SIZE + code


def markov(samples: list[bytes]) -> np.ndarray:
    """Log probabilities of a character after two, backing off to one before and to none."""
    counts = np.zeros(SIZE**3)
    for sample in samples:
        np.add.at(counts, _codes(sample), 1)
    counts = counts.reshape(SIZE, SIZE, SIZE)
    single = counts.sum((0, 1)) + 0.5
    single /= single.sum()
    pair = counts.sum(0) + 8 * single
    pair /= pair.sum(1, keepdims=True)
    triple = counts + 8 * pair
    return np.log(triple / triple.sum(2, keepdims=True)).ravel()


@dataclass(frozen=True)
class Detector:
    ratio: np.ndarray  # log likelihood as a random string less that as an identifier
    threshold: float  # per character
    short: float  # the same for tokens below LEAST_TOKEN

    def strength(self, token: bytes) -> float:
        return float(self.ratio[_codes(token)].mean())

    def is_secret(self, token: bytes) -> bool:
        if len(token) < LEAST_SHORT or (len(token) < LEAST_TOKEN and token.isdigit()):
            return False  # a plain number of 16 to 19 digits is no random string
        bound = self.threshold if len(token) >= LEAST_TOKEN else self.short
        return self.strength(token) >= bound

    def secrets(self, token: bytes) -> list[tuple[int, int]]:
        """Spans of the parts of ``token`` that are secrets, or of words of them; if there are
        none, of the whole token if it is one."""
        found = []
        for part in PART.finditer(token):
            if self.is_secret(part.group()):
                found.append(part.span())
            else:
                found += [(part.start() + w.start(), part.start() + w.end())
                          for w in WORD.finditer(part.group()) if self.is_secret(w.group())]
        return found or ([(0, len(token))] if self.is_secret(token) else [])


def train(random_strings: list[bytes], identifiers: list[bytes]) -> Detector | None:
    """None unless there are samples of both kinds."""
    if not random_strings or not identifiers:
        return None
    ratio = markov(random_strings) - markov(identifiers)
    plain = Detector(ratio, 0.0, 0.0)

    def bound(tokens: list[bytes]) -> float:
        rated = [plain.strength(token) for token in tokens]
        return max(LEAST_RATIO, float(np.quantile(rated, 1 - FALSE_SHARE)) if rated else 0.0)

    return Detector(ratio, bound([t for t in identifiers if len(t) >= LEAST_TOKEN]),
                    bound([t for t in identifiers if LEAST_SHORT <= len(t) < LEAST_TOKEN]))


def labelled_strings(texts: Iterator[str]) -> tuple[list[bytes], list[bytes]]:
    """Random strings and identifiers of texts, labelled by the fixed forms.

    Values of fixed forms that mix letters and digits are random. Words of letters alone, joined
    by at most one sign, that touch no such span are identifiers.
    """
    rng = np.random.default_rng(SEED)
    positive: list[bytes] = []
    negative: set[bytes] = set()
    word = re.compile(rb"[A-Za-z]+(?:[_/-][A-Za-z]+)*")
    for text in texts:
        raw = text.encode("utf-8", "replace")
        spans = base_spans(raw)
        for value in values(raw, spans):
            if re.search(rb"[0-9]", value) and re.search(rb"[A-Za-z]", value):
                positive.append(value)
        covered = np.zeros(len(raw) + 1, bool)
        for _, start, end in spans:
            covered[start:end] = True
        for m in word.finditer(raw):
            if m.end() - m.start() >= 6 and not covered[m.start()] and not covered[m.end() - 1]:
                negative.add(m.group())
    ordered = sorted(negative)
    kept = [ordered[i] for i in sorted(rng.permutation(len(ordered))[:FIT_STRINGS])]
    # Several words in a row are what a long ordinary identifier looks like.
    joined = [b"".join(kept[i:i + 4]) for i in range(0, len(kept) - 3, 4)]
    snake = [b"_".join(kept[i:i + 3]) for i in range(0, len(kept) - 2, 3)]
    return sorted(positive)[:FIT_STRINGS], [*kept, *joined, *snake]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Detector | None:
    """Train from at most ``FIT_DOCUMENTS`` documents of at most ``FIT_CHARS`` characters.

    The sample follows a hash of id and text, with one place for each different text; half of it
    is taken among documents that look like holding a fixed form, so that both kinds occur.
    """
    text = whole_text(text_col)
    texts = docs.select(F.xxhash64(F.col(id_col).cast("string"), text).alias("at"),
                        text.alias("text")).where(F.char_length("text") <= FIT_CHARS)
    likely = F.col("text").rlike(r"(?i)(password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{32}")
    half = FIT_DOCUMENTS // 2
    totals = texts.agg(F.count_if(likely).alias("likely"), F.count("*").alias("all")).first()
    chosen = [
        *lowest(texts, "at", "text", half, totals.likely, likely)["text"],
        *lowest(texts, "at", "text", half, totals.all - totals.likely, ~likely)["text"],
    ]
    return train(*labelled_strings(text.as_py() for text in chosen))


def find(text: str, detector: Detector | None) -> list[tuple[str, int, int]]:
    """All spans in code points, by start, then kind; end exclusive.

    Fixed forms first; then the secrets in each long token, or in what they leave of it.
    """
    raw = text.encode("utf-8", "replace")
    found = base_spans(raw)
    if detector is not None:
        taken = sorted((start, end) for _, start, end in found)
        starts = [start for start, _ in taken]
        reach = list(accumulate((end for _, end in taken), max))
        for m in TOKEN.finditer(raw):
            start, end = m.span()
            # Spans that end after the token starts and start before it ends.
            for low, high in [*taken[bisect_right(reach, start):bisect_left(starts, end)],
                              (end, end)]:
                found += [("markov", start + a, start + b)
                          for a, b in detector.secrets(raw[start:low])]
                start = max(start, high)
    if found and len(raw) != len(text):
        begins = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
        before = np.concatenate([[0], begins])
        found = [(kind, int(before[start]), int(before[end])) for kind, start, end in found]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(
    docs: DataFrame, detector: Detector | None, text_col: str = "text", spans_col: str = "spans"
) -> DataFrame:
    """All columns of ``docs`` with ``spans`` added or replaced: array of (kind, start, end).

    Null and empty texts have no spans. Whole texts are searched; repeated rows give the same
    spans. Without a detector only the fixed forms are found.
    """
    sent = docs.sparkSession.sparkContext.broadcast(detector)

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        workers.enter("secrets")
        for texts in batches:
            yield pa.array([
                [{"kind": k, "start": s, "end": e} for k, s, e in find(text.as_py(), sent.value)]
                for text in texts
            ], kind)
        workers.trim()

    return docs.withColumn(spans_col, F.arrow_udf(run, f"array<{SPAN}>")(whole_text(text_col)))


def redacted(text: str, spans: list[dict]) -> str:
    """The text with each span, in order of starts, replaced by its kind in brackets."""
    out, at = [], 0
    for span in spans:
        if span["start"] >= at:
            out += [text[at:span["start"]], f"[{span['kind']}]"]
        at = max(at, span["end"])
    return "".join([*out, text[at:]])


def redact(text: Column, spans: Column) -> Column:
    """The text with each span of secrets replaced by ``[kind]``; overlapping spans become one.

    A null text stays null, and a text without spans stays as it is.
    """
    def run(texts: pa.Array, found: pa.Array) -> pa.Array:
        workers.enter("secrets")
        made = pa.array(
            [redacted(text.as_py(), spans.as_py())
             if text.is_valid and spans.is_valid and len(spans) else text.as_py()
             for text, spans in zip(texts, found, strict=True)], pa.string())
        workers.trim()
        return made

    return F.arrow_udf(run, "string")(text, spans)


def clean(
    docs: DataFrame, detector: Detector | None, text_col: str = "text", clean_col: str = "clean"
) -> DataFrame:
    """All columns of ``docs`` with the redacted text added or replaced, null without a secret.

    The same as ``redact`` after ``scan``, found and replaced at once: a task needs one Python
    worker instead of two, and only texts that hold a secret are sent back.
    """
    sent = docs.sparkSession.sparkContext.broadcast(detector)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        workers.enter("secrets")
        for texts in batches:
            made: list[str | None] = []
            for text in texts:
                whole = text.as_py()
                spans = [{"start": s, "end": e, "kind": k}
                         for k, s, e in find(whole, sent.value)]
                made.append(redacted(whole, spans) if spans else None)
            yield pa.array(made, pa.string())
        workers.trim()

    return docs.withColumn(clean_col, F.arrow_udf(run, "string")(whole_text(text_col)))


def span_text(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                     s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
