"""Quality rules: word statistics, then a calibrated n-gram classifier.

Words are maximal runs of characters other than space and U+0009 to U+000D. Statistics cover whole texts. The
classifier is a logistic regression on hashed relative frequencies of words, word pairs and character n-grams. It is fitted
to a bounded sample of labelled rows (``SAMPLE_ROWS``), calibrated on a held-out fold of it, and scores Arrow batches.
A linear model over relative frequencies is a mean of bucket weights, so scoring is one table lookup per n-gram.

Defined results: a null or empty text has no words and so fails the base rules; rows that repeat are judged each;
without labels of both classes the base rules decide alone; extra columns are carried by ``filter_quality`` and play no
part; a text of any length is judged whole, in one task and some fifty bytes of memory for each of its bytes; without
documents there are no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, sample_order, slices, text_bytes

#: At most so many labelled rows are used to fit and calibrate the classifier.
SAMPLE_ROWS = 2000
#: Buckets of each family of n-grams.
BUCKETS = 4096
CHAR_GRAMS = (3, 5)
#: A document is kept if its calibrated probability of good quality is at least this.
KEEP_AT = 0.35
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

STATS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"


def _flags(values: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


_SPACE, _SYMBOL = _flags(b" \t\n\v\f\r"), _flags(SYMBOLS)


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))[offsets])


def repeat_words(words: list[bytes]) -> int:
    """How many words lie in a three-word window that occurs at least twice."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen, covered, end = Counter(windows), 0, 0
    for i, window in enumerate(windows):
        if seen[window] > 1:
            covered += i + 3 - max(end, i)
            end = i + 3
    return covered


def base_stats(column: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = text_bytes(column)
    space = _SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begins[heads] = ~space[heads]
    dup, repeat = np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1, np.int64)
    raw = data.tobytes()
    for i in range(len(dup)):
        text = raw[offsets[i] : offsets[i + 1]]
        lines = [x for x in text.split(b"\n") if x.strip()]
        dup[i] = len(lines) - len(set(lines))
        repeat[i] = repeat_words(text.split())
    n_words = _per_text(begins, offsets)
    return {
        "n_words": n_words,
        "word_chars": _per_text(~space & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_text(_SYMBOL[data], offsets),
        "n_dup_lines": dup,
        "n_repeat_words": repeat,
        "base_failed": (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n_words),
    }


_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _bucket(x: np.ndarray) -> np.ndarray:
    return (mix64(x) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)


def families(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each family of n-grams: the buckets of all n-grams of all texts, and where each text's part begins (rows + 1)."""
    data, offsets = text_bytes(column)
    n = len(data)
    space = _SPACE[data]
    begins, ends = ~space, ~space
    begins[1:] &= space[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begins[heads] = ~space[heads]
    starts = np.flatnonzero(begins)
    ends = np.zeros(n + 1, bool)
    ends[1:] = ~space
    ends[1:n] &= space[1:] | np.isin(np.arange(1, n), heads, assume_unique=True) if n > 1 else True
    stops = np.flatnonzero(ends)
    powers = np.full(max(n, 1), _ODD, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    inverse = np.full(max(n, 1), _INVERSE, np.uint64)
    inverse[0] = 1
    inverse = np.cumprod(inverse, dtype=np.uint64)
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], dtype=np.uint64)))
    words = (prefix[stops] - prefix[starts]) * inverse[starts] if len(starts) else np.zeros(0, np.uint64)
    parts = np.searchsorted(starts, offsets)
    yield _bucket(words), parts
    pairs = words[:-1] * np.uint64(31) + mix64(words[1:])
    inside = np.ones(len(pairs), bool)
    last = parts[1:-1] - 1
    inside[last[(last >= 0) & (last < len(pairs))]] = False
    yield _bucket(pairs[inside]), np.searchsorted(np.flatnonzero(inside), parts)
    chars = np.append(np.flatnonzero((data & 0xC0) != 0x80), n)  # where each code point begins
    bounds, m = np.searchsorted(chars, offsets), len(chars) - 1
    for size in CHAR_GRAMS:
        grams = (prefix[chars[size:]] - prefix[chars[:-size]]) * inverse[chars[: m - size + 1]] if m >= size else np.zeros(0, np.uint64)
        inside = np.ones(len(grams), bool)
        for back in range(1, size):
            cut = bounds[1:-1] - back
            inside[cut[(cut >= 0) & (cut < len(grams))]] = False
        yield _bucket(grams[inside]), np.searchsorted(np.flatnonzero(inside), bounds)


N_FAMILIES = 2 + len(CHAR_GRAMS)


def features(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sparse relative frequencies of each text: indices and values."""
    rows: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(len(column))]
    for family, (buckets, parts) in enumerate(families(column)):
        for i, row in enumerate(rows):
            if parts[i + 1] > parts[i]:
                at, counts = np.unique(buckets[parts[i] : parts[i + 1]], return_counts=True)
                row.append((at + family * BUCKETS, counts / (parts[i + 1] - parts[i])))
    empty = (np.zeros(0, np.int32), np.zeros(0))
    return [(np.concatenate([x for x, _ in r]), np.concatenate([v for _, v in r])) if r else empty for r in rows]


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.shift, -50, 50)))

    def score(self, column: pa.Array) -> np.ndarray:
        logits = np.full(len(column), self.bias)
        for family, (buckets, parts) in enumerate(families(column)):
            own = np.concatenate(([0.0], np.cumsum(self.weights[family * BUCKETS : (family + 1) * BUCKETS][buckets])))
            logits += np.diff(own[parts]) / np.maximum(np.diff(parts), 1)
        return self.probability(logits)


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int) -> tuple[np.ndarray, float]:
    """Accelerated gradient descent on the mean log loss with an L2 penalty."""
    w = v = np.zeros(x.shape[1], x.dtype)
    b = c = 0.0
    top = np.ones(x.shape[1], x.dtype)
    for _ in range(12):  # the largest eigenvalue bounds the step
        top = x.T @ (x @ top)
        norm = float(np.linalg.norm(top))
        if not norm:
            break
        top = top / norm
    step = 1 / (0.25 * (float(np.linalg.norm(x @ top) ** 2) / len(y) + 1) * 1.1 + penalty)
    for k in range(rounds):
        gap = 1 / (1 + np.exp(-np.clip(x @ v + c, -50, 50))) - y
        w_next, b_next = v - step * (x.T @ gap / len(y) + penalty * v), c - step * float(gap.mean())
        v, c = w_next + k / (k + 3) * (w_next - w), b_next + k / (k + 3) * (b_next - b)
        w, b = w_next, b_next
    return w, b


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Model | None:
    """None unless both classes have at least four rows. Every fourth row calibrates; the others fit the weights."""
    y = labels.astype(np.float32)
    if min(y.sum(), len(y) - y.sum()) < 4:
        return None
    held = np.arange(len(y)) % 4 == 3
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held[:] = False
    order = np.argsort(held, kind="stable")  # the fold that calibrates comes last, so that folds are views
    n_fit, y = int((~held).sum()), y[order]
    x = np.zeros((len(rows), N_FAMILIES * BUCKETS), np.float32)
    for i, k in enumerate(order):
        x[i, rows[k][0]] = rows[k][1]
    scale = np.concatenate([part.std(axis=0) for part in np.split(x, N_FAMILIES * 4, axis=1)]) + np.float32(1e-4)
    scale *= np.float32(np.sqrt(N_FAMILIES * BUCKETS))
    x /= scale
    w, b = _logistic(x[:n_fit], y[:n_fit], 1e-4, 300)
    own = slice(n_fit, None) if n_fit < len(y) else slice(None)
    logits = x[own] @ w + b
    n_good = y[own].sum()
    soft = np.where(y[own] == 1, (n_good + 1) / (n_good + 2), 1 / (len(y[own]) - n_good + 2))  # as Platt smooths targets
    spread = float(logits.std()) or 1.0
    slope, shift = _logistic((logits / spread)[:, None].astype(np.float64), soft, 1e-6, 300)
    return Model((w / scale).astype(np.float64), b, float(slope[0]) / spread, shift)


def train(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit the classifier to at most ``sample_rows`` labelled documents, picked by a hash of their ids.

    Rows that repeat an id are one document, of which one text is learned.
    """
    picked = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("_quality"))
        .orderBy(sample_order("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    texts = (
        documents.select("doc_id", "text")
        .where("text is not null")
        .join(F.broadcast(picked), "doc_id")  # sample_rows rows at most
        .groupBy("doc_id", "_quality")
        .agg(F.min_by("text", F.struct(sample_order("text"), "text")).alias("text"))
        .orderBy(sample_order("doc_id", "text"))
        .limit(sample_rows)
    )

    def rows(batches):
        for batch in slices(batches):
            found = features(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_quality").cast(pa.int32()),
                    pa.array([at.astype(np.uint16).tobytes() for at, _ in found], pa.binary()),
                    pa.array([v.astype(np.float16).tobytes() for _, v in found], pa.binary()),
                ],
                ["quality", "at", "value"],
            )

    got = texts.mapInArrow(rows, "quality int, at binary, value binary").toArrow()
    pairs = [(np.frombuffer(a, np.uint16), np.frombuffer(v, np.float16)) for a, v in zip(got["at"].to_pylist(), got["value"].to_pylist(), strict=True)]
    return fit(pairs, (np.array(got["quality"].to_pylist(), np.int64) > 0).astype(np.int64))


def _kept(stats: dict[str, np.ndarray], column: pa.Array, model: Model | None) -> np.ndarray:
    return ~stats["base_failed"] & ((model.score(column) >= KEEP_AT) if model else True)


def judge(documents: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: the statistics, ``base_failed`` and the verdict ``kept``."""

    def rows(batches):
        for batch in slices(batches):
            text = batch.column("text")
            stats = base_stats(text)
            stats["kept"] = _kept(stats, text, model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *map(pa.array, stats.values())], ["doc_id", *stats])

    return documents.select("doc_id", "text").mapInArrow(rows, STATS + ", kept boolean")


def filter_quality(documents: DataFrame, model: Model | None) -> DataFrame:
    """The rows that are kept, with all their columns; one pass, no shuffle."""

    def rows(batches):
        for batch in slices(batches):
            text = batch.column("text")
            yield batch.filter(pa.array(_kept(base_stats(text), text, model)))

    return documents.mapInArrow(rows, documents.schema)
