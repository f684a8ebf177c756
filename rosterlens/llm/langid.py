"""Language identification with bit-sliced Bloom filters of n-grams.

One array of bit masks holds a Bloom filter for every language at once: bit ``l`` of each slot belongs to language
``l`` (beyond 64 languages a slot has several words), and the AND of the slots of an n-gram's hashes names all languages
that contain it. The counts of each language, corrected for its filter's false-positive rate, decide. N-grams are bytes
of the lower-cased text in which every ASCII character other than a letter is a space.

The filters are learned from a bounded sample: ``SAMPLE_PER_LANGUAGE`` documents of each language, picked by a hash of
their ids, out of those with crc32(doc_id) mod 3 other than 1. Rows that repeat an id in a language are one document, of
which one text is learned.

Defined results: null texts and texts without letters are ``und`` with score 0, as is every text when nothing could be
learned; a null doc_id counts as not held out and is never learned from; ties go to the first language by name; rows
that repeat are judged each; texts of any length are judged and learned whole, in some fifty bytes of memory for each of
their bytes; extra columns are carried by ``filter_language`` and play no part; without documents there are no rows.

The driver holds one filter for each language (``2 ** SLOTS_LOG2`` bits), and every worker all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, mix64, sample_order, slices, text_bytes

SAMPLE_PER_LANGUAGE = 400
#: Sizes of n-grams in bytes; at most eight.
GRAMS = (4, 6)
HASHES = 2
SLOTS_LOG2 = 20
#: A stage that filters by language keeps documents whose best language reaches this score.
KEEP_AT = 0.2
UNKNOWN = "und"

_TO_SPACE = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def _grams(column: pa.Array):
    """For each n-gram size: the n-grams of all texts as integers, and where each text's part begins (rows + 1)."""
    lowered = pa.array([x.lower() if x else "" for x in column.to_pylist()], pa.large_string())
    data, offsets = text_bytes(lowered)
    data = np.frombuffer(data.tobytes().translate(_TO_SPACE), np.uint8)
    for size in GRAMS:
        n = len(data) - size + 1
        if n < 1:
            yield np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
            continue
        grams = np.zeros(n, np.uint64)
        spaces = np.zeros(n, np.uint8)
        for i in range(size):
            part = data[i : n + i]
            grams = (grams << np.uint64(8)) | part
            spaces += part == 32
        inside = spaces < 2
        for back in range(1, size):
            cut = offsets[1:-1] - back
            inside[cut[(cut >= 0) & (cut < n)]] = False
        at = np.flatnonzero(inside)
        yield grams[at], np.searchsorted(at, offsets)


def _slots(grams: np.ndarray, size: int):
    mixed = mix64(grams + np.uint64(size << 56))
    for i in range(HASHES):
        yield ((mixed >> np.uint64(i * SLOTS_LOG2)) & np.uint64((1 << SLOTS_LOG2) - 1)).astype(np.int64)


@dataclass(frozen=True)
class Filters:
    languages: tuple[str, ...]
    masks: np.ndarray  # 1 << SLOTS_LOG2 bit masks of one or more words
    false_rate: np.ndarray  # of each language

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        n = len(column)
        counts, total = np.zeros((len(self.languages), n)), np.zeros(n)
        for size, (grams, parts) in zip(GRAMS, _grams(column), strict=True):
            slots, kind = list(_slots(grams, size)), self.masks.dtype.type
            bits = self.masks.dtype.itemsize * 8
            for i in range(len(self.languages)):
                if i % bits == 0:
                    word = self.masks[:, i // bits]
                    found = np.bitwise_and.reduce([word[at] for at in slots])
                hits = np.concatenate(([0], np.cumsum((found >> kind(i % bits)) & kind(1), dtype=np.int64)))
                counts[i] += np.diff(hits[parts])
            total += np.diff(parts)
        rate = self.false_rate[:, None]
        true = (counts - total * rate) / (1 - rate)
        best = true.argmax(axis=0)
        score = np.clip(true.max(axis=0) / np.maximum(total, 1), 0.0, 1.0)
        known = np.array([has_letter(x) for x in column.to_pylist()], bool)
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        return names, np.where(known, score, 0.0)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def build(grams: dict[str, list[np.ndarray]]) -> Filters | None:
    """Filters from each language's n-grams, one array per size."""
    return combine({language: _filter(own) for language, own in grams.items()})


def _filter(grams: list[np.ndarray]) -> np.ndarray:
    """One language's filter, packed to a bit per slot."""
    own = np.zeros(1 << SLOTS_LOG2, bool)
    for size, values in zip(GRAMS, grams, strict=True):
        for at in _slots(values, size):
            own[at] = True
    return np.packbits(own)


def combine(packed: dict[str, np.ndarray]) -> Filters | None:
    """One array of masks from each language's packed filter."""
    languages = tuple(sorted(packed))
    if not languages:
        return None
    kind = next((t for t in (np.uint8, np.uint16, np.uint32) if np.iinfo(t).bits >= len(languages)), np.uint64)
    bits = np.iinfo(kind).bits
    masks = np.zeros((1 << SLOTS_LOG2, -(-len(languages) // bits)), kind)
    fill = np.zeros(len(languages))
    for i, language in enumerate(languages):
        own = np.unpackbits(packed[language])
        masks[:, i // bits] |= own.astype(kind) << kind(i % bits)
        fill[i] = own.mean()
    return Filters(languages, masks, np.minimum(fill**HASHES, 0.99))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def train(documents: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Filters | None:
    """Learn from at most ``per_language`` documents of each language."""
    usable = documents.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    ids = usable.select("lang", "doc_id").distinct()  # repeated rows count once
    sizes = ids.groupBy("lang").agg(F.count("*").alias("_count"))
    place = F.shiftrightunsigned(sample_order("doc_id"), 1)
    # the ids that hash lowest: a bound that some four times as many meet keeps the others out of the window
    bound = F.least(F.lit(1.0), F.lit(4.0 * per_language) / F.col("_count")) * float(1 << 63)
    picked = (
        ids.join(F.broadcast(sizes), "lang")  # a row per language, each of which has a filter on the driver
        .where(place <= bound)
        .withColumn("_n", F.row_number().over(Window.partitionBy("lang").orderBy(place, "doc_id")))
        .where(F.col("_n") <= per_language)
        .select("lang", "doc_id")
    )
    picked = materialize(picked, "language-sample")  # so that its size is known and decides how it is joined
    texts = (
        usable.select("doc_id", "lang", "text")
        .join(picked, ["lang", "doc_id"], "left_semi")
        .groupBy("lang", "doc_id")
        .agg(F.min_by("text", F.struct(sample_order("text"), "text")).alias("text"))
        .select("lang", "text")
    )

    def rows(batches):
        own: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            names, of_row = np.unique(np.array(batch.column("lang").to_pylist(), object), return_inverse=True)
            learned = []
            for grams, parts in _grams(batch.column("text")):
                of = np.repeat(of_row, np.diff(parts))
                order = np.argsort(of, kind="stable")
                learned.append(np.split(grams[order], np.searchsorted(of[order], np.arange(1, len(names)))))
            for name, *grams in zip(names, *learned, strict=True):
                packed = _filter(grams)
                own[name] = own[name] | packed if name in own else packed
        for name, packed in own.items():
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([packed.tobytes()], pa.binary())], ["lang", "filter"])

    def merge(parts: pa.Table) -> pa.Table:
        packed = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in parts.column("filter").to_pylist()])
        return pa.table({"lang": parts.column("lang")[:1], "filter": pa.array([packed.tobytes()], pa.binary())})

    kind = "lang string, filter binary"
    merged = texts.mapInArrow(rows, kind).groupBy("lang").applyInArrow(merge, kind)
    return combine({row.lang: np.frombuffer(row.filter, np.uint8) for row in merged.toLocalIterator()})


def _predict(filters: Filters | None, column: pa.Array) -> tuple[list[str], np.ndarray]:
    return filters.predict(column) if filters else ([UNKNOWN] * len(column), np.zeros(len(column)))


def identify(documents: DataFrame, filters: Filters | None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""

    def rows(batches):
        for batch in slices(batches):
            names, score = _predict(filters, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    return documents.select("doc_id", "text", held_out().alias("held_out")).mapInArrow(rows, "doc_id long, held_out boolean, lang_pred string, score double")


def filter_language(documents: DataFrame, filters: Filters | None, keep_at: float = KEEP_AT) -> DataFrame:
    """The rows whose language is known with a score of ``keep_at`` or more, with all their columns."""

    def rows(batches):
        for batch in slices(batches):
            names, score = _predict(filters, batch.column("text"))
            yield batch.filter(pa.array([n != UNKNOWN and s >= keep_at for n, s in zip(names, score, strict=True)], pa.bool_()))

    return documents.mapInArrow(rows, documents.schema)
