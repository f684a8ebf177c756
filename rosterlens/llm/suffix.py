"""Removal of repeated byte strings by bounded interval expansion on Burrows-Wheeler transforms.

A byte goes if a string of ``length`` bytes that covers it also starts earlier, in a smaller doc_id or earlier in the
same document. Strings never cross documents and are judged on the input.

Every string of ``length`` bytes belongs to its anchor, the leftmost of its ``GRAM``-byte grams with the least hash, so
equal strings have equal anchors. Strings that follow each other share an anchor; together they make a segment.

1. Each task finds its texts' segments. Anchors meet by their hashes; one that occurs once repeats nothing. Hashes only
   bring together what may be equal: what is equal is decided on bytes.
2. The segments of all other anchors are fetched, each as its bytes and its place. Equal ones are one text with several
   places, of which the earliest counts; a task sends a text once, and later places of it without the bytes.
3. The texts of an anchor meet in one task. Over a share of texts a Burrows-Wheeler transform is built; breadth-first
   backward extension of its intervals finds common prefixes by increasing length and stops at ``length``. The suffixes
   that no boundary below that length parts are equal strings, and repeat the earliest place of them; so do all later
   places of one text. (The strings of one text differ from each other, as an anchor is the leftmost of its strings.)
4. Each document's repeated strings make its removed spans.

An anchor with more than ``KEY_BYTES`` of different texts (a common phrase) is dealt again: its strings are cut in halves
by how far before the anchor they start. All strings of a half share some bytes beside the anchor, which become part of
its key. Halves that are still too large are cut again, at last to single strings, of which a key has one.

What crosses the network is a few bytes an anchor (one for about ``(length - GRAM + 2) / 2`` bytes of text), the texts of
anchors that repeat (some ``2 * length`` bytes a segment, less what a task holds twice), and the documents themselves twice.

Defined results: a null text is empty; a null doc_id comes before all others; documents that share a doc_id are ordered
by a hash of their texts; rows that repeat both are one document and all get its result; texts below ``length`` bytes
lose nothing; texts beyond ``WINDOW`` bytes are read in overlapping windows, so a task's arrays stay small beside the
text itself; extra columns are carried by ``remove_repeats``, also where they are named as columns used here; without
documents there are no rows.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import fresh, materialize, mix64, slices, text_bytes

LENGTH = 100
GRAM = 24
#: Buckets for each shuffle partition.
BUCKETS_PER_PARTITION = 4
#: Segments that a task holds before it sends them on, and texts.
HELD, HELD_TEXTS = 400_000, 100_000
#: Bytes of a text that are searched for anchors at a time.
WINDOW = 1 << 22
#: Places between the stored ranks of a transform, and intervals extended at a time.
SAMPLED, WIDE = 16, 16384
#: Bytes of text that one Burrows-Wheeler transform takes at a time (an anchor's texts stay together).
TRANSFORM_BYTES = 1 << 16
#: Bytes of different texts beyond which an anchor is dealt again.
KEY_BYTES = 1 << 19

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_SEGMENT = np.dtype([("anchor", "<u8"), ("doc", "<i8"), ("twin", "<i8"), ("at", "<i4"), ("n", "<i2"), ("off", "<i2")])


class _Hasher:
    """Hashes of any substrings of a text, from the prefix sums of a polynomial modulo 2**64."""

    def __init__(self):
        self.powers = self.inverse = np.ones(1, np.uint64)

    def read(self, data: np.ndarray) -> None:
        n = len(data) + 1
        if n > len(self.powers):
            for name, base in (("powers", _ODD), ("inverse", _INVERSE)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        self.prefix = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: n - 1], dtype=np.uint64, out=self.prefix[1:])

    def of(self, start: np.ndarray | slice, stop: np.ndarray | slice) -> np.ndarray:
        return (self.prefix[stop] - self.prefix[start]) * self.inverse[start]


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the index of its least value, the leftmost of equal ones."""
    n = len(values) - width + 1
    at, reach = np.arange(len(values)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        reach += step
    return at[:n]


def segments(data: np.ndarray, offsets: np.ndarray, hasher: _Hasher, length: int) -> tuple[np.ndarray, ...]:
    """Of all texts: anchor hash, text's number, first string's place in the text, strings, bytes from there to the anchor."""
    width = length - GRAM + 1
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty.astype(np.uint64), empty, empty, empty, empty
    hasher.read(data)
    grams = mix64(hasher.of(slice(0, len(data) - GRAM + 1), slice(GRAM, None)))
    anchors = _leftmost_least(grams, width)
    text = np.searchsorted(offsets, np.arange(len(anchors)), side="right") - 1
    inside = np.flatnonzero(np.arange(len(anchors)) + length <= offsets[text + 1])
    if not len(inside):
        return empty.astype(np.uint64), empty, empty, empty, empty
    own, of = anchors[inside], text[inside]
    new = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (of[1:] != of[:-1]))))
    first, count = inside[new], np.diff(np.append(new, len(own)))
    return grams[own[new]], of[new], first - offsets[of[new]], count, own[new] - first


def windows(data: np.ndarray, offsets: np.ndarray, length: int):
    """The texts of a slice, and the places where their parts begin: one long text in parts that share ``length - 1`` bytes."""
    if len(offsets) > 2 or len(data) <= WINDOW + length:
        yield data, offsets, 0
        return
    for start in range(0, len(data) - length + 1, WINDOW):
        part = data[start : start + WINDOW + length - 1]
        yield part, np.array([0, len(part)]), start


_NO_DOC = np.iinfo(np.int64).min
_SPANS = "doc long, twin long, at int, n int, off int"


def _spans(rows: np.ndarray) -> pa.RecordBatch:
    kinds = (("doc", pa.int64()), ("twin", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("off", pa.int32()))
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[c]).astype(t.to_pandas_dtype())) for c, t in kinds], [c for c, _ in kinds])


def _meet(keyed: DataFrame, length: int) -> DataFrame:
    """The segments whose anchor occurs more than once."""
    spark = keyed.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = partitions * BUCKETS_PER_PARTITION
    alone, met, anchor_only = 0, 1, 2

    def send(batches):
        hasher = _Hasher()
        held: list[np.ndarray] = []

        def flush():
            found = np.concatenate(held)
            held.clear()
            if not len(found):
                return
            found = found[np.argsort(found["anchor"], kind="stable")]
            new = np.flatnonzero(np.concatenate(([True], found["anchor"][1:] != found["anchor"][:-1])))
            several = np.repeat(np.diff(np.append(new, len(found))) > 1, np.diff(np.append(new, len(found))))
            heads = found[new[several[new]]]
            for kind, rows in ((alone, found[~several]), (met, found[several]), (anchor_only, heads)):
                bucket = (rows["anchor"] % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                rows, bucket = rows[order], bucket[order]
                cuts = np.append(np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), len(bucket)) if len(bucket) else [0]
                data = rows["anchor"] if kind == anchor_only else rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(bucket[i]) for i in cuts[:-1]], pa.int32()), pa.array([kind] * (len(cuts) - 1), pa.int32()), pa.array([data[i:j].tobytes() for i, j in zip(cuts, cuts[1:], strict=False)], pa.binary())],
                    ["bucket", "kind", "rows"],
                )

        for batch in slices(batches):
            docs, twins = batch.column("doc").to_numpy(), batch.column("twin").to_numpy()
            for data, offsets, start in windows(*text_bytes(batch.column("text")), length):
                anchor, of, at, n, off = segments(data, offsets, hasher, length)
                rows = np.empty(len(anchor), _SEGMENT)
                for name, values in (("anchor", anchor), ("doc", docs[of]), ("twin", twins[of]), ("at", at + start), ("n", n), ("off", off)):
                    rows[name] = values
                held.append(rows)
                if sum(map(len, held)) >= HELD:
                    yield from flush()
        if held:
            yield from flush()

    def settle(batches):
        bucket = None
        single: list[np.ndarray] = []
        known: list[np.ndarray] = []

        def close():
            rows = np.concatenate(single) if single else np.empty(0, _SEGMENT)
            rows = rows[np.argsort(rows["anchor"], kind="stable")]
            if len(rows):
                new = np.concatenate(([True], rows["anchor"][1:] != rows["anchor"][:-1]))
                size = np.diff(np.append(np.flatnonzero(new), len(rows)))[np.cumsum(new) - 1]
                elsewhere = np.isin(rows["anchor"], np.concatenate(known)) if known else False
                yield _spans(rows[(size > 1) | elsewhere])
            single.clear()
            known.clear()

        for batch in batches:
            for b, kind, rows in zip(batch.column("bucket").to_pylist(), batch.column("kind").to_pylist(), batch.column("rows"), strict=True):
                if b != bucket:
                    yield from close()
                    bucket = b
                if kind == met:
                    yield _spans(np.frombuffer(rows.as_buffer(), _SEGMENT))
                elif kind == alone:
                    single.append(np.frombuffer(rows.as_buffer(), _SEGMENT).copy())
                else:
                    known.append(np.frombuffer(rows.as_buffer(), "<u8").copy())
        yield from close()

    sent = keyed.mapInArrow(send, "bucket int, kind int, rows binary").repartition(partitions, "bucket").sortWithinPartitions("bucket")
    return sent.mapInArrow(settle, _SPANS)


def bounded_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Rotations of ``text`` (symbols below 512) by at least their first ``depth`` symbols, by prefix tripling."""
    n = len(text)
    key = np.zeros(n, np.int64)
    for i in range(7):
        key = (key << 9) | np.roll(text, -i)
    reach = 7
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([False], ordered[1:] != ordered[:-1])))
        if reach >= depth:
            return order
        key = rank * n + np.roll(rank, -reach)
        if n < 1 << 21 and 2 * reach < depth:
            key, reach = key * n + np.roll(rank, -2 * reach), 3 * reach
        else:
            reach *= 2


class _Ranks:
    """How often each symbol stands before a place: stored for every SAMPLED-th place, counted from there on."""

    def __init__(self, code: np.ndarray, symbols: int):
        blocks = len(code) // SAMPLED + 1
        self.symbols = symbols
        self.codes = np.zeros(blocks * SAMPLED, np.int32)
        self.codes[: len(code)] = code
        self.codes = self.codes.reshape(blocks, SAMPLED)
        counts = np.bincount(np.arange(len(code)) // SAMPLED * symbols + code, minlength=blocks * symbols).reshape(blocks, symbols)
        self.stored = np.zeros((blocks + 1, symbols), np.int32)
        np.cumsum(counts, axis=0, out=self.stored[1:])

    def at(self, places: np.ndarray) -> np.ndarray:
        """A row for each place, a column for each symbol."""
        block, rest = places // SAMPLED, places % SAMPLED
        own = (np.arange(len(places), dtype=np.int32) * self.symbols)[:, None] + self.codes[block]
        seen = own[np.arange(SAMPLED) < rest[:, None]]
        return self.stored[block] + np.bincount(seen, minlength=len(places) * self.symbols).reshape(len(places), self.symbols)


def long_prefix_groups(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rotations in order, and for each the number of its group: neighbours share a group if they agree in ``length`` symbols.

    The Burrows-Wheeler transform comes from the rotations' order by their first ``length`` symbols, which is all that
    intervals of shorter strings need. Starting from the empty string's interval, every interval is extended to the left
    by each symbol before it; the boundary to the right of a string's interval, if it is new, has its length less one as
    common prefix. Boundaries that are still open at ``length`` part nothing.
    """
    n = len(text)
    order = bounded_order(text, length)
    bwt = text[order - 1]
    symbols, code = np.unique(bwt, return_inverse=True)
    by_symbol = np.argsort(code.astype(np.uint16), kind="stable")
    counts = np.bincount(code, minlength=len(symbols))
    base = np.concatenate(([0], np.cumsum(counts)[:-1]))
    step = np.empty(n, np.int64)  # where the suffix one symbol longer stands
    step[by_symbol] = np.arange(n)
    ranks = _Ranks(code, len(symbols))
    run = np.cumsum(np.concatenate(([False], code[1:] != code[:-1])))
    open_ = np.ones(n + 1, bool)
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for _ in range(length):
        one = run[low] == run[high - 1]  # the same symbol stands before all of the interval: one extension
        lows, highs = [step[low[one]]], [step[low[one]] + (high - low)[one]]
        i, j = low[~one], high[~one]
        for k in range(0, len(i), WIDE):
            x, y = np.split(base + ranks.at(np.concatenate((i[k : k + WIDE], j[k : k + WIDE]))), 2)
            some = y > x
            lows.append(x[some])
            highs.append(y[some])
        low, high = np.concatenate(lows), np.concatenate(highs)
        new = open_[high]
        low, high = low[new], high[new]
        open_[high] = False
        if not len(low):
            break
    parted = ~open_[:n]
    parted[0] = True
    return order, np.cumsum(parted) - 1


def repeated_in(pieces: list[bytes], places: np.ndarray, length: int) -> list[np.ndarray]:
    """For each piece the offsets of strings that also start earlier; places: (doc, twin, at) of each piece."""
    sizes = np.array([len(p) + 1 for p in pieces])
    data = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int64) + 1
    heads = np.cumsum(sizes) - sizes
    data[heads + sizes - 1] = 0
    order, group = long_prefix_groups(data, length)
    piece = np.repeat(np.arange(len(pieces)), sizes)
    offset = np.arange(len(data)) - heads[piece]
    valid = (offset + length <= sizes[piece] - 1)[order]
    order, group = order[valid], group[valid]
    of, off = piece[order], offset[order]
    documents = np.unique(places[["doc", "twin"]], return_inverse=True)[1].astype(np.int64)
    place = (documents[of] << 32) | (places["at"][of] + off)
    by = np.lexsort((place, group))
    first = np.concatenate(([True], group[by][1:] != group[by][:-1]))
    head = by[np.flatnonzero(first)[np.cumsum(first) - 1]]
    later = by[place[by] != place[head]]
    marked = np.zeros(len(data), bool)
    marked[order[later]] = True
    return [np.flatnonzero(marked[heads[i] : heads[i] + sizes[i]]) for i in range(len(pieces))]


#: A text of ``n`` strings that start ``low`` to ``high`` bytes before the anchor, which is ``off`` bytes in; without bytes: a
#: later place of a text that is sent elsewhere. Results have no key.
_PIECES = "key long, low int, high int, off int, doc long, twin long, at int, n int, piece binary"
_PIECE_KINDS = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
_PIECE_NAMES = ["key", "low", "high", "off", "doc", "twin", "at", "n", "piece"]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_PIECE_KINDS)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _PIECE_KINDS, strict=True)], _PIECE_NAMES)


def _key(context: bytes, low: int, high: int) -> int:
    return xxhash.xxh64_intdigest(context, low << 16 | high) - (1 << 63)


def _merged(places: list[tuple]) -> list[tuple]:
    """Later places (doc, twin, at, n) without bytes, with strings that follow each other in one row; keys deal them evenly."""
    doc, twin, at, n = (np.array(c, np.int64) for c in zip(*places, strict=True))
    order = np.lexsort((at, twin, doc))
    doc, twin, at, n = doc[order], twin[order], at[order], n[order]
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (twin[1:] != twin[:-1]) | (at[1:] != at[:-1] + n[:-1])))
    total = np.add.reduceat(n, np.flatnonzero(new))
    key = (mix64((at ^ twin)[new].astype(np.uint64))).view(np.int64)
    return [(k, 0, 0, 0, d, t, a, m, None) for k, d, t, a, m in zip(key.tolist(), doc[new].tolist(), twin[new].tolist(), at[new].tolist(), total.tolist(), strict=True)]


def _halves(row: tuple, length: int) -> list[tuple]:
    """A text's strings in two rows, by how far before the anchor they start; strings that share a key share more bytes."""
    _, low, high, off, doc, twin, at, n, piece = row
    middle, out = (low + high) // 2, []
    for a, b in ((low, middle), (middle + 1, high)):
        first, last = off - min(b, off), off - max(a, off - n + 1)
        if first <= last:
            context = piece[off - a : off + length - b]
            out.append((_key(context, a, b), a, b, off - first, doc, twin, at + first, last - first + 1, piece[first : last + length]))
    return out


def _fetch(keyed: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """The texts of segments, by anchor."""
    high = length - GRAM

    def fetch(batches):
        texts: dict[bytes, tuple] = {}  # the earliest place of each
        later: list[tuple] = []

        def flush():
            out = [(_key(piece[off : off + GRAM], 0, high), 0, high, off, doc, twin, at, len(piece) - length + 1, piece) for piece, (doc, twin, at, off) in texts.items()]
            if later:
                out += _merged(later)
            texts.clear()
            later.clear()
            return _batch(out)

        for batch in slices(batches):
            columns = (batch.column(c).to_pylist() for c in ("doc", "twin", "text"))
            for doc, twin, text, spans in zip(*columns, batch.column("spans"), strict=True):
                raw = text.encode()
                ats, ns, offs = (spans.values.field(c).to_numpy().tolist() for c in ("at", "n", "off"))
                for at, n, off in zip(ats, ns, offs, strict=True):
                    piece = raw[at : at + n + length - 1]
                    own = (doc, twin, at, off)
                    first = texts.setdefault(piece, own)
                    if first != own:
                        if own < first:
                            texts[piece], first, own = own, own, first
                        later.append((*own[:3], n))
                if len(texts) + len(later) // 4 >= HELD_TEXTS:
                    yield flush()
        if texts:
            yield flush()

    by_doc = asked.groupBy("doc", "twin").agg(F.collect_list(F.struct("at", "n", "off")).alias("spans"))
    return keyed.join(by_doc, ["doc", "twin"]).select("doc", "twin", "text", "spans").mapInArrow(fetch, _PIECES)


def _compare(pieces: DataFrame, length: int, key_bytes: int) -> DataFrame:
    """Strings that start earlier in another text of their key (key null), and texts that are to be dealt again."""

    def compare(batches):
        key, size, held_size, again = None, 0, 0, False
        ready: list[tuple] = []  # distinct texts of finished keys
        held: dict[bytes, tuple] = {}  # of this key, the earliest place of each text
        later: list[tuple] = []  # later places of texts
        out: list[tuple] = []

        def settle():
            """Results of the texts at hand: of their earliest places by the transform; later ones repeat them as a whole."""
            got = [(None, 0, 0, 0, *place, None) for place in later]
            later.clear()
            if ready:
                places = np.array([r[4:7] for r in ready], [("doc", "<i8"), ("twin", "<i8"), ("at", "<i8")])
                for row, found in zip(ready, repeated_in([r[8] for r in ready], places, length), strict=True):
                    if len(found):
                        cut = np.flatnonzero(np.concatenate(([True], np.diff(found) > 1)))
                        runs = np.diff(np.append(cut, len(found)))
                        got += ((None, 0, 0, 0, row[4], row[5], row[6] + x, k, None) for x, k in zip(found[cut].tolist(), runs.tolist(), strict=True))
                ready.clear()
            return got

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(9)), strict=True):
                piece = row[8]
                if piece is None:
                    later.append(row[4:8])
                else:
                    if row[0] != key:
                        if len(held) > 1:  # the strings of one text of an anchor differ
                            ready += held.values()
                            size += held_size
                        key, held, held_size, again = row[0], {}, 0, False
                    if again:
                        out += _halves(row, length)
                    else:
                        first = held.setdefault(piece, row)
                        if first is row:
                            held_size += len(piece)
                            if held_size > key_bytes and row[1] < row[2]:
                                for own in held.values():
                                    out += _halves(own, length)
                                held, held_size, again = {}, 0, True
                        elif row[4:7] != first[4:7]:
                            if row[4:7] < first[4:7]:
                                held[piece], first, row = row, row, first
                            later.append(row[4:8])
                if size >= TRANSFORM_BYTES or len(later) >= 20_000:
                    out += settle()
                    size = 0
                if len(out) >= 20_000:
                    yield _batch(out)
                    out = []
        if len(held) > 1:
            ready += held.values()
        yield _batch(out + settle())

    return pieces.repartition("key").sortWithinPartitions("key").mapInArrow(compare, _PIECES)


def _repeated(keyed: DataFrame, length: int, key_bytes: int) -> DataFrame:
    """(doc, twin, at, n): n strings from place at on repeat earlier ones."""
    asked = materialize(_meet(keyed, length), "segments")
    found, pieces = [], _fetch(keyed, asked, length)
    while True:
        out = materialize(_compare(pieces, length, key_bytes), "strings")
        found.append(out.where("key is null").select("doc", "twin", "at", "n"))
        pieces = out.where("key is not null")
        if pieces.isEmpty():
            return reduce(DataFrame.unionByName, found)


def _with_spans(documents: DataFrame, length: int, key_bytes: int) -> tuple[DataFrame, str]:
    """All columns of the documents and an array of (at, n): n strings from place at on repeat earlier ones."""
    text = F.coalesce("text", F.lit(""))
    keyed = documents.select(F.coalesce("doc_id", F.lit(_NO_DOC)).alias("doc"), F.xxhash64(text).alias("twin"), text.alias("text"))
    spans = fresh(documents, "spans")
    found = _repeated(keyed, length, key_bytes).groupBy("doc", "twin").agg(F.collect_list(F.struct("at", "n")).alias(spans))
    doc, twin = fresh(documents, "doc"), fresh(documents, "twin")
    found = found.withColumnsRenamed({"doc": doc, "twin": twin})
    same = (F.coalesce(documents["doc_id"], F.lit(_NO_DOC)) == found[doc]) & (F.xxhash64(F.coalesce(documents["text"], F.lit(""))) == found[twin])
    return documents.join(found, same, "left").drop(doc, twin), spans


def _kept(raw: bytes, spans: pa.Scalar, length: int) -> tuple[bytes, int, int]:
    """Bytes that stay, bytes removed, runs removed."""
    if not spans.is_valid:
        return raw, 0, 0
    at, n = spans.values.field("at").to_numpy().astype(np.int64), spans.values.field("n").to_numpy()
    order = np.argsort(at)
    at, stop = at[order], (at + n - 1 + length)[order]
    reach = np.maximum.accumulate(stop)
    new = np.flatnonzero(np.concatenate(([True], at[1:] > reach[:-1])))
    starts, stops = at[new].tolist(), reach[np.append(new[1:], len(at)) - 1].tolist()
    kept = b"".join(raw[i:j] for i, j in zip([0, *stops], [*starts, len(raw)], strict=True))
    return kept, len(raw) - len(kept), len(starts)


def repeats(documents: DataFrame, length: int = LENGTH, key_bytes: int = KEY_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    joined, spans = _with_spans(documents.select("doc_id", "text"), length, key_bytes)

    def rows(batches):
        for batch in slices(batches):
            raws = [(x or "").encode() for x in batch.column("text").to_pylist()]
            got = [_kept(raw, s, length) for raw, s in zip(raws, batch.column(spans), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array([len(r) for r in raws], pa.int64()), pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.int64()), pa.array([hashlib.sha256(g[0]).hexdigest() for g in got])],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return joined.mapInArrow(rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(documents: DataFrame, length: int = LENGTH, key_bytes: int = KEY_BYTES) -> DataFrame:
    """The documents without their repeated bytes; n_chars, where there is one, follows.

    A character that loses some of its bytes goes altogether. A text that is null, or loses nothing, stays as it is.
    """
    joined, spans = _with_spans(documents, length, key_bytes)
    columns = documents.columns
    has_count = "n_chars" in columns

    def rows(batches):
        for batch in slices(batches):
            column = batch.column("text")
            texts = [x if x is None or not s.is_valid else _kept(x.encode(), s, length)[0].decode(errors="ignore") for x, s in zip(column.to_pylist(), batch.column(spans), strict=True)]
            arrays = {c: batch.column(c) for c in columns} | {"text": pa.array(texts, column.type)}
            if has_count:
                old = batch.column("n_chars")
                arrays["n_chars"] = pa.array([o if not s.is_valid else len(t) for o, t, s in zip(old.to_pylist(), texts, batch.column(spans), strict=True)], old.type)
            yield pa.RecordBatch.from_arrays(list(arrays.values()), list(arrays))

    schema = documents.schema
    assert isinstance(schema["text"].dataType, StringType)
    return joined.mapInArrow(rows, schema)
