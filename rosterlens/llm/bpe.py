"""Byte-level BPE: encoding with segment trees of pair ranks, and decoding.

Texts are split by the usual pattern of byte-level vocabularies. A piece that is a token is that token. Of any other
piece, a segment tree over the byte positions keeps the least pair rank, the leftmost of equal ones, at its root. A merge
writes the live neighbours' new pairs to their leaves and updates the nodes above them. Short pieces of a batch share
array operations, a row of trees for each power of two of their sizes; long pieces have a tree of their own.

Each distinct piece of a slice of texts is encoded once, so work follows a slice's vocabulary rather than its length.

Defined results: a null text is empty and has no ids; rows that repeat are encoded each; texts of any length are
encoded whole; ids that the vocabulary lacks cannot be decoded and raise; extra columns play no part; without documents
there are no rows.
"""

from __future__ import annotations

import base64
import hashlib
import json
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import slices, text_bytes

#: Texts are encoded in slices of about this many bytes.
SLICE_BYTES = 6 << 20
#: Pieces with more bytes than this get a tree of their own.
SHORT = 64
#: Short pieces that share array operations; their trees fit a CPU's cache.
ROWS = 4096
#: Pieces whose ids a worker remembers.
REMEMBERED = 500_000
_NONE = np.iinfo(np.int64).max
_FREE = np.iinfo(np.int32).max

_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


@lru_cache(1)
def _classes() -> np.ndarray:
    """The class of every code point."""
    points = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\0" for c in range(0x110000))
    out = np.full(0x110000, _OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}+", _LETTER), (r"\p{N}+", _NUMBER), (r"\p{White_Space}+", _SPACE)):
        for m in regex.finditer(pattern, points):
            out[m.start() : m.end()] = kind
    return out


def split_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte offsets at which the pieces of the texts begin, and the end of the last.

    The pieces are the matches of: an apostrophe with s, t, re, ve, m, ll or d; runs of letters, of numbers or of other
    visible characters, each with a space before it; white space up to the last character before a visible one; any
    other white space.
    """
    n = len(data)
    if not n:
        return np.zeros(1, np.int64)
    head = np.zeros(n + 1, bool)
    head[offsets] = True
    classes = _classes()
    kind = classes[:256][data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):  # all bytes of a character have its class
        first = data[lead].astype(np.int64)
        more = 1 + (first >= 0xE0) + (first >= 0xF0)
        point = first & (0x3F >> more)
        for k in range(1, 4):
            some = more >= k
            point[some] = point[some] << 6 | data[lead[some] + k] & 0x3F
        own = classes[point]
        for k in range(4):
            some = more >= k
            kind[lead[some] + k] = own[some]
    starts = head[:n].copy()
    starts[1:] |= kind[1:] != kind[:-1]
    space = kind == _SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~head[1:n])  # white space right before a visible character of its text
    starts[last[data[last] == 32] + 1] = False
    while len(last):
        inner = (data[last] & 0xC0) == 0x80  # the character's last byte: its first one begins the piece
        starts[last[~inner]] = True
        last = last[inner] - 1
    mark = np.flatnonzero((data[:-1] == 39) & starts[:-1] & (kind[1:] == _LETTER) & ~head[1:n])
    if len(mark):
        one = data[mark + 1]
        two = np.where(head[np.minimum(mark + 2, n)], 0, data[np.minimum(mark + 2, n - 1)])
        short = np.isin(one, list(b"stmd"))
        long = ((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l")))
        took = mark[short | long]
        starts[took + 1] = False
        after = took + 2 + long[short | long]
        after = after[~head[after]]
        starts[after[kind[after] == _LETTER]] = True
    return np.append(np.flatnonzero(starts), n)


@dataclass(frozen=True)
class Vocabulary:
    """Token bytes by id; an id is also the token's merge rank."""

    tokens: tuple[bytes, ...]

    @cached_property
    def ranks(self) -> dict[bytes, int]:
        return {t: i for i, t in enumerate(self.tokens)}

    @cached_property
    def single(self) -> np.ndarray:
        return np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys (left id, right id) of all pairs that make a token, and the tokens' ranks."""
        keys, values = [], []
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        keys, values = np.array(keys, np.int64), np.array(values, np.int64)
        order = np.argsort(keys)
        return np.append(keys[order], _NONE), np.append(values[order], -1)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; -1 if it makes no token."""
        keys, values = self.pairs
        want = (left.astype(np.int64) << 32) | right
        at = np.searchsorted(keys, want)
        return np.where(keys[at] == want, values[at], -1)

    @cached_property
    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(self.tokens), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in self.tokens])))

    def decode(self, ids: np.ndarray) -> bytes:
        data, offsets = self.flat
        return data[_ranges(offsets[ids], offsets[ids + 1] - offsets[ids])].tobytes()

    # -- encoding

    def encode_long(self, piece: bytes) -> list[int]:
        """One segment tree for one piece."""
        n = len(piece)
        ids = self.single[np.frombuffer(piece, np.uint8)]
        size = 1 << max(n - 1, 1).bit_length()
        ranks = self.pair_ranks(ids[:-1], ids[1:])
        leaves = np.full(size, _NONE)
        leaves[: n - 1] = np.where(ranks >= 0, ranks * size + np.arange(n - 1), _NONE)
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
        tree = np.concatenate([[_NONE], *levels[::-1]]).tolist()
        live, before, after = ids.tolist(), list(range(-1, n - 1)), list(range(1, n + 1))
        tokens, known = self.tokens, self.ranks

        def put(at: int, value: int) -> None:
            i = size + at
            tree[i] = value
            while i > 1:
                i >>= 1
                least = min(tree[2 * i], tree[2 * i + 1])
                if tree[i] == least:
                    break
                tree[i] = least

        def pair(at: int) -> int:
            right = after[at]
            rank = known.get(tokens[live[at]] + tokens[live[right]]) if right < n else None
            return _NONE if rank is None else rank * size + at

        while tree[1] != _NONE:
            rank, at = divmod(tree[1], size)
            gone = after[at]
            live[at], live[gone] = rank, -1
            after[at] = after[gone]
            if after[gone] < n:
                before[after[gone]] = at
            put(gone, _NONE)
            put(at, pair(at))
            if before[at] >= 0:
                put(before[at], pair(before[at]))
        return [x for x in live if x >= 0]

    def encode_short(self, pieces: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
        """A row of segment trees for pieces of 2 to ``size`` bytes (a power of two): ids, one after another, and counts."""
        if len(pieces) > ROWS:
            parts = [self.encode_short(pieces[i : i + ROWS], size) for i in range(0, len(pieces), ROWS)]
            return np.concatenate([p for p, _ in parts]), np.concatenate([n for _, n in parts])
        m = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int32, m)
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(m, size)
        column = np.arange(size, dtype=np.int32)
        inside = column < lengths[:, None]
        live = np.where(inside, self.single[raw], -1).astype(np.int32)
        after = np.where(column + 1 < lengths[:, None], column + 1, size).astype(np.int32)
        before = np.broadcast_to(column - 1, (m, size)).copy()
        tree = np.full((m, 2 * size), _FREE, np.int32)
        row, col = np.nonzero(inside[:, 1:])
        ranks = self.pair_ranks(live[row, col], live[row, col + 1])
        tree[row, size + col] = np.where(ranks >= 0, ranks * size + col, _FREE)
        flat = tree.reshape(-1)
        half = size
        while half > 1:
            half //= 2
            tree[:, half : 2 * half] = np.minimum(tree[:, 2 * half : 4 * half : 2], tree[:, 2 * half + 1 : 4 * half : 2])

        def put(rows: np.ndarray, at: np.ndarray, values: np.ndarray | int) -> None:
            base, i = rows * (2 * size), at + size
            flat[base + i] = values
            for _ in range(size.bit_length() - 1):
                i = i >> 1
                below = base + 2 * i
                flat[base + i] = np.minimum(flat[below], flat[below + 1])

        def pair(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
            right = after[rows, at]
            some = right < size
            rank = self.pair_ranks(live[rows, at], live[rows, np.minimum(right, size - 1)])
            return np.where(some & (rank >= 0), rank * size + at, _FREE)

        rows = np.flatnonzero(tree[:, 1] != _FREE)
        while len(rows):
            rank, at = np.divmod(tree[rows, 1], size)
            gone = after[rows, at]
            live[rows, at], live[rows, gone] = rank, -1
            beyond = after[rows, gone]
            after[rows, at] = beyond
            has = beyond < size
            before[rows[has], beyond[has]] = at[has]
            put(rows, gone, _FREE)
            put(rows, at, pair(rows, at))
            left = before[rows, at]
            has = left >= 0
            put(rows[has], left[has], pair(rows[has], left[has]))
            rows = rows[tree[rows, 1] != _FREE]
        return live[live >= 0].astype(np.int64), (live >= 0).sum(axis=1)

    @cached_property
    def remembered(self) -> dict[bytes, bytes]:
        return {}

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after another, and each piece's first index (pieces + 1)."""
        known = self.ranks
        whole = [known.get(p, -1) for p in pieces]
        counts = np.ones(len(pieces), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []  # numbers of pieces, their ids one after another
        first = np.array(whole, np.int64)
        sizes: dict[int, list[int]] = {}
        open_ = np.flatnonzero(first < 0).tolist()
        past = list(map(self.remembered.get, map(pieces.__getitem__, open_)))
        seen = [(i, ids) for i, ids in zip(open_, past, strict=True) if ids]
        if seen:
            ids = b"".join([x for _, x in seen])
            own = np.array([i for i, _ in seen])
            counts[own] = np.array([len(x) for _, x in seen]) // 4
            parts.append((own, np.frombuffer(ids, np.uint32).astype(np.int64)))
        for i in (i for i, ids in zip(open_, past, strict=True) if not ids):
            sizes.setdefault(max(2, 1 << (len(pieces[i]) - 1).bit_length()), []).append(i)
        for size, own in sizes.items():
            if size <= SHORT:
                ids, n = self.encode_short([pieces[i] for i in own], size)
            else:
                each = [self.encode_long(pieces[i]) for i in own]
                ids, n = np.array([x for e in each for x in e], np.int64), np.array([len(e) for e in each])
            counts[own] = n
            parts.append((np.array(own), ids))
            room = REMEMBERED - len(self.remembered)
            if size <= SHORT and room > 0:
                flat, ends = ids.astype(np.uint32).tobytes(), (4 * np.cumsum(n)).tolist()
                self.remembered.update((pieces[i], flat[a:b]) for i, a, b in zip(own[:room], [0, *ends], ends, strict=False))
        offsets = np.concatenate(([0], np.cumsum(counts)))
        out = np.empty(offsets[-1], np.int64)
        single = first >= 0
        out[offsets[:-1][single]] = first[single]
        for own, ids in parts:
            out[_ranges(offsets[own], counts[own])] = ids
        return out, offsets

    def encode(self, column: pa.Array, encode_pieces=None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and each text's first index (rows + 1)."""
        data, offsets = text_bytes(column)
        points = split_points(data, offsets)
        if len(points) < 2:
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(points) - 1, [None, pa.py_buffer(points.astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
        ids, first = (encode_pieces or self.encode_pieces)(_values(pieces.dictionary))
        code = pieces.indices.to_numpy()
        n = (first[1:] - first[:-1])[code]
        ends = np.concatenate(([0], np.cumsum(n)))
        return ids[_ranges(first[:-1][code], n)], ends[np.searchsorted(points, offsets)]


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), starts[1], ..."""
    some = counts > 0
    if not some.all():
        starts, counts = starts[some], counts[some]
    if not len(starts):
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    steps = np.ones(ends[-1], np.int64)
    steps[0] = starts[0]
    steps[ends[:-1]] = starts[1:] - starts[:-1] - counts[:-1] + 1
    return np.cumsum(steps, out=steps)


def _values(column: pa.Array) -> list[bytes]:
    """As to_pylist() of a binary column without nulls, but faster."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1].tolist()
    data = column.buffers()[2].to_pybytes()
    return [data[a:b] for a, b in pairwise(offsets)]


@lru_cache(4)
def rank_file(path: str) -> Vocabulary:
    """A vocabulary of lines ``base64 rank``."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return Vocabulary(tuple(sorted(ranks, key=ranks.__getitem__)))


@lru_cache(4)
def tokenizer_file(path: str) -> tuple[Vocabulary, dict[str, int]]:
    """A byte-level vocabulary in the tokenizers library's format, and its added tokens."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocab = {k: v for k, v in spec["model"]["vocab"].items() if k not in added}
    ids = sorted(vocab, key=vocab.__getitem__)
    merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    if [vocab[t] for t in ids] != list(range(len(ids))) or [vocab["".join(m)] for m in merges] != list(range(len(ids) - len(merges), len(ids))):
        raise ValueError(f"{path}: ids do not follow the merges")
    return Vocabulary(tuple(bytes(byte[c] for c in t) for t in ids)), added


def round_trip(documents: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256. ``path``: a rank file on every machine."""

    def rows(batches):
        vocabulary = rank_file(path)
        for batch in slices(batches, limit=SLICE_BYTES):
            ids, offsets = vocabulary.encode(batch.column("text"))
            each = [ids[i:j] for i, j in zip(offsets, offsets[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(np.diff(offsets)),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in each], pa.string()),
                    pa.array([hashlib.sha256(vocabulary.decode(x)).hexdigest() for x in each], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return documents.select("doc_id", "text").mapInArrow(rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
