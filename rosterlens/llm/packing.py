"""Vector best-fit packing of tokenized documents into sequences.

A document is its ids and an end id. Only documents of more than ``tokens`` ids are cut, into full pieces; the first
piece takes what is over. Every piece has a size in three dimensions (tokens, documents, attention cost: the square of
its tokens) and so has a sequence's room. Pieces go largest first to the open sequence that has room in every dimension
and, with the piece placed, the least weighted residual norm (or the largest weighted dot product of piece and
residual). Full pieces have sequences of their own.

At the default room a sequence that holds its tokens holds its documents and its attention too, as the contract allows no
sequence more than tokens demand; so the three residuals choose the sequence, and only that of tokens can refuse one.
Tighter capacities bind and are kept.

Pieces are dealt round robin into shares of ``SHARE`` pieces, each of which one task packs; the deal needs no key, so no
key can be hot, and each share leaves about one sequence part empty.

Defined results: a null text is empty, its document is the end id alone; rows that repeat, or share an id or have none,
are packed each; a text of any length is encoded whole, in memory of some tens of bytes a byte; extra columns play no
part; no documents make no sequences.
"""

from __future__ import annotations

import math
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .bpe import REMEMBERED, SLICE_BYTES, tokenizer_file
from .common import materialize, slices

END_ID = 0
SHARE = 40_000


@dataclass(frozen=True)
class Room:
    """What a sequence holds, and the dimensions' weights in the choice of a sequence."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)
    rule: str = "norm"  # or "dot"

    def sizes(self, lengths: np.ndarray) -> np.ndarray:
        lengths = lengths.astype(np.float64)
        return np.stack([lengths / self.tokens, np.full(len(lengths), 1 / self.documents), lengths**2 / self.attention])


def place(lengths: np.ndarray, room: Room) -> tuple[np.ndarray, np.ndarray, int]:
    """The sequence and the offset of every piece, and the number of sequences."""
    if len(lengths) and (lengths.max() > room.tokens or float(lengths.max()) ** 2 > room.attention or room.documents < 1):
        raise ValueError("a piece exceeds an empty sequence")
    order = np.argsort(-lengths, kind="stable")
    sizes, weights = room.sizes(lengths), np.array(room.weights)[:, None]
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    residual, name, used = np.zeros((3, 1024)), np.zeros(1024, np.int64), np.zeros(1024, np.int64)
    n_open = count = 0
    least = float(sizes[0].min()) if len(lengths) else 0.0
    slack = 1e-12
    for step, item in enumerate(order.tolist()):
        size = sizes[:, item]
        at = -1
        if n_open and size[0] < 1:
            left = residual[:, :n_open] - size[:, None]
            fits = (left > -slack).all(axis=0)
            if fits.any():
                value = (weights * left**2).sum(axis=0) if room.rule == "norm" else -(weights * residual[:, :n_open] * size[:, None]).sum(axis=0)
                at = int(np.where(fits, value, np.inf).argmin())
        if at < 0:
            if n_open == residual.shape[1]:
                residual, name, used = np.concatenate((residual, residual), axis=1), np.concatenate((name, name)), np.concatenate((used, used))
            at, n_open = n_open, n_open + 1
            residual[:, at], name[at], used[at] = 1.0, count, 0
            count += 1
        sequence[item], offset[item] = name[at], used[at]
        residual[:, at] -= size
        used[at] += lengths[item]
        if residual[0, at] < least - slack or step % 512 == 511:  # what no later piece fits is closed
            keep = (residual[0, :n_open] >= least - slack) & (residual[1, :n_open] >= 1 / room.documents - slack)
            k = int(keep.sum())
            residual[:, :k], name[:k], used[:k] = residual[:, :n_open][:, keep], name[:n_open][keep], used[:n_open][keep]
            n_open = k
    return sequence, offset, count


def token_pieces(documents: DataFrame, path: str, tokens: int) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32. ``path``: a tokenizer file on every machine."""

    def rows(batches):
        vocabulary, added = tokenizer_file(path)
        # a piece's merges alone; the pieces are known already
        encode = tiktoken.Encoding("pieces", pat_str=r"(?s).+", mergeable_ranks=vocabulary.ranks, special_tokens={}).encode_ordinary
        remembered: dict[bytes, bytes] = {}
        whole = None

        def encode_pieces(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            each = list(map(remembered.get, found))
            for i in [i for i, ids in enumerate(each) if ids is None]:
                each[i] = array("I", encode(found[i].decode())).tobytes()
                if len(remembered) < REMEMBERED:
                    remembered[found[i]] = each[i]
            ends = np.concatenate(([0], np.cumsum(np.fromiter(map(len, each), np.int64, len(each)) // 4)))
            return np.frombuffer(b"".join(each), np.uint32).astype(np.int64), ends

        for batch in slices(batches, limit=SLICE_BYTES):
            column = batch.column("text")
            ids, offsets = vocabulary.encode(column, encode_pieces)
            out: list[tuple] = []
            for i, (doc, text) in enumerate(zip(batch.column("doc_id").to_pylist(), column.to_pylist(), strict=True)):
                own = ids[offsets[i] : offsets[i + 1]]
                if text and any(t in text for t in added):  # the library takes these strings for single tokens
                    if whole is None:
                        from tokenizers import Tokenizer

                        whole = Tokenizer.from_file(path)
                    own = np.array(whole.encode(text, add_special_tokens=False).ids, np.int64)
                raw = np.append(own, END_ID).astype("<u4").tobytes()
                n, start, stop = len(own) + 1, 0, (len(own) % tokens) + 1
                piece = 0
                while start < n:
                    out.append((doc, piece, start, stop - start, zlib.crc32(raw[4 * start : 4 * stop])))
                    piece, start, stop = piece + 1, stop, stop + tokens
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return documents.select("doc_id", "text").mapInArrow(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(documents: DataFrame, path: str | None = None, room: Room | None = None, share: int = SHARE) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    room = room or Room()
    pieces = materialize(token_pieces(documents, path or public_tokenizers.path("byte_bpe_50k.json"), room.tokens), "pieces")
    shares = max(1, math.ceil(pieces.count() / share))

    def rows(batches):
        held = list(batches)
        if not held:
            return
        own = pa.Table.from_batches(held).combine_chunks()
        sequence, offset, _ = place(own["length"].to_numpy(), room)
        base = TaskContext.get().partitionId() << 32
        yield from own.append_column("sequence_id", pa.array(base + sequence)).append_column("offset", pa.array(offset)).to_batches()

    return pieces.repartition(shares).mapInArrow(rows, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
