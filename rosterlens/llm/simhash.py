"""SimHash near-duplicates by a binary trie that is joined with itself.

A fingerprint has 64 bits; two documents link if theirs differ in at most ``budget`` bits. Fingerprints are put in
``budget + 1`` tries, each of which starts with another block of bits: linked fingerprints agree in one block at least,
so in one of the tries the pair shares the node below the first block. From there pairs of nodes go down together and
add up the differing bits of their paths; a pair beyond the budget is pruned with everything below it, and so is a pair
whose leaves are in one component already. The nodes below the first blocks are dealt over the cluster.

A node with more than ``NODE_LIMIT`` leaves is dealt again: the bits below it are cut into ``budget + 1`` blocks, and each
leaf goes to one trie for each of them, below the bits that the node's leaves share. Linked leaves agree in one of these
blocks too. So a leaf has ``budget + 1`` copies for each time that its node is too large, and nodes shrink with the size
of the input until a task holds one.

Only distinct fingerprints enter; each task returns the links of a spanning forest, never all pairs of a group.

Defined results: texts that are null or hold no word have fingerprint zero, which links like any other; rows with a
null doc_id take part, but never name a component unless all of its ids are null; rows that repeat fall in one
component; a text of any length is hashed whole, in memory of some hundred bytes a word; extra columns are carried by
``deduplicate``, also where they are named as columns used here; without documents there are no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import fresh, materialize, slices
from .components import connected_components

SEED = 42
SHINGLE = 3
BITS = 64
BUDGET = 3
#: A node with more distinct fingerprints is dealt again by the bits below it.
NODE_LIMIT = 100_000
#: Fingerprints that a task joins at a time, unless one node has more.
TASK_LEAVES = 200_000
#: Pairs of nodes that are expanded at a time.
FRONTIER = 2_000_000
STEP = 8

_POPCOUNT = np.array([bin(i).count("1") for i in range(1 << STEP)], np.uint8)


def fingerprint(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    join, digest = b" ".join, xxhash.xxh64_intdigest
    windows = zip(*(words[i:] for i in range(SHINGLE)), strict=False) if len(words) >= SHINGLE else [words]
    hashes = np.array([digest(join(w), SEED) for w in windows], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(column: pa.Array) -> pa.Array:
    return pa.array(np.array([fingerprint(x) for x in column.to_pylist()], np.uint64).view(np.int64))


def with_fingerprint(documents: DataFrame, name: str) -> DataFrame:
    """All columns, and the fingerprint as a signed long."""

    def rows(batches):
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, _fingerprints(batch.column("text"))], [*batch.schema.names, name])

    return documents.mapInArrow(rows, StructType([*documents.schema.fields, StructField(name, LongType())]))


def _union(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links a-b; a label is the smallest index of its component."""
    while True:
        x, y = labels[a], labels[b]
        differ = x != y
        if not differ.any():
            return labels
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            jumped = labels[labels]
            if (jumped == labels).all():
                break
            labels = jumped


class _Trie:
    """Nodes of each depth over keys that are sorted by (group, key); a node is a range of leaves."""

    def __init__(self, group: np.ndarray, keys: np.ndarray, depths: list[int]):
        self.depths, self.n = depths, len(keys)
        change = np.concatenate(([True], group[1:] != group[:-1]))
        self.starts = []
        for depth in depths:
            prefix = keys >> np.uint64(BITS - depth) if depth < BITS else keys
            self.starts.append(np.flatnonzero(change | np.concatenate(([True], prefix[1:] != prefix[:-1]))))
        self.children = [np.append(np.searchsorted(lower, upper), len(lower)) for upper, lower in zip(self.starts, self.starts[1:], strict=False)]
        steps = [0, *(b - a for a, b in zip(depths, depths[1:], strict=False))]
        self.bits = [((keys[s] >> np.uint64(BITS - d)) & np.uint64((1 << w) - 1)).astype(np.uint8) if w else np.zeros(len(s), np.uint8) for s, d, w in zip(self.starts, depths, steps, strict=True)]

    def uniform(self, level: int, labels: np.ndarray) -> np.ndarray:
        """The component of a node whose leaves all have one, else -1 less the node."""
        starts = self.starts[level]
        low, high = np.minimum.reduceat(labels, starts), np.maximum.reduceat(labels, starts)
        return np.where(low == high, low, -1 - np.arange(len(starts)))


def self_join(group: np.ndarray, keys: np.ndarray, first: int, budget: int = BUDGET) -> np.ndarray:
    """Component labels (indices of leaves) of keys sorted by (group, key), under links within ``budget``.

    All keys of a group share their first ``first`` bits; its first node is joined with itself.
    """
    labels = np.arange(len(keys))
    if len(keys) < 2:
        return labels
    trie = _Trie(group, keys, [*range(first, BITS, STEP), BITS])
    nodes = np.arange(len(trie.starts[0]))
    stack = [(0, nodes, nodes, np.zeros(len(nodes), np.uint8))]
    while stack:
        level, u, v, differ = stack.pop()
        if level == len(trie.depths) - 1:
            own = u != v
            labels = _union(labels, u[own], v[own])
            continue
        if len(u) > 1000:
            comp = trie.uniform(level, labels)
            open_ = comp[u] != comp[v]
            open_ |= (u == v) & (comp[u] < 0)
            u, v, differ = u[open_], v[open_], differ[open_]
        kids = trie.children[level]
        size = (kids[u + 1] - kids[u]) * (kids[v + 1] - kids[v])
        total = np.cumsum(size)
        if len(u) > 1 and total[-1] > FRONTIER:
            cut = max(1, min(len(u) - 1, int(np.searchsorted(total, total[-1] // 2))))
            stack += [(level, u[cut:], v[cut:], differ[cut:]), (level, u[:cut], v[:cut], differ[:cut])]
            continue
        at = np.repeat(np.arange(len(u)), size)
        k = np.arange(len(at)) - np.repeat(total - size, size)
        wide = (kids[v + 1] - kids[v])[at]
        x, y = kids[u][at] + k // np.maximum(wide, 1), kids[v][at] + k % np.maximum(wide, 1)
        bits = trie.bits[level + 1]
        far = differ[at] + _POPCOUNT[bits[x] ^ bits[y]]
        near = (far <= budget) & ((u[at] != v[at]) | (x <= y))
        if near.any():
            stack.append((level + 1, x[near], y[near], far[near]))
    return labels


def blocks(bits: int, budget: int) -> list[tuple[int, int]]:
    """First bit and width of each of ``budget + 1`` blocks of so many bits."""
    cuts = [bits * i // (budget + 1) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _forward(depth: int, at: int, width: int) -> Column:
    """``key`` with the block ``at`` bits below ``depth`` moved up to ``depth``."""
    key, below = F.col("key"), BITS - depth - at - width

    def part(low: int, n: int, to: int) -> Column:
        bits = key if n == BITS else F.shiftrightunsigned(key, low).bitwiseAND(F.lit((1 << n) - 1))
        return F.shiftleft(bits, to) if n else F.lit(0)

    out = part(BITS - depth - at - width, width, BITS - depth - width).bitwiseOR(part(below + width, at, below)).bitwiseOR(part(0, below, 0))
    return out.bitwiseOR(part(BITS - depth, depth, BITS - depth)) if depth else out


def _deal(rows: DataFrame, depth: int, budget: int) -> DataFrame:
    """Each leaf (fp, path, key) of nodes at this depth once for each block below it: (fp, path, depth, key)."""
    each = [F.struct((F.col("path") * (budget + 1) + i).alias("path"), F.lit(depth + w).alias("depth"), _forward(depth, a, w).alias("key")) for i, (a, w) in enumerate(blocks(BITS - depth, budget))]
    return rows.select("fp", F.explode(F.array(*each)).alias("x")).select("fp", "x.*")


def links(prints: DataFrame, budget: int = BUDGET, node_limit: int = NODE_LIMIT) -> DataFrame:
    """Links ``(u, v)`` between the distinct fingerprints ``fp`` whose components are those of all links within the budget.

    A node is (path, prefix): the blocks chosen on the way down, as digits, and the bits that its leaves share.
    """
    prefix = F.expr(f"shiftrightunsigned(key, {BITS} - depth)")
    level = _deal(prints.select("fp", F.lit(1).cast("long").alias("path"), F.col("fp").alias("key")), 0, budget)
    depths, done = {w for _, w in blocks(BITS, budget)}, []
    while True:
        level = materialize(level.withColumn("prefix", prefix), "leaves")
        dense = materialize(level.groupBy("path", "prefix").agg(F.count("*").alias("n"), F.first("depth").alias("d")).where((F.col("n") > node_limit) & (F.col("d") + budget < BITS)).select("path", "prefix"), "dense")
        if dense.isEmpty():
            done.append(level)
            break
        done.append(level.join(dense, ["path", "prefix"], "left_anti").select(*level.columns))
        again = level.join(dense, ["path", "prefix"], "left_semi")
        parts = [_deal(again.where(F.col("depth") == d), d, budget) for d in sorted(depths)]
        level = reduce(DataFrame.unionByName, parts)
        depths = {d + w for d in depths for _, w in blocks(BITS - d, budget) if d + w + budget < BITS} or {BITS}
    leaves = reduce(DataFrame.unionByName, done).select("path", "prefix", "depth", "key", "fp")
    dealt = leaves.repartition("path", "prefix").sortWithinPartitions("path", "prefix")

    def solve(cols: list[np.ndarray]):
        path, prefix, depth, key, fp = cols
        key = key.view(np.uint64)
        for d in np.unique(depth):
            own = np.flatnonzero(depth == d)
            new = np.concatenate(([True], (path[own][1:] != path[own][:-1]) | (prefix[own][1:] != prefix[own][:-1])))
            group = np.cumsum(new) - 1
            order = np.lexsort((key[own], group))
            own, group = own[order], group[order]
            labels = self_join(group, key[own], int(d), budget)
            moved = labels != np.arange(len(own))
            yield pa.RecordBatch.from_arrays([pa.array(fp[own[moved]]), pa.array(fp[own[labels[moved]]])], ["u", "v"])

    def rows(batches):
        held: list[list[np.ndarray]] = []
        count = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([batch.column(c).to_numpy() for c in range(5)])
            count += batch.num_rows
            if count >= TASK_LEAVES:
                cols = [np.concatenate(x) for x in zip(*held, strict=True)]
                cut = count - int(((cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])).sum())  # the last node may go on
                if cut:
                    yield from solve([c[:cut] for c in cols])
                held, count = [[c[cut:] for c in cols]], count - cut
        if count:
            yield from solve([np.concatenate(x) for x in zip(*held, strict=True)])

    return dealt.mapInArrow(rows, "u long, v long")


def components(prints: DataFrame, budget: int = BUDGET) -> DataFrame:
    """``(fp, root, component_id, first_id)`` for the fingerprints of ``prints(doc_id, fp)``, as a table.

    Joins on a root or a fingerprint have tables on both sides, so that Spark splits one that is very common.
    """
    own = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    roots = connected_components(links(own, budget)).withColumnRenamed("node", "fp")
    rooted = materialize(own.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted")
    named = materialize(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "named")
    return materialize(rooted.join(named, "root").select("fp", "root", "component_id", "first_id"), "components")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of its component)."""
    prints = materialize(with_fingerprint(documents.select("doc_id", "text"), "fp").select("doc_id", "fp"), "prints")
    found = components(prints).select("fp", "component_id")
    return prints.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(documents: DataFrame) -> DataFrame:
    """The documents' rows, one of each component: that with the smallest doc_id (a null one only where all are null)."""
    fp, kept_fp, kept_id, n = (fresh(documents, x) for x in ("fp", "kept_fp", "component_id", "n"))
    prints = materialize(with_fingerprint(documents, fp), "prints")
    found = components(prints.select("doc_id", F.col(fp).alias("fp")))
    repeated = not prints.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty()
    kept = found.where(F.col("first_id").eqNullSafe(F.col("component_id"))).select(F.col("component_id").alias(kept_id), F.col("fp").alias(kept_fp))
    if repeated:  # ids that are null or repeat: one fingerprint of the component and one row of it are left
        kept = kept.groupBy(kept_id).agg(F.min(kept_fp).alias(kept_fp)).where(F.col(kept_id).isNotNull()).unionByName(kept.where(F.col(kept_id).isNull()).join(_one_of_each(found), F.col(kept_fp) == F.col("least_fp"), "left_semi"))
    out = prints.join(kept, (F.col(fp) == F.col(kept_fp)) & prints["doc_id"].eqNullSafe(F.col(kept_id)), "left_semi")
    if repeated:  # one row of each; partial sums keep one per task
        row = F.struct(*documents.columns)
        out = out.groupBy(fp, F.col("doc_id").alias(kept_id)).agg(F.min_by(row, F.xxhash64(*documents.columns)).alias(n)).select(f"{n}.*")
    return out.select(*documents.columns)


def _one_of_each(found: DataFrame) -> DataFrame:
    """The least fingerprint of every component that has no id."""
    return found.where("component_id is null").groupBy("root").agg(F.min("fp").alias("least_fp")).select("least_fp")
